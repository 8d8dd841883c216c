"""The business questions, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vendaflow.functions.measures import weighted_mean
from vendaflow.functions.text import currency, percent, thousands
from vendaflow.plans.ranking import contenders
from vendaflow.plans.star import (
    Filters, SharedStar, Star, distinct, margin, ticket, total, total_or_zero,
)

Source = Star | SharedStar
ALL = Filters()


# -- whole-warehouse views ---------------------------------------------------------


def vendas_detalhadas(star: Star) -> DataFrame:
    """Every sale with its dimension attributes: 25 columns."""
    names = [
        "data_pedido", "ano_mes", "ano", "mes", "nome_mes", "data_envio", "ship_mode",
        "customer_id", "nome_cliente", "segmento", "regiao", "estado", "cidade", "pais",
        "product_id", "nome_produto", "categoria", "subcategoria",
    ]
    renamed = {"ship_mode": "modo_envio", "segmento": "tipo_cliente"}
    facts = ["vendas", "quantidade", "desconto", "lucro", "margem_lucro_pct"]
    return star.lines(names).select(
        "row_id", "order_id", *[F.col(n).alias(renamed.get(n, n)) for n in names], *facts
    )


VIEW_TOTALS = [
    total("vendas", "receita_total"),
    total("lucro", "lucro_total"),
    total("quantidade", "quantidade_vendida"),
    margin("margem_lucro_pct"),
]


def receita_lucro_subcategoria(star: Source) -> DataFrame:
    return star.aggregate(["categoria", "subcategoria"], VIEW_TOTALS)


def rentabilidade_produto(star: Star) -> DataFrame:
    """By product id: products that share a name stay apart."""
    by = ["product_id", "nome_produto", "categoria", "subcategoria"]
    return star.aggregate(by, VIEW_TOTALS)


def vendas_lucro_estado(star: Source) -> DataFrame:
    return star.aggregate(
        ["regiao", "estado"],
        [
            total("vendas", "receita_total"),
            total("lucro", "lucro_total"),
            distinct("order_id", "total_pedidos"),
            distinct("sk_cliente", "clientes_unicos"),
            margin("margem_lucro_pct"),
        ],
    )


def habitos_compra_segmento(star: Source) -> DataFrame:
    rows = star.aggregate(
        ["segmento", "ano_mes", "ano", "mes", "nome_mes"],
        [
            distinct("order_id", "total_pedidos"),
            distinct("sk_cliente", "clientes_unicos"),
            total("quantidade", "itens_comprados"),
            ticket("ticket_medio_item"),
            total("vendas", "receita_total"),
            total("lucro", "lucro_total"),
        ],
    )
    return rows.withColumnRenamed("segmento", "tipo_mercado")


def vendas_mensais(star: Source) -> DataFrame:
    rows = star.aggregate(["ano_mes", "ano", "mes", "nome_mes", "segmento"], VIEW_TOTALS)
    return rows.withColumnRenamed("segmento", "tipo_mercado")


VIEWS = {
    "vw_vendas_detalhadas": vendas_detalhadas,
    "vw_receita_lucro_subcategoria": receita_lucro_subcategoria,
    "vw_rentabilidade_produto": rentabilidade_produto,
    "vw_vendas_lucro_estado": vendas_lucro_estado,
    "vw_habitos_compra_segmento": habitos_compra_segmento,
    "vw_vendas_mensais": vendas_mensais,
}


# -- filtered reports --------------------------------------------------------------


def kpi(star: Source, filters: Filters = ALL) -> DataFrame:
    """One row, of zeros where nothing matches."""
    return star.aggregate(
        [],
        [
            total_or_zero("vendas", "receita"),
            total_or_zero("lucro", "lucro"),
            total_or_zero("quantidade", "itens"),
            margin("margem"),
        ],
        filters,
    )


def kpi_formatted(star: Source, filters: Filters = ALL) -> DataFrame:
    """The same row as display texts."""
    return kpi(star, filters).select(
        currency(F.col("receita")).alias("receita"),
        currency(F.col("lucro")).alias("lucro"),
        thousands(F.col("itens")).alias("itens"),
        percent(F.col("margem")).alias("margem"),
    )


def _ranked(rows: DataFrame, column: str, keys: list[str], count: int, best: bool) -> DataFrame:
    """First `count` rows by `column`; equal values in the order of the keys."""
    order = F.desc(column) if best else F.asc(column)
    return rows.orderBy(order, *keys).limit(count)


def _subcategorias(star: Source, filters: Filters) -> DataFrame:
    sums = [total("vendas", "receita"), total("lucro", "lucro")]
    return star.aggregate(["categoria", "subcategoria"], sums, filters)


def subcategorias(star: Source, filters: Filters = ALL) -> DataFrame:
    return _subcategorias(star, filters).orderBy(F.desc("receita"), "categoria", "subcategoria")


def subcategorias_ranked(
    star: Source, filters: Filters = ALL, count: int = 10, best: bool = True
) -> DataFrame:
    """Highest or lowest revenue; both measures, since the lowest are charted by profit."""
    rows = _subcategorias(star, filters)
    return _ranked(rows, "receita", ["categoria", "subcategoria"], count, best)


PRODUCT = ["nome_produto", "categoria", "subcategoria"]


PRODUCT_SUMS = [total("vendas", "receita"), total("lucro", "lucro"), margin("margem")]


def _produtos(star: Source, filters: Filters) -> DataFrame:
    return star.aggregate(PRODUCT, PRODUCT_SUMS, filters)


def produtos(star: Source, filters: Filters = ALL) -> DataFrame:
    """By product name: products that share name and categories are one line."""
    return _produtos(star, filters).orderBy(F.desc("lucro"), *PRODUCT)


def produtos_ranked(
    star: Source, filters: Filters = ALL, count: int = 15, best: bool = True
) -> DataFrame:
    """Highest or lowest profit. Of products too many to broadcast, only those are named whose
    lines can be among the first."""
    rows = None
    if isinstance(star, Star):
        rows = contenders(star, "produto", PRODUCT, PRODUCT_SUMS, "lucro", filters, count, best)
    return _ranked(_produtos(star, filters) if rows is None else rows, "lucro", PRODUCT, count, best)


def _estados(star: Source, filters: Filters) -> DataFrame:
    sums = [total("vendas", "receita"), total("lucro", "lucro"), distinct("order_id", "pedidos")]
    return star.aggregate(["regiao", "estado"], sums, filters)


def estados(star: Source, filters: Filters = ALL) -> DataFrame:
    return _estados(star, filters).orderBy(F.desc("receita"), "regiao", "estado")


def estados_rollup(star: Source, filters: Filters = ALL) -> DataFrame:
    """Totals per state, region and overall: `nivel` 0, 1, 3.

    `lucro_ponderado` is the mean profit of the states below, weighted by their revenue.
    """
    sums = [total("vendas", "receita"), total("lucro", "lucro")]
    states = star.aggregate(["regiao", "estado"], sums, filters)
    return states.rollup("regiao", "estado").agg(
        F.grouping_id().alias("nivel"),
        F.sum("receita").alias("receita"),
        F.round(weighted_mean(F.col("lucro"), F.col("receita")), 2).alias("lucro_ponderado"),
    )


def _habitos(star: Source, filters: Filters) -> DataFrame:
    rows = star.aggregate(
        ["segmento", "ano_mes"],
        [
            distinct("order_id", "pedidos"),
            distinct("sk_cliente", "clientes"),
            total("quantidade", "itens"),
            ticket("ticket_medio"),
            total("vendas", "receita"),
        ],
        filters,
    )
    return rows.withColumnRenamed("segmento", "tipo_cliente")


def habitos(star: Source, filters: Filters = ALL) -> DataFrame:
    return _habitos(star, filters).orderBy("ano_mes", "tipo_cliente")


def ticket_mean_of_means(star: Source, filters: Filters = ALL) -> DataFrame:
    """Plain mean of the rounded monthly tickets, every month counting the same."""
    monthly = star.aggregate(["segmento", "ano_mes"], [ticket("ticket_medio")], filters)
    return monthly.groupBy(F.col("segmento").alias("tipo_cliente")).agg(
        F.avg("ticket_medio").alias("ticket_medio")
    )


def modo_envio(star: Source, filters: Filters = ALL) -> DataFrame:
    return star.aggregate(["segmento", "ship_mode"], [total("linhas", "qtd")], filters)


def modo_envio_rollup(star: Source, filters: Filters = ALL) -> DataFrame:
    """Sales per ship mode, segment and overall: `nivel` 0, 1, 3."""
    counts = modo_envio(star, filters)
    return counts.rollup("segmento", "ship_mode").agg(
        F.grouping_id().alias("nivel"), F.sum("qtd").alias("qtd")
    )


def mensal(star: Source, filters: Filters = ALL) -> DataFrame:
    sums = [total("vendas", "receita"), total("lucro", "lucro"), margin("margem")]
    rows = star.aggregate(["ano_mes", "segmento"], sums, filters)
    return rows.withColumnRenamed("segmento", "tipo_mercado").orderBy("ano_mes", "tipo_mercado")


OPTIONS = {
    "segmentos": ("dim_cliente", "segmento"),
    "regioes": ("dim_localizacao", "regiao"),
    "categorias": ("dim_produto", "categoria"),
    "anos": ("dim_tempo", "ano"),
}


def filter_options(star: Star) -> dict[str, DataFrame]:
    """The values each filter offers, sorted: members of the dimensions, sold or not."""
    return {
        kind: star.table(table).select(column).distinct().orderBy(column)
        for kind, (table, column) in OPTIONS.items()
    }


REPORTS = {
    "kpi": kpi,
    "kpi_formatted": kpi_formatted,
    "subcategorias": subcategorias,
    "produtos": produtos,
    "estados": estados,
    "estados_rollup": estados_rollup,
    "habitos": habitos,
    "ticket_mean_of_means": ticket_mean_of_means,
    "modo_envio": modo_envio,
    "modo_envio_rollup": modo_envio_rollup,
    "mensal": mensal,
}
