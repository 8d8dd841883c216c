"""The warehouse in the catalog: tables and views for ad-hoc SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from vendaflow.functions.measures import SUM, margin_sql, mean_line_sql
from vendaflow.plans.warehouse import Warehouse
from vendaflow.schema import TABLES

_MARGIN = margin_sql("sum(lucro)", "sum(vendas)")
_TICKET = mean_line_sql("sum(vendas)", "sum(linhas)")


def _summed(*keys: str) -> str:
    """The fact summed per key, in the map tasks first: what the views join instead of lines."""
    return f"""(
            SELECT {", ".join(keys)}, sum(vendas) AS vendas, sum(lucro) AS lucro,
                   sum(quantidade) AS quantidade, count(1) AS linhas
            FROM {{db}}.fato_vendas GROUP BY {", ".join(keys)}
        )"""


def _total(column: str, name: str) -> str:
    return f"cast(sum({column}) AS {'bigint' if column == 'quantidade' else SUM}) AS {name}"


_TOTALS = (
    f"{_total('vendas', 'receita_total')}, {_total('lucro', 'lucro_total')}, "
    f"{_total('quantidade', 'quantidade_vendida')}, {_MARGIN} AS margem_lucro_pct"
)

# The year is the fact's partition column: a filter on it leaves the other years unread.
VIEW_SQL = {
    "vw_vendas_detalhadas": """
        SELECT row_id, order_id,
               pedido.data AS data_pedido, pedido.ano_mes, ano_pedido AS ano, pedido.mes,
               pedido.nome_mes, remessa.data AS data_envio, ship_mode AS modo_envio,
               customer_id, nome_cliente, segmento AS tipo_cliente,
               regiao, estado, cidade, pais,
               product_id, nome_produto, categoria, subcategoria,
               vendas, quantidade, desconto, lucro, margem_lucro_pct
        FROM {db}.fato_vendas
        JOIN {db}.dim_tempo AS pedido ON pedido.sk_tempo = sk_tempo_pedido
        JOIN {db}.dim_tempo AS remessa ON remessa.sk_tempo = sk_tempo_envio
        JOIN {db}.dim_envio USING (sk_envio)
        JOIN {db}.dim_localizacao USING (sk_localizacao)
        JOIN {db}.dim_produto USING (sk_produto)
        JOIN {db}.dim_cliente USING (sk_cliente)
    """,
    "vw_receita_lucro_subcategoria": f"""
        SELECT categoria, subcategoria, {_TOTALS}
        FROM {_summed("sk_produto")} JOIN {{db}}.dim_produto USING (sk_produto)
        GROUP BY ALL
    """,
    "vw_rentabilidade_produto": f"""
        SELECT product_id, nome_produto, categoria, subcategoria, {_TOTALS}
        FROM {_summed("sk_produto")} JOIN {{db}}.dim_produto USING (sk_produto)
        GROUP BY ALL
    """,
    "vw_vendas_lucro_estado": f"""
        SELECT regiao, estado, {_total("vendas", "receita_total")}, {_total("lucro", "lucro_total")},
               count(DISTINCT order_id) AS total_pedidos,
               count(DISTINCT sk_cliente) AS clientes_unicos, {_MARGIN} AS margem_lucro_pct
        FROM {_summed("sk_localizacao", "order_id", "sk_cliente")}
        JOIN {{db}}.dim_localizacao USING (sk_localizacao)
        GROUP BY ALL
    """,
    "vw_habitos_compra_segmento": f"""
        SELECT segmento AS tipo_mercado, ano_mes, ano_pedido AS ano, mes, nome_mes,
               count(DISTINCT order_id) AS total_pedidos,
               count(DISTINCT sk_cliente) AS clientes_unicos,
               {_total("quantidade", "itens_comprados")}, {_TICKET} AS ticket_medio_item,
               {_total("vendas", "receita_total")}, {_total("lucro", "lucro_total")}
        FROM {_summed("sk_cliente", "sk_tempo_pedido", "order_id", "ano_pedido")}
        JOIN {{db}}.dim_cliente USING (sk_cliente)
        JOIN {{db}}.dim_tempo ON sk_tempo = sk_tempo_pedido
        GROUP BY ALL
    """,
    "vw_vendas_mensais": f"""
        SELECT ano_mes, ano_pedido AS ano, mes, nome_mes, segmento AS tipo_mercado, {_TOTALS}
        FROM {_summed("sk_cliente", "sk_tempo_pedido", "ano_pedido")}
        JOIN {{db}}.dim_cliente USING (sk_cliente)
        JOIN {{db}}.dim_tempo ON sk_tempo = sk_tempo_pedido
        GROUP BY ALL
    """,
}


def publish(warehouse: Warehouse, database: str = "dw") -> None:
    """Point the catalog at the newest load: `dw.dim_*`, `dw.fato_vendas`, `dw.vw_*`.

    The tables are views over the files of one load, replaced by name, so readers never
    see a half-written table and nothing is copied. Dimensions are switched before the fact:
    keys are only ever added, so the old fact finds its members in new dimensions too.
    """
    spark = warehouse.spark
    location = f"{warehouse.root}/catalog".replace("\\", "\\\\").replace("'", "\\'")
    db = quoted(database)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{location}'")
    for entry in warehouse.entries():
        columns = ", ".join(TABLES[entry["name"]].columns)
        spark.sql(
            f"CREATE OR REPLACE VIEW {db}.{entry['name']} AS "
            f"SELECT {columns} FROM parquet.{quoted(entry.path)}"
        )
    for name, text in VIEW_SQL.items():
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{name} AS {text.replace('{db}', db)}")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def query(spark: SparkSession, sql: str, params: dict | None = None):
    """Run SQL; values are bound as :name parameters, never put into the text."""
    return spark.sql(sql, args=params or {})
