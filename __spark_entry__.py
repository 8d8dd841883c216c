"""Registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

import oracle
from vendaflow.operators.dimensions import dates_seen, first_seen, insert_absent, merge, upsert_type1
from vendaflow.errors import LoadError, SourceError
from vendaflow.operators.fact import build_fact, duplicate_rows, number_sales
from vendaflow.operators.joins import Sized
from vendaflow.operators.quality import quality_report, rejected_by_column
from vendaflow.operators.staging import MARGIN, PROBLEMS, stage
from vendaflow.plans import reports, views
from vendaflow.plans.star import Filters, distinct
from vendaflow.plans.summaries import SummaryStar, build
from vendaflow.plans.warehouse import LoadSummary, Warehouse
from vendaflow.schema import (
    DIM_CLIENTE, DIM_ENVIO, DIM_LOCALIZACAO, DIM_PRODUTO, DIM_TEMPO, HEADERS, TABLES,
)
from vendaflow.session import COMPRESSION, scratch_path, writing
from vendaflow.sources.files import find_source, read_csv
from vendaflow.sources.workbooks import pack_workbooks
from vendaflow.sources.tables import flat_sales
from vendaflow.sources.xlsx import parse_workbooks

try:
    import corpus_pipeline
    from vendaflow.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    # The subpackage, or a library that only it needs, may be missing; a module of its own may not.
    if missing.name.startswith("vendaflow.") and missing.name != "vendaflow.llm":
        raise
    llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]

# The same values as oracle.CHOSEN.
CHOSEN = Filters(
    segmentos=["BUILDING", "MACHINERY"],
    regioes=["ASIA", "EUROPE", "AMERICA"],
    categorias=["ECONOMY", "PROMO", "LARGE"],
    anos=[1996, 1997, 1998],
)

_flat: dict[tuple[str, str], DataFrame] = {}
_loaded: dict[tuple[str, str], Warehouse] = {}
_summaries: dict[tuple[str, str], LoadSummary] = {}
_summed: dict[tuple[str, str], SummaryStar] = {}
_published: dict[str, str] = {}  # session -> folder its catalog shows
EXTRA = ("l_returnflag", "l_linestatus")
PACKED = {"compression": "gzip"}  # of text files; each is as long as the task that writes it


def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat source over the tables of sf_dir; its rows are numbered once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _flat:
        _flat[key] = flat_sales(spark, sf_dir, EXTRA)
    return _flat[key]


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The tables of sf_dir loaded as a warehouse, once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded:
        built = Warehouse(spark, scratch_path(spark, "warehouse"))
        _summaries[key] = built.load(flat(spark, sf_dir))
        _loaded[key] = built
    return _loaded[key]


def plain(df: DataFrame) -> DataFrame:
    """Result types both engines share: DOUBLE for decimals, BIGINT for whole numbers."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.IntegralType):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def on_star(report: Callable, *args, **options) -> Query:
    return lambda spark, sf: plain(report(warehouse(spark, sf).star(), *args, **options))


def summed(spark: SparkSession, sf_dir: str) -> SummaryStar:
    """The warehouse of sf_dir with its stored summaries, built once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _summed:
        build(warehouse(spark, sf_dir))
        _summed[key] = SummaryStar(warehouse(spark, sf_dir))
    return _summed[key]


def on_summaries(report: Callable, *args) -> Query:
    return lambda spark, sf: plain(report(summed(spark, sf), *args))


def distinct_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and customers of each state, region and in all, merged upwards from bitmaps."""
    counts = [distinct("order_id", "pedidos"), distinct("sk_cliente", "clientes")]
    return plain(summed(spark, sf).distinct_rollup(["regiao", "estado"], counts))


def table(name: str, *dropped: str) -> Query:
    return lambda spark, sf: plain(warehouse(spark, sf).star().table(name).drop(*dropped))


def on_sql(text: str, **params) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        house = warehouse(spark, sf)
        if _published.get(spark.sparkContext.applicationId) != house.root:
            views.publish(house)
            _published[spark.sparkContext.applicationId] = house.root
        return plain(views.query(spark, text, params))

    return run


# -- loading steps -----------------------------------------------------------------


def staging_clean(spark: SparkSession, sf: str) -> DataFrame:
    return plain(stage(flat(spark, sf)).drop(PROBLEMS))


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse(spark, sf).staged


def source_totals(source: DataFrame) -> DataFrame:
    """Totals of the fit rows. The unfit are left out by the aggregates: a filter before them would
    be pushed below the parsing, and every value would be parsed for it once more."""
    def fit(column: str) -> Column:
        return F.when(F.col(PROBLEMS).isNull(), F.col(column))

    return plain(
        stage(source)
        .groupBy("segment", "ship_mode", "sub_category")
        .agg(
            F.count_if(F.col(PROBLEMS).isNull()).alias("rows"),
            F.count(fit("postal_code")).alias("postal_codes"),
            F.min(fit("order_date")).alias("first_order"),
            F.max(fit("ship_date")).alias("last_ship"),
            F.max(fit("row_id")).alias("last_row"),
            F.sum(fit("sales")).alias("sales"),
            F.sum(fit("profit")).alias("profit"),
            F.sum(fit("discount")).alias("discount"),
            F.sum(fit("quantity")).alias("quantity"),
            F.sum(fit(MARGIN)).alias("margins"),
        )
        .filter("rows > 0")
    )


def csv_source(language: int, date_format: str) -> Query:
    """Write the flat table as CSV with headers of one language, and read it back."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        texts = [
            F.date_format(names[0], date_format) if c.endswith("_date") else F.col(names[0])
            for c, names in HEADERS.items()
        ]
        path = scratch_path(spark, "csv")
        flat(spark, sf).select(
            *[t.alias(names[language]) for t, names in zip(texts, HEADERS.values())]
        ).write.options(**PACKED, header=True, escape='"').csv(path)
        return source_totals(read_csv(spark, path))

    return run


def mixed_source(spark: SparkSession, sf: str) -> DataFrame:
    """One folder with files in both languages, one of them with its columns turned around."""
    path = scratch_path(spark, "csv")
    for language, odd in ((0, 0), (1, 1)):
        names = list(HEADERS.values())[:: -1 if odd else 1]
        flat(spark, sf).filter(F.col("Row ID") % 2 == odd).select(
            *[F.col(n[0]).alias(n[language]) for n in names]
        ).write.mode("append").options(**PACKED, header=True, escape='"').csv(path)
    return source_totals(read_csv(spark, path))


def malformed_source(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with a field too many or too few, counted by problem."""
    names = [n[0] for n in HEADERS.values()]
    fields = [F.col(n).cast("string") for n in names]
    more = F.when(F.col("l_returnflag") == "R", F.lit(",1"))
    whole = F.concat_ws(",", *[F.coalesce(f, F.lit("")) for f in fields])
    short = F.concat_ws(",", *[F.coalesce(f, F.lit("")) for f in fields[:-1]])
    cut = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")
    line = F.when(cut, short).otherwise(F.concat(whole, F.coalesce(more, F.lit(""))))
    path = scratch_path(spark, "csv")
    # One column whose name is the header line; nothing is quoted.
    flat(spark, sf).select(line.alias(",".join(names))).write.options(
        **PACKED, header=True, sep="\u0001", quote="", escapeQuotes=False
    ).csv(path)
    return plain(rejected_by_column(stage(read_csv(spark, path)).filter(F.col(PROBLEMS).isNotNull())))


def dirty_text(spark: SparkSession, sf: str) -> DataFrame:
    """Padded headers, no discount, null words, postal codes and dates in many forms."""
    row = F.col("Row ID")
    postal = F.element_at(
        F.array(*[F.lit(t) for t in ("NA", " N/A ", "10.0.0", "1.05.0", "#N/A", " 01234 ", "None")]),
        (row % 7 + 1).cast("int"),
    )
    day = F.col("Order Date")
    dates = (
        F.when(row % 5 == 0, day.cast("string"))
        .when(row % 5 == 1, F.date_format(day, "M/d/yyyy"))
        .when(row % 5 == 2, F.concat(F.lit("  "), day.cast("string"), F.lit(" 13:00:00 ")))
        .when(row % 5 == 3, F.date_format(day, "MM-dd-yyyy"))
        .otherwise("12:30")
    )
    texts = flat(spark, sf).withColumns({"Postal Code": postal, "Order Date": dates}).drop("Discount", *EXTRA)
    padded = texts.toDF(*[f"\ufeff {c} " for c in texts.columns])
    return plain(stage(padded).select("row_id", "postal_code", "order_date", "discount", PROBLEMS))


def xlsx_source(spark: SparkSession, sf: str) -> DataFrame:
    return source_totals(parse_workbooks(pack_workbooks(flat(spark, sf).drop(*EXTRA))))


def spoiled(spark: SparkSession, sf: str) -> DataFrame:
    """The flat table with unfit values in five columns, counted by column."""
    col = F.col
    returned = (col("l_returnflag") == "R") & (col("l_linestatus") == "F")
    undated = (col("Segment") == "HOUSEHOLD") & (col("l_linestatus") == "O")
    huge = (col("Category") == "PROMO") & (col("Sales") < 20000)
    values = {
        "Sales": F.when(returned, "NaN").otherwise(col("Sales").cast("string")),
        "Ship Mode": F.when(
            col("Ship Mode") == "4-NOT SPECIFIED", F.repeat("Ship Mode", F.lit(3))
        ).otherwise(col("Ship Mode")),
        "Order Date": F.when(undated, "soon").otherwise(col("Order Date").cast("string")),
        "Customer Name": F.when(col("Region") != "ASIA", col("Customer Name")),
        "Profit": F.when(huge, "987654321.5").otherwise(col("Profit").cast("string")),
    }
    return plain(rejected_by_column(stage(flat(spark, sf).withColumns(values))))


def first_wins(spark: SparkSession, sf: str) -> DataFrame:
    """Product ids made to clash, so that each carries many names."""
    clash = F.concat(F.lit("P"), (F.substring("product_id", 2, 20).cast("bigint") % 50))
    rows = staged(spark, sf).withColumn("product_id", clash.cast("string"))
    return plain(first_seen(rows, DIM_PRODUTO).drop("_first"))


def upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A second file: names in capitals, urgent sales under new ids, no PROMO products."""
    existing = warehouse(spark, sf).star().table("dim_produto")
    urgent = F.col("ship_mode") == "1-URGENT"
    new_id = F.concat(F.lit("X"), "product_id")
    second = (
        staged(spark, sf)
        .filter(F.col("category") != "PROMO")
        .withColumn("product_id", F.when(urgent, new_id).otherwise(F.col("product_id")))
        .withColumn("product_name", F.upper("product_name"))
    )
    return plain(upsert_type1(existing, first_seen(second, DIM_PRODUTO), DIM_PRODUTO))


def upsert_customers(spark: SparkSession, sf: str) -> DataFrame:
    """A second file: names in capitals, no MACHINERY, buyers of urgent sales under new ids."""
    existing = warehouse(spark, sf).star().table("dim_cliente")
    urgent = F.col("ship_mode") == "1-URGENT"
    second = (
        staged(spark, sf)
        .filter(F.col("segment") != "MACHINERY")
        .withColumn("customer_id", F.when(urgent, F.concat(F.lit("X"), "customer_id")).otherwise(F.col("customer_id")))
        .withColumn("customer_name", F.upper("customer_name"))
    )
    return plain(upsert_type1(existing, first_seen(second, DIM_CLIENTE), DIM_CLIENTE))


def second_ship_modes(spark: SparkSession, sf: str) -> DataFrame:
    """A second file in which two of the ship modes have other names."""
    existing = warehouse(spark, sf).star().table("dim_envio")
    other = F.when(F.col("ship_mode").isin("2-HIGH", "5-LOW"), F.concat(F.lit("NEW "), "ship_mode"))
    second = staged(spark, sf).withColumn("ship_mode", F.coalesce(other, "ship_mode"))
    return plain(merge(existing, second, DIM_ENVIO))


def late_null_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names only on the first row of each product: the load takes them from there."""
    # Written first, so that what the source shuffles is gone before whole rows meet their product.
    source, place = flat(spark, sf).drop(*EXTRA), scratch_path(spark, "flat")
    with writing(spark):
        source.write.parquet(place, compression=COMPRESSION)
    rows = spark.read.schema(source.schema).parquet(place)
    first = rows.groupBy(F.col("Product ID").alias("_p")).agg(F.min("Row ID").alias("_row"))
    named = rows.join(first, rows["Product ID"] == first["_p"]).withColumn(
        "Product Name", F.when(F.col("Row ID") == F.col("_row"), F.col("Product Name"))
    )
    house = Warehouse(spark, scratch_path(spark, "warehouse"))
    house.load(named.drop("_p", "_row"))
    return plain(house.star().table("dim_produto"))


def dates_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Dates of rows some of which have no order date."""
    gaps = F.when(F.col("row_id") % 3 != 0, F.col("order_date"))
    dated = staged(spark, sf).withColumn("order_date", gaps)
    return plain(insert_absent(None, dates_seen(dated), DIM_TEMPO))


def later_dates(spark: SparkSession, sf: str) -> DataFrame:
    """A second file with every date a year later."""
    existing = warehouse(spark, sf).star().table("dim_tempo")
    second = staged(spark, sf).select(
        F.date_add("order_date", 365).alias("order_date"),
        F.date_add("ship_date", 365).alias("ship_date"),
    )
    return plain(insert_absent(existing, dates_seen(second), DIM_TEMPO))


def locations_again(spark: SparkSession, sf: str) -> DataFrame:
    """The same file a second time: no location is added, missing postal codes included."""
    existing = warehouse(spark, sf).star().table("dim_localizacao")
    return plain(merge(existing, staged(spark, sf), DIM_LOCALIZACAO))


def gap_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The fact over row ids with gaps, which must still be numbered without any."""
    house = warehouse(spark, sf)
    rows = staged(spark, sf).withColumn("row_id", F.col("row_id") * 3 + 5)
    fact = build_fact(number_sales(rows), house.tables(), house.limit)
    return plain(fact.drop("ano_pedido"))


def load_summary(spark: SparkSession, sf: str) -> DataFrame:
    """What the load reported: rows per dimension, and the sales."""
    warehouse(spark, sf)
    return told(spark, _summaries[spark.sparkContext.applicationId, sf], {"fato_vendas": "loaded"})


def told(spark: SparkSession, summary: LoadSummary, counts: dict[str, str]) -> DataFrame:
    lines = [*summary.members.items(), *[(n, getattr(summary, field)) for n, field in counts.items()]]
    return spark.createDataFrame(lines, "name string, rows bigint")


def lenient_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The report of a load that sets unfit rows aside."""
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    value = F.when(returned, "NaN").otherwise(F.col("Sales").cast("string"))
    house = Warehouse(spark, scratch_path(spark, "warehouse"))
    summary = house.load(flat(spark, sf).withColumn("Sales", value), strict=False)
    return told(spark, summary, {n: n for n in ("extracted", "loaded", "rejected")})


def gates(spark: SparkSession, sf: str) -> DataFrame:
    """What each gate of a load finds: columns, row ids, members, files and readiness."""
    rows, found = flat(spark, sf), []
    try:
        stage(rows.drop("Sales", "Profit"))
    except SourceError as failure:
        found.append(("missing columns", str(failure).rpartition(": ")[2]))
    again = staged(spark, sf).unionByName(staged(spark, sf).filter(F.col("ship_mode") == "5-LOW"))
    found.append(("repeated row ids", str(duplicate_rows(again).count())))
    try:
        number_sales(again)
    except LoadError as failure:
        found.append(("repeated row ids", str(failure).partition(",")[0]))
    house = warehouse(spark, sf)
    dims = {n: t for n, t in house.tables().items() if n != "fato_vendas"}
    fewer = dims["dim_produto"].df.filter("categoria <> 'PROMO'")
    dims["dim_produto"] = Sized(fewer, dims["dim_produto"].rows, dims["dim_produto"].bytes)
    fact = build_fact(number_sales(staged(spark, sf)), dims, house.limit)
    found.append(("unknown members", str(fact.filter("sk_produto IS NULL").count())))
    folder = scratch_path(spark, "inbox")
    rows.drop(*EXTRA).write.options(**PACKED, header=True).csv(f"{folder}/second.csv")
    path = find_source(spark, folder, ["first.csv", "second.csv", "third.csv"])
    found.append(("source found", path.rpartition("/")[2]))
    new = Warehouse(spark, scratch_path(spark, "warehouse"))
    found.append(("ready before create", str(new.ready())))
    new.create()
    found.append(("tables after create", str(len(new.entries()))))
    found.append(("ready after create", str(new.ready())))
    found.append(("ready after load", str(house.ready())))
    return spark.createDataFrame(found, "gate string, found string")


def positioned(rows: DataFrame) -> DataFrame:
    """The rows of a sorted report of bounded size with their position in it."""
    placed = rows.withColumn("_at", F.monotonically_increasing_id())
    position = F.row_number().over(Window.orderBy("_at"))
    return placed.select(*rows.columns, position.alias("posicao"))


def in_order(report: Callable) -> Query:
    return lambda spark, sf: plain(positioned(report(warehouse(spark, sf).star())))


def options_in_order(spark: SparkSession, sf: str) -> DataFrame:
    lists = reports.filter_options(warehouse(spark, sf).star())
    parts = [
        positioned(df).select(F.lit(kind).alias("tipo"), F.col(df.columns[0]).cast("string").alias("valor"), "posicao")
        for kind, df in lists.items()
    ]
    return plain(reduce(DataFrame.unionByName, parts))


def quality_spoiled(spark: SparkSession, sf: str) -> DataFrame:
    """The report over tables that break four kinds of rule: lengths, NULLs, keys, members."""
    tables = {n: t.df for n, t in warehouse(spark, sf).tables().items()}
    wrong = F.col("ano_pedido") == 1996
    tables["fato_vendas"] = tables["fato_vendas"].withColumns({
        "order_id": F.when(wrong, F.lit("x" * 31)).otherwise(F.col("order_id")),
        "lucro": F.when(~wrong, F.col("lucro")),
        "sk_produto": F.when(wrong, -1).otherwise(F.col("sk_produto")).cast("bigint"),
    })
    tables["dim_envio"] = tables["dim_envio"].unionByName(tables["dim_envio"])
    return plain(quality_report({n: tables[n] for n in TABLES}))


def filter_options(spark: SparkSession, sf: str) -> DataFrame:
    lists = reports.filter_options(warehouse(spark, sf).star())
    first, *rest = [
        df.select(F.lit(kind).alias("tipo"), F.col(df.columns[0]).cast("string").alias("valor"))
        for kind, df in lists.items()
    ]
    for one in rest:
        first = first.unionByName(one)
    return first


def quality(spark: SparkSession, sf: str) -> DataFrame:
    tables = warehouse(spark, sf).tables()
    return plain(quality_report({n: t.df for n, t in tables.items()}))


def mean_of_means(spark: SparkSession, sf: str) -> DataFrame:
    rows = plain(reports.ticket_mean_of_means(warehouse(spark, sf).star()))
    return rows.withColumn("ticket_medio", F.round("ticket_medio", 6))


SQL_PARAMS = """
    SELECT regiao, estado, ano_mes, sum(vendas) AS receita, count(*) AS vendas
    FROM dw.vw_vendas_detalhadas WHERE regiao = :regiao AND ano = :ano
    GROUP BY regiao, estado, ano_mes
"""


def queries() -> dict[str, Query]:
    registered: dict[str, Query] = {
        "staging_clean": staging_clean,
        "source_csv_english": csv_source(0, "M/d/yyyy"),
        "source_csv_portuguese": csv_source(1, "yyyy-MM-dd"),
        "source_csv_mixed": mixed_source,
        "source_csv_malformed": malformed_source,
        "staging_dirty_text": dirty_text,
        "source_xlsx": xlsx_source,
        "rejected_rows": spoiled,
        "dim_tempo": table("dim_tempo"),
        "dim_produto": table("dim_produto"),
        "dim_cliente": table("dim_cliente"),
        "dim_localizacao": table("dim_localizacao"),
        "dim_envio": table("dim_envio"),
        "dim_produto_first_wins": first_wins,
        "dim_upsert_type1": upsert,
        "dim_upsert_cliente": upsert_customers,
        "dim_envio_second_load": second_ship_modes,
        "dim_produto_late_null": late_null_names,
        "dim_tempo_null_dates": dates_with_gaps,
        "dim_insert_absent": later_dates,
        "dim_localizacao_rerun": locations_again,
        "fato_vendas": table("fato_vendas", "ano_pedido"),
        "fato_vendas_gap_ids": gap_ids,
        "load_summary": load_summary,
        "load_summary_lenient": lenient_summary,
        "load_gates": gates,
        "tab_subcategorias_order": in_order(reports.subcategorias),
        "tab_habitos_order": in_order(reports.habitos),
        "tab_estados_order": in_order(reports.estados),
        "filter_options_order": options_in_order,
        "quality_report_spoiled": quality_spoiled,
        "kpi_all": on_star(reports.kpi),
        "kpi_filtered": on_star(reports.kpi, CHOSEN),
        "kpi_empty": on_star(reports.kpi, Filters(regioes=["ATLANTIS"])),
        "kpi_formatted": on_star(reports.kpi_formatted),
        "tab_subcategorias": on_star(reports.subcategorias),
        "subcat_top10": on_star(reports.subcategorias_ranked),
        "subcat_bottom10": on_star(reports.subcategorias_ranked, best=False),
        "tab_produtos": on_star(reports.produtos),
        "prod_top15": on_star(reports.produtos_ranked),
        "prod_bottom15": on_star(reports.produtos_ranked, best=False),
        "prod_bottom15_filtered": on_star(reports.produtos_ranked, CHOSEN, best=False),
        "tab_estados": on_star(reports.estados),
        "tab_estados_filtered": on_star(reports.estados, CHOSEN),
        "estados_rollup": on_star(reports.estados_rollup),
        "tab_habitos": on_star(reports.habitos),
        "tab_habitos_filtered": on_star(reports.habitos, CHOSEN),
        "ticket_mean_of_means": mean_of_means,
        "modo_envio": on_star(reports.modo_envio),
        "modo_envio_rollup": on_star(reports.modo_envio_rollup),
        "tab_mensal": on_star(reports.mensal),
        "tab_mensal_filtered": on_star(reports.mensal, CHOSEN),
        "filter_options": filter_options,
        "quality_report": quality,
        "resumo_vw_vendas_lucro_estado": on_summaries(reports.vendas_lucro_estado),
        "resumo_vw_habitos_compra_segmento": on_summaries(reports.habitos_compra_segmento),
        "resumo_tab_estados": on_summaries(reports.estados),
        "resumo_tab_habitos": on_summaries(reports.habitos),
        "resumo_tab_estados_filtered": on_summaries(reports.estados, CHOSEN),
        "resumo_tab_subcategorias": on_summaries(reports.subcategorias),
        "resumo_tab_mensal_filtered": on_summaries(reports.mensal, CHOSEN),
        "resumo_kpi_filtered": on_summaries(reports.kpi, CHOSEN),
        "resumo_modo_envio_rollup": on_summaries(reports.modo_envio_rollup),
        "resumo_distinct_rollup": distinct_rollup,
        "sql_params": on_sql(SQL_PARAMS, regiao="EUROPE", ano=1997),
    }
    for name, report in reports.VIEWS.items():
        registered[name] = on_star(report)
        registered[f"sql_{name}"] = on_sql(f"SELECT * FROM dw.{name}")
    if llm_queries:
        registered |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return registered


def oracle_sql() -> dict[str, str]:
    sql = oracle.oracles()
    if llm_queries:
        sql |= llm_queries.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql


def entry(spark: SparkSession) -> DataFrame:
    """Revenue, profit, quantity and margin by sub-category."""
    return queries()["vw_receita_lucro_subcategoria"](spark, "/root/testdata/sf0.001")
