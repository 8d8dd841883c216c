"""What a load and the reports shuffle: keys and numbers, not texts."""

from dataclasses import replace

import __spark_entry__ as entry
from conftest import SF
from test_lookup import wide_exchanges
from test_star import plan, same

from vendaflow.operators.fact import build_fact, number_sales
from vendaflow.operators.joins import measure
from vendaflow.operators.numbering import number_rows
from vendaflow.operators.staging import PROBLEMS, stage
from vendaflow.plans import reports
from vendaflow.plans.layout import carried, with_places
from vendaflow.plans.star import COUNTED_ROWS, SUMMED, Filters, Star, distinct, grouped, total
from vendaflow.session import list_files, shared_folder
from vendaflow.sources.tables import flat_sales


def test_stored_attributes_of_large_dimensions_need_no_join(house):
    star = house.star()
    big, plain = Star(star.tables, 0, star.zones), Star(star.tables, star.limit)
    for report in (reports.receita_lucro_subcategoria, reports.subcategorias):
        assert "dim_" not in plan(report(big))
        for filters in (Filters(), Filters(["BUILDING"], ["ASIA"], ["PROMO", "LARGE"], [1996]), Filters(regioes=["ATLANTIS"])):
            options = () if report is reports.receita_lucro_subcategoria else (filters,)
            same(report(big, *options), report(plain, *options))
    both = reports.rentabilidade_produto
    assert "dim_produto" in plan(both(big))
    same(both(big), both(plain))


def test_files_of_an_older_load_hold_fewer_attributes(house):
    star = house.star()
    older = type(star.zones)(star.zones.files.drop("z_subcategoria_min"), star.zones.fact_path)
    assert "dim_produto" in plan(reports.subcategorias(Star(star.tables, 0, older)))


def test_descriptions_do_not_make_a_lookup_large(spark, conf, house):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    rows = number_sales(stage(flat_sales(spark, "/root/testdata/sf0.001")).drop(PROBLEMS).localCheckpoint())
    dims = with_places(house.tables())
    product = dims["dim_produto"]
    keys = product.df.select("product_id", "sk_produto", *carried()["produto"])
    limit = measure(keys, product.rows, 1 << 40).bytes
    assert limit < product.bytes
    dims = {n: d if n == "dim_produto" else replace(d, bytes=0) for n, d in dims.items()}
    small, none = (build_fact(rows, dims, n, carried()) for n in (limit, limit - 1))
    assert wide_exchanges(small.withColumnRenamed("vendas", "sales")) == 0
    same(small.drop(*sum(carried().values(), [])), none.drop(*sum(carried().values(), [])))
    assert "SortMergeJoin" in plan(none) and "SortMergeJoin" not in plan(small)


def test_columns_that_only_order_are_not_written(spark):
    rows = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k long, v string")
    found = number_rows(rows, ["k"], "n", kept=["v"])
    assert found.columns == ["v", "n"]
    assert sorted(map(tuple, found.collect())) == [("a", 1), ("b", 2), ("c", 3)]


def test_flat_files_are_packed(spark):
    entry.queries()["source_csv_english"](spark, SF)
    files = list_files(spark, f"{shared_folder(spark)}/vendaflow/*/csv-*")
    assert files and all(f.endswith(".csv.gz") for f in files)


def test_distinct_counts_hold_a_bounded_number_of_sales(conf, house):
    conf(spark__sql__adaptive__enabled="false")
    star = house.star()
    fact = replace(star.tables["fato_vendas"], rows=6 * COUNTED_ROWS + 1)
    many = Star({**star.tables, "fato_vendas": fact}, star.limit, star.zones)
    for report in (reports.habitos, reports.habitos_compra_segmento, reports.estados):
        same(report(star), report(many))
        text = report(many)._jdf.queryExecution().executedPlan().toString()
        first, *dealt = text.split("REPARTITION_BY_NUM")
        assert first.rpartition("\n")[2].count(", 7)") == 1 and len(dealt) == (1 if report is reports.estados else 2)
        for below in dealt:  # nothing is gathered before the sales are dealt
            scan = below.partition("FileScan")[0]
            assert "Aggregate" not in scan and "Expand" not in scan


def test_counts_of_parts_add_up(spark):
    schema = "g string, order_id string, sk_cliente long, vendas decimal(12,2), lucro decimal(12,2), quantidade int, linhas int"
    values = [("a", "1", 1), ("a", "1", 2), ("a", None, 2), ("a", "3", None), (None, "1", 1), (None, "1", 1), ("b", None, None)]
    df = spark.createDataFrame([(*v, None, None, 2, 1) for v in values], schema)
    measures = [distinct("sk_cliente", "c"), distinct("order_id", "o"), total("quantidade", "q"), total("vendas", "v")]
    for rows in (df, df.limit(0)):
        for by in (["g"], []):
            same(grouped(rows, by, measures, 3), rows.groupBy(*by).agg(*[m.column for m in measures]))
    assert set(SUMMED) < set(df.columns)
