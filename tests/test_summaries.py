"""Reports from stored summaries equal those from the fact."""

import pytest
from data import sales
from pyspark.sql import functions as F
from test_star import FILTERED, FILTERS, same

from vendaflow.errors import LoadError
from vendaflow.plans import reports
from vendaflow.plans.star import Filters, distinct
from vendaflow.plans.summaries import SUMMARIES, Summary, SummaryStar, build, distinct_counts
from vendaflow.plans.warehouse import Warehouse

ORDERS, CUSTOMERS = distinct("order_id", "pedidos"), distinct("sk_cliente", "clientes")


@pytest.fixture(scope="module")
def summed(house):
    build(house)
    return SummaryStar(house)


@pytest.mark.parametrize("name", FILTERED)
def test_filtered_reports(house, summed, name):
    star = house.star()
    for filters in (Filters(), FILTERS, Filters(segmentos=["BUILDING"], anos=[1996])):
        same(FILTERED[name](summed, filters), FILTERED[name](star, filters))


@pytest.mark.parametrize("name", [n for n in reports.VIEWS if n != "vw_vendas_detalhadas"])
def test_views(house, summed, name):
    same(reports.VIEWS[name](summed), reports.VIEWS[name](house.star()))


def test_the_smallest_that_covers_is_taken(summed):
    assert summed.choose(["regiao", "estado"], ["order_id"], Filters()) == "estado"
    assert summed.choose(["regiao", "estado"], ["order_id"], Filters(categorias=["PROMO"])) is None
    assert summed.choose(["regiao", "estado"], [], Filters(categorias=["PROMO"])) == "local"
    assert summed.choose(["nome_produto"], [], Filters()) is None
    assert summed.choose([], [], Filters()) == min(summed.rows, key=lambda n: (summed.rows[n], n))


def test_answers_do_not_touch_the_fact(summed):
    for report in (reports.vendas_lucro_estado, reports.habitos_compra_segmento, reports.kpi):
        assert not any("fato_vendas" in f for f in report(summed).inputFiles())


def test_rollup_of_distinct_counts(house, summed):
    by = ["regiao", "estado"]
    found = summed.distinct_rollup(by, [ORDERS, CUSTOMERS])
    plain = house.star().lines(by).rollup(*by).agg(
        F.grouping_id().cast("int").alias("nivel"), ORDERS.column, CUSTOMERS.column
    )
    same(found, plain)
    with pytest.raises(LoadError):
        summed.distinct_rollup(["cidade"], [ORDERS])


def test_keys_over_many_buckets(spark):
    """Keys on both sides of the limits of a bitmap, in overlapping groups."""
    keys = [1, 2, 32768, 32769, 65536, 65537, 10**6, 10**12, 10**12 + 1, 2**40]
    rows = [(g, "order_id", k) for g in range(4) for i, k in enumerate(keys) if i % (g + 1) == 0]
    bits = spark.createDataFrame(rows, "g int, counted string, key bigint").groupBy(
        "g", "counted", F.bitmap_bucket_number("key").alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bits"))
    per_group = {r.g: r.pedidos for r in distinct_counts(bits, ["g"], [ORDERS]).collect()}
    assert per_group == {g: len({k for h, _, k in rows if h == g}) for g in range(4)}
    assert distinct_counts(bits, [], [ORDERS, CUSTOMERS]).first() == (len(keys), 0)


def test_summaries_of_another_load_are_not_used(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    few = {n: SUMMARIES[n] for n in ("estado",)}
    house.load(sales(spark, {}, {"order_id": "B"}))
    build(house, few)
    assert SummaryStar(house, few).rows == {"estado": 1}
    assert reports.estados(SummaryStar(house, few)).first().pedidos == 2
    house.load(sales(spark, {}, {"order_id": "B"}, {"order_id": "C"}))
    later = SummaryStar(house, few)
    assert later.rows == {} and reports.estados(later).first().pedidos == 3


def test_covers():
    summary = Summary(["a", "b"], ["x"])
    assert summary.covers(["a"], ["x"]) and not summary.covers(["c"], []) and not summary.covers(["a"], ["y"])
