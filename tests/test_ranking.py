"""The first lines of a ranking from few members of a large dimension."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vendaflow.plans import reports
from vendaflow.plans.ranking import Ranking, contenders, most_namesakes
from vendaflow.plans.star import Filters
from vendaflow.plans.warehouse import Warehouse
from vendaflow.sources.tables import flat_sales

NAMES = ["nome_produto", "categoria", "subcategoria"]
KINDS = {
    "signed": lambda r: r.randint(-1000, 1000),
    "losses only": lambda r: -r.randint(1, 1000),
    "profits only": lambda r: r.randint(1, 1000),
    "ties": lambda r: r.choice([-1, 0, 1]),
    "zeros": lambda r: 0,
}


def built(spark, members, limit):
    """members: (key, name, value). Half of the names are missing a category."""
    sums = [(k, Decimal(0), Decimal(v), 0, 1) for k, _, v in members]
    names = [(k, n, None if n and n[-1] in "02468" else "c", "s") for k, n, _ in members]
    return Ranking(
        spark.createDataFrame(sums, "sk_produto bigint, vendas decimal(22,4), lucro decimal(22,4), quantidade bigint, linhas bigint"),
        spark.createDataFrame(names, "sk_produto bigint, nome_produto string, categoria string, subcategoria string"),
        "sk_produto", NAMES, most_namesakes(spark.createDataFrame(names, "k bigint, a string, b string, c string"), ["a", "b", "c"]), limit,
    )


def totals(members):
    found = {}
    for _, name, value in members:
        found[name] = found.get(name, 0) + value
    return found


@pytest.mark.parametrize("best, limit", [(True, 0), (False, 1 << 30)])
@pytest.mark.parametrize("kind", KINDS)
def test_no_line_among_the_first_is_missed(spark, conf, kind, best, limit):
    conf(spark__sql__shuffle__partitions="2")
    draw = random.Random(f"{kind}{best}")
    members = [(k, draw.choice([None, *(f"n{i}" for i in range(40))]), KINDS[kind](draw)) for k in range(120)]
    members += [(200 + k, f"own{k}", KINDS[kind](draw)) for k in range(60)]
    ranking, sign = built(spark, members, limit), 1 if best else -1
    expected = totals(members)
    ordered = sorted((sign * v for v in expected.values()), reverse=True)
    bound = ranking.bound("lucro", 5, best)
    assert bound is not None and bound <= ordered[4]
    left = ranking.candidates("lucro", bound, best)
    lines = ranking.lines(left, left.count(), [F.sum("lucro").alias("lucro")]).collect()
    found = {r.nome_produto: int(r.lucro) for r in lines}
    assert all(expected[n] == v for n, v in found.items())  # whole lines only
    assert {n for n, v in expected.items() if sign * v >= ordered[4]} <= set(found)


def test_few_members_are_named(spark):
    draw = random.Random(5)
    members = [(k, f"n{k // 2}", int(draw.gauss(0, 1000))) for k in range(20_000)]
    ranking = built(spark, members, 1 << 30)
    for best in (True, False):
        assert ranking.most == 2
        assert ranking.candidates("lucro", ranking.bound("lucro", 15, best), best).count() < 1_500


def test_fewer_lines_than_asked_for(spark):
    ranking = built(spark, [(1, "a", 5), (2, "a", -9), (3, "b", 1)], 1 << 30)
    assert ranking.bound("lucro", 5, True) is None
    assert ranking.candidates("lucro", None, True).count() == 3
    empty = Ranking(ranking.sums.limit(0), ranking.members, *(getattr(ranking, f) for f in ("key", "names", "most", "limit")))
    assert empty.bound("lucro", 1, True) is None
    assert empty.lines(empty.sums, 0, [F.sum("lucro").alias("lucro")]).collect() == []


@pytest.fixture(scope="module")
def narrow(spark, tmp_path_factory):
    """The same tables where no dimension may be broadcast."""
    built = Warehouse(spark, str(tmp_path_factory.mktemp("narrow")), broadcast_bytes=0)
    built.load(flat_sales(spark, "/root/testdata/sf0.001"))
    return built


@pytest.mark.parametrize("filters", [Filters(), Filters(segmentos=["BUILDING"]), Filters(anos=[1995, 1996]), Filters(categorias=["nothing"])])
def test_reports_as_with_a_small_dimension(house, narrow, filters):
    star = narrow.star()
    assert star.namesakes["dim_produto"] >= 1 and house.star().namesakes == {}
    for best in (True, False):
        assert contenders(star, "produto", reports.PRODUCT, reports.PRODUCT_SUMS, "lucro", filters, 15, best) is not None
        found = reports.produtos_ranked(star, filters, best=best).collect()
        assert found == reports.produtos_ranked(house.star(), filters, best=best).collect()


def test_plain_way_where_the_steps_do_not_apply(narrow):
    star = narrow.star()
    ask = (reports.PRODUCT, reports.PRODUCT_SUMS, "lucro")
    star.namesakes = {"dim_produto": 10_000}
    assert contenders(star, "produto", *ask, Filters(), 15, True) is None
    star.namesakes, star.zones = {"dim_produto": 1}, None
    assert contenders(star, "produto", *ask, Filters(segmentos=["BUILDING"]), 15, True) is None


def test_counts_go_with_their_load(spark, narrow):
    from vendaflow.session import list_folders

    narrow.load(flat_sales(spark, "/root/testdata/sf0.001"))
    assert len(list_folders(spark, f"{narrow.root}/namesakes")) == 2
    narrow.vacuum(1)
    assert len(list_folders(spark, f"{narrow.root}/namesakes")) == 1
    assert narrow.star().namesakes
