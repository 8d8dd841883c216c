import io
import re
from contextlib import redirect_stdout
from decimal import Decimal

import pytest
from data import rows, sales

from vendaflow.plans import reports
from vendaflow.plans.star import Filters, Star
from vendaflow.plans.warehouse import Warehouse

FILTERS = Filters(["BUILDING", "MACHINERY"], ["ASIA", "EUROPE"], ["PROMO", "LARGE"], [1996, 1997])
FILTERED = {**reports.REPORTS, "top": reports.subcategorias_ranked, "low": reports.produtos_ranked}


def plan(df) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def small(spark, path, *changes):
    house = Warehouse(spark, str(path))
    house.load(sales(spark, *changes))
    return house.star()


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("name", [*FILTERED, *reports.VIEWS])
def test_dimensions_too_large_to_broadcast_give_the_same(spark, conf, house, name):
    star = house.star()
    big = Star(star.tables, limit=0)
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    if name in FILTERED:
        same(FILTERED[name](star, FILTERS), FILTERED[name](big, FILTERS))
        same(FILTERED[name](star), FILTERED[name](big))
    else:
        same(reports.VIEWS[name](star), reports.VIEWS[name](big))


@pytest.mark.parametrize("name", FILTERED)
def test_shared_rows_give_the_same(house, name):
    star = house.star()
    with star.shared(FILTERS) as shared:
        same(FILTERED[name](star, FILTERS), FILTERED[name](shared, FILTERS))


def test_shared_rows_refuse_other_filters(house):
    with pytest.raises(ValueError):
        reports.kpi(house.star().shared(FILTERS), Filters(anos=[1995]))


def test_only_named_dimensions_are_joined(house):
    text = plan(reports.receita_lucro_subcategoria(house.star()))
    assert "dim_produto" in text
    for other in ("dim_tempo", "dim_cliente", "dim_localizacao", "dim_envio"):
        assert other not in text
    assert "dim_" not in plan(reports.kpi(house.star(), Filters(anos=[1996])))


def test_year_filter_prunes_partitions_and_columns(house):
    text = plan(reports.kpi(house.star(), Filters(anos=[1996])))
    assert re.search(r"PartitionFilters: \[.*ano_pedido#\d+L? = 1996", text)
    assert "order_id" not in text


def test_filters_reach_the_dimension_scan(house):
    text = plan(reports.kpi(house.star(), Filters(categorias=["PROMO"])))
    assert "PushedFilters: [In(categoria" in text or "EqualTo(categoria,PROMO)" in text
    assert "BroadcastHashJoin" in text


def test_rankings_do_not_sort_everything(house):
    text = plan(reports.subcategorias_ranked(house.star()))
    assert "TakeOrderedAndProject" in text and "\nSort" not in text


@pytest.mark.parametrize("name", [*FILTERED, *reports.VIEWS])
def test_no_python_in_the_plan(house, name):
    text = plan({**FILTERED, **reports.VIEWS}[name](house.star()))
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text


def test_large_path_sums_before_the_join(spark, conf, house):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(reports.rentabilidade_produto(Star(house.tables(), limit=0)))
    tree = text[: text.index("(1) Scan")]
    join = tree.index("SortMergeJoin")
    assert "HashAggregate" in tree[join:]


def test_no_choice_means_no_filter(house):
    star = house.star()
    same(reports.kpi(star), reports.kpi(star, Filters([], [], [], [])))


def test_unknown_value_gives_nothing(house):
    star, unknown = house.star(), Filters(segmentos=["nobody"])
    assert reports.kpi(star, unknown).first()[:] == (0, 0, 0, 0)
    assert reports.mensal(star, unknown).isEmpty()


def test_year_of_ship_dates_only(spark, tmp_path):
    star = small(spark, tmp_path, {"order_date": "2017-12-30", "ship_date": "2018-01-02"})
    options = reports.filter_options(star)
    assert [r.ano for r in options["anos"].collect()] == [2017, 2018]
    assert reports.mensal(star, Filters(anos=[2018])).isEmpty()


def test_fewer_groups_than_asked(house, spark, tmp_path):
    star = small(spark, tmp_path, {}, {"product_id": "P2", "sub_category": "Axes"})
    assert reports.subcategorias_ranked(star).count() == 2


def test_ties_are_broken_by_the_keys(spark, tmp_path):
    names = ["Saws", "Axes", "Nails"]
    star = small(
        spark, tmp_path, *[{"product_id": n, "sub_category": n} for n in names]
    )
    for best in (True, False):
        found = reports.subcategorias_ranked(star, count=2, best=best).collect()
        assert [r.subcategoria for r in found] == ["Axes", "Nails"]


def test_mean_of_monthly_means(spark, tmp_path):
    cheap = [{"sales": "10", "profit": "1"}] * 9
    dear = {"sales": "20", "profit": "1", "order_date": "2017-02-01"}
    star = small(spark, tmp_path, *cheap, dear)
    assert reports.ticket_mean_of_means(star).first().ticket_medio == 15


def test_products_sharing_a_name(spark, tmp_path):
    star = small(spark, tmp_path, {}, {"product_id": "P2"})
    assert reports.rentabilidade_produto(star).count() == 2
    assert reports.produtos(star).count() == 1


def test_rollup_with_zero_revenue(spark, tmp_path):
    star = small(
        spark, tmp_path, {"sales": "0", "profit": "3"},
        {"state": "B", "region": "Q", "sales": "30", "profit": "6"},
        {"state": "C", "region": "Q", "sales": "10", "profit": "2"},
    )
    found = rows(reports.estados_rollup(star), "regiao", "estado", "nivel", "lucro_ponderado")
    assert ("R", None, 1, None) in found and ("Q", None, 1, 5.0) in found
    assert (None, None, 3, 5.0) in found


def test_totals_agree(house):
    star = house.star()
    receita, lucro, itens, _ = reports.kpi(star).first()
    for view in ("vw_receita_lucro_subcategoria", "vw_rentabilidade_produto",
                 "vw_vendas_lucro_estado", "vw_vendas_mensais"):
        sums = reports.VIEWS[view](star).groupBy().sum("receita_total", "lucro_total").first()
        assert sums[:] == (receita, lucro)
    assert isinstance(receita, Decimal) and itens > 0
