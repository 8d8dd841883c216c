from decimal import Decimal

import pytest
from data import rows, sales

from vendaflow.errors import LoadError
from vendaflow.operators.fact import build_fact, number_sales
from vendaflow.operators.staging import stage
from vendaflow.plans import reports, views
from vendaflow.plans.warehouse import Warehouse


@pytest.fixture
def empty(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "house"))


FACT = ("sk_venda", "row_id", "sk_produto", "sk_localizacao", "vendas", "margem_lucro_pct")


def test_load(spark, empty):
    source = sales(
        spark,
        {"postal_code": None}, {"postal_code": "10.0", "product_id": "P2"},
        {"sales": "0", "profit": "5"}, {"sales": "-10", "profit": "5"},
    )
    summary = empty.load(source)
    assert (summary.extracted, summary.loaded, summary.rejected) == (4, 4, 0)
    assert summary.members["dim_produto"] == 2 and summary.members["dim_tempo"] == 2
    d = Decimal
    assert rows(empty.star().table("fato_vendas"), *FACT) == {
        (1, 1, 1, 1, d(200), d(25)), (2, 2, 2, 2, d(200), d(25)),
        (3, 3, 1, 2, d(0), d(0)), (4, 4, 1, 2, d(-10), d(-50)),
    }


def test_same_load_twice_changes_nothing(spark, empty):
    source = sales(spark, {}, {"postal_code": None}, {"product_id": "P2", "ship_mode": "Slow"})
    empty.load(source)
    before = {n: rows(t.df) for n, t in empty.tables().items()}
    empty.load(source)
    assert {n: rows(t.df) for n, t in empty.tables().items()} == before


def test_second_load_replaces_the_fact_and_keeps_keys(spark, empty):
    empty.load(sales(spark, {}, {"product_id": "P2"}))
    empty.load(sales(spark, {"product_id": "P3"}, {"product_id": "P2", "product_name": "New"}))
    star = empty.star()
    found = rows(star.table("dim_produto"), "sk_produto", "product_id", "nome_produto")
    assert found == {(1, "P1", "Saw"), (2, "P2", "New"), (3, "P3", "Saw")}
    assert rows(star.table("fato_vendas"), "row_id", "sk_produto") == {(1, 3), (2, 2)}


def test_readers_of_the_old_load_are_not_disturbed(spark, empty):
    empty.load(sales(spark, {}))
    old = empty.star()
    empty.load(sales(spark, {}, {}))
    assert old.table("fato_vendas").count() == 1
    assert empty.star().table("fato_vendas").count() == 2


def test_strict_load_stops_and_changes_nothing(spark, empty):
    empty.load(sales(spark, {}))
    with pytest.raises(LoadError, match="order_date"):
        empty.load(sales(spark, {}, {"order_date": "bad"}))
    assert empty.star().table("fato_vendas").count() == 1


def test_lenient_load_sets_unfit_rows_aside(spark, empty):
    summary = empty.load(sales(spark, {}, {"order_date": "bad"}, {"sales": "NaN"}), strict=False)
    assert (summary.extracted, summary.loaded, summary.rejected) == (3, 1, 2)
    aside = spark.read.parquet(f"{empty.root}/rejected/*")
    assert rows(aside, "row_id", "problems") == {(2, "order_date"), (3, "sales")}


def test_repeated_row_id(spark, empty):
    with pytest.raises(LoadError, match="row_id occurs more than once.*7"):
        empty.load(sales(spark, {"row_id": "7"}, {"row_id": "7"}, {"row_id": "8"}))
    assert empty.entries() == []


def test_row_ids_with_gaps_are_numbered_densely(spark, empty):
    empty.load(sales(spark, {"row_id": "100"}, {"row_id": "5"}, {"row_id": "70"}))
    found = rows(empty.star().table("fato_vendas"), "sk_venda", "row_id")
    assert found == {(1, 5), (2, 70), (3, 100)}


def test_row_without_member_stops_the_load(spark, empty):
    empty.load(sales(spark, {}))
    stranger = stage(sales(spark, {"product_id": "P9"})).drop("problems")
    fact = build_fact(number_sales(stranger), empty.tables(), empty.limit)
    assert fact.first().sk_produto is None
    with pytest.raises(LoadError, match="sk_produto"):
        empty._write_fact(fact, "x")


def test_empty_source(spark, empty):
    summary = empty.load(sales(spark, {}).limit(0))
    assert (summary.extracted, summary.loaded) == (0, 0)
    assert not empty.ready()
    assert reports.kpi(empty.star()).first()[:] == (0, 0, 0, 0)


def test_create_and_readiness(spark, empty):
    assert not empty.ready()
    with pytest.raises(LoadError, match="nothing has been loaded"):
        empty.star()
    empty.create()
    assert not empty.ready() and len(empty.entries()) == 6
    empty.load(sales(spark, {}))
    empty.create()
    assert empty.ready()


def test_paths_for_large_data_load_the_same(spark, conf, house, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    other = Warehouse(spark, str(tmp_path / "other"), broadcast_bytes=0)
    other.load(house.staged.withColumnRenamed("margem_lucro_pct", "m"))
    for name, table in house.tables().items():
        assert table.df.exceptAll(other.tables()[name].df).isEmpty()
        assert table.rows == other.tables()[name].rows
    assert other.tables()["dim_envio"].hot and not house.tables()["dim_envio"].hot
    for report in (reports.vendas_detalhadas, reports.modo_envio, reports.habitos):
        assert report(other.star()).exceptAll(report(house.star())).isEmpty()


def test_one_file_per_year(house):
    fact = house.star().table("fato_vendas")
    assert len(fact.inputFiles()) == fact.select("ano_pedido").distinct().count()


def test_catalog(spark, empty):
    empty.load(sales(spark, {}, {"sales": "100", "profit": "5"}))
    views.publish(empty, "dw_test")
    one = views.query(
        spark, "SELECT * FROM dw_test.vw_receita_lucro_subcategoria WHERE categoria = :c",
        {"c": "Tools"},
    ).first()
    assert one.receita_total == 300 and one.margem_lucro_pct == Decimal("18.33")
    assert spark.table("dw_test.dim_envio").columns == ["sk_envio", "ship_mode"]
    empty.load(sales(spark, {}))
    views.publish(empty, "dw_test")
    assert spark.table("dw_test.fato_vendas").count() == 1
    assert len(spark.catalog.listTables("dw_test")) == 12


def test_a_claim_left_behind_is_released(spark, empty, monkeypatch):
    empty.load(sales(spark, {}))
    empty.patience = 2
    with monkeypatch.context() as broken:
        broken.setattr(spark, "createDataFrame", None)
        with pytest.raises(TypeError):
            empty._publish({}, "x", 2)
    with pytest.raises(LoadError, match="may be alive"):
        empty.release()
    source = sales(spark, {}, {})
    with pytest.raises(LoadError, match="load again"):
        empty.load(source)
    empty.release()
    assert empty.load(source).loaded == 2


def test_vacuum_keeps_the_newest(spark, empty):
    for n in (1, 2, 3):
        empty.load(sales(spark, *[{}] * n))
    assert len(empty.vacuum(keep=2)) == 6
    assert empty.vacuum(keep=2) == [] and empty.star().table("fato_vendas").count() == 3
    assert len(empty.vacuum(keep=1)) == 6 and empty.ready()


def test_first_row_describes_a_member(spark, empty):
    source = sales(spark, {}, {"product_name": None}, {"customer_name": "x" * 101}, {"row_id": "9", "segment": None})
    assert empty.load(source).loaded == 4
    other = sales(spark, {}, {"product_id": "P2", "product_name": None}, {"product_id": "P2"})
    with pytest.raises(LoadError, match="2 unfit rows.*product_name"):
        empty.load(other)
    summary = empty.load(other, strict=False)
    assert (summary.loaded, summary.rejected) == (1, 2)


def test_tables_are_switched_before_the_fact(spark, empty, monkeypatch):
    empty.load(sales(spark, {}))
    ran, run = [], spark.sql
    monkeypatch.setattr(spark, "sql", lambda text, **more: ran.append(text) or run(text, **more))
    views.publish(empty, "dw_order")
    names = [t.split("`dw_order`.")[1].split(" ")[0] for t in ran if "parquet.`" in t]
    assert names == ["dim_tempo", "dim_produto", "dim_cliente", "dim_localizacao", "dim_envio", "fato_vendas"]


def test_paths_with_quotes(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "it's `here`"))
    house.load(sales(spark, {}))
    views.publish(house, "dw_quotes")
    assert spark.table("dw_quotes.vw_vendas_mensais").count() == 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "view", ["vw_vendas_detalhadas", "vw_vendas_mensais", "vw_habitos_compra_segmento"]
)
def test_a_year_leaves_the_others_unread(spark, house, view):
    views.publish(house, "dw_plans")
    text = plan(spark.sql(f"SELECT * FROM dw_plans.{view} WHERE ano = 1997"))
    assert any("ano_pedido" in part.split("]")[0] for part in text.split("PartitionFilters: [")[1:])


def test_sums_come_before_joins(spark, conf, house):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    views.publish(house, "dw_plans")
    for view in ("vw_rentabilidade_produto", "vw_receita_lucro_subcategoria", "vw_vendas_lucro_estado"):
        text = plan(spark.sql(f"SELECT * FROM dw_plans.{view}"))
        assert "HashAggregate" in text.split("SortMergeJoin", 1)[1]


def test_first_seen_is_computed_once(spark, house):
    from vendaflow.operators.dimensions import first_seen, upsert_type1
    from vendaflow.schema import DIM_PRODUTO

    merged = upsert_type1(house.star().table("dim_produto"), first_seen(house.staged, DIM_PRODUTO), DIM_PRODUTO)
    assert "min_by" not in plan(merged)
