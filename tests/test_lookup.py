"""Keys of several dimensions looked up through one shuffle."""

import pytest
from pyspark.sql import functions as F

from vendaflow.operators import lookup
from vendaflow.operators.fact import LOOKUP, look_up, number_sales
from vendaflow.operators.joins import Sized, hot_keys, spread_join
from vendaflow.operators.lookup import Wanted, stacked_lookup
from vendaflow.operators.staging import PROBLEMS, stage
from vendaflow.plans.layout import carried, with_places
from vendaflow.plans.warehouse import Warehouse
from vendaflow.schema import ROLES, TABLES
from vendaflow.session import scratch_path
from vendaflow.sources.tables import flat_sales

HUGE = 1 << 40


@pytest.fixture(scope="module")
def loaded(spark, house):
    """Staged rows with odd keys, and the dimensions of their warehouse as if they were large."""
    staged = stage(flat_sales(spark, "/root/testdata/sf0.001")).drop(PROBLEMS)
    odd = staged.withColumns({
        "product_id": F.when(F.col("row_id") % 7 == 0, F.lit("nobody's")).otherwise(F.col("product_id")),
        "customer_id": F.when(F.col("row_id") % 5 == 0, None).otherwise(F.col("customer_id")),
        "postal_code": F.when(F.col("row_id") % 3 == 0, None).otherwise(F.col("postal_code")),
        "ship_date": F.when(F.col("row_id") % 2 == 0, F.lit("2017-01-01").cast("date")).otherwise(F.col("ship_date")),
    })
    dims = house.tables()
    known = dims["dim_localizacao"].df.filter("cep IS NOT NULL")
    unplaced = known.dropDuplicates(["pais", "regiao", "estado", "cidade"]).filter("sk_localizacao % 2 = 0")
    unplaced = unplaced.withColumns({"cep": F.lit(None).cast("string"), "sk_localizacao": F.col("sk_localizacao") + 10**6})
    dims["dim_localizacao"] = Sized(kept(spark, known.unionByName(unplaced)), 0, HUGE)
    return kept(spark, odd), {n: Sized(d.df, d.rows, HUGE) for n, d in dims.items()}


def kept(spark, df):
    path = scratch_path(spark, "odd")
    df.write.parquet(path)
    return spark.read.parquet(path)


def wanted(dims, *roles):
    return [Wanted(ROLES[r], LOOKUP[r], dims[ROLES[r].table.name].df, tuple(carried().get(r, ()))) for r in roles]


def in_turn(rows, dims, *roles):
    for r in roles:
        rows = look_up(rows, r, dims[ROLES[r].table.name], 0, carried().get(r, ()))
    return rows


def same(a, b):
    a = a.select(*sorted(a.columns))
    b = b.select(*sorted(b.columns))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("roles", [tuple(LOOKUP), ("produto", "cliente"), ("tempo_envio", "tempo_pedido"), ("localizacao",)])
def test_as_one_join_for_each_dimension(loaded, roles):
    rows, dims = loaded
    rows, dims = number_sales(rows), with_places(dims)
    stacked = stacked_lookup(rows, wanted(dims, *roles), "sk_venda")
    assert same(stacked, in_turn(rows, dims, *roles))
    if len(roles) == 6:
        missing = stacked.agg(*[F.count_if(F.col(r.foreign_key).isNull()).alias(r.foreign_key) for r in ROLES.values()]).first()
        assert missing["sk_produto"] and missing["sk_cliente"] and missing["sk_localizacao"]
        assert not missing["sk_tempo_pedido"] and not missing["sk_envio"]
        assert stacked.filter("sk_localizacao > 1000000 AND postal_code IS NULL").count()


def test_hashes_decide_nothing(loaded, monkeypatch):
    """All keys with one hash: whole keys still tell them apart, tables included."""
    rows, dims = loaded
    rows, dims = number_sales(rows.limit(300)), with_places(dims)
    plain = in_turn(rows, dims, *LOOKUP)
    monkeypatch.setattr(lookup, "key_hash", lambda table, parts: F.lit(1).cast("bigint"))
    assert same(stacked_lookup(rows, wanted(dims, *LOOKUP), "sk_venda"), plain)


def test_equal_texts_of_two_tables_are_two_keys(spark):
    rows = spark.createDataFrame([(1, "x", "x"), (2, "x", "y"), (3, "y", None)], "sk_venda bigint, customer_id string, product_id string")
    customers = spark.createDataFrame([(10, "x")], "sk_cliente bigint, customer_id string")
    products = spark.createDataFrame([(20, "x"), (21, "y")], "sk_produto bigint, product_id string")
    both = [
        Wanted(ROLES["cliente"], ("customer_id",), customers),
        Wanted(ROLES["produto"], ("product_id",), products),
    ]
    found = stacked_lookup(rows, both, "sk_venda").select("sk_venda", "sk_cliente", "sk_produto")
    assert sorted(map(tuple, found.collect())) == [(1, 10, 20), (2, 10, 21), (3, None, None)]
    assert stacked_lookup(rows.limit(0), both, "sk_venda").collect() == []


def nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def wide_exchanges(df):
    """Shuffles in the plan that carry a sale's measures."""
    found = 0
    for node in nodes(df._jdf.queryExecution().executedPlan()):
        if node.nodeName() == "Exchange":
            names = [a.split("#")[0] for a in node.output().mkString("|").split("|")]
            found += "sales" in names
    return found


def test_whole_rows_are_shuffled_once(conf, loaded):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    rows, dims = loaded
    rows, dims = number_sales(rows), with_places(dims)
    columns = ["sales", *[r.foreign_key for r in ROLES.values()]]
    assert wide_exchanges(in_turn(rows, dims, *LOOKUP).select(columns)) == 6
    assert wide_exchanges(stacked_lookup(rows, wanted(dims, *LOOKUP), "sk_venda").select(columns)) == 1


def test_one_frequent_key_does_not_make_a_large_task(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__enabled="false",
    )
    rows = spark.range(1, 60_001, 1, 4).select(
        F.col("id").alias("sk_venda"),
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("customer_id"),
        F.lit("p").alias("product_id"),
    )
    customers = rows.select("customer_id", F.xxhash64("customer_id").alias("sk_cliente")).distinct()
    products = spark.createDataFrame([(5, "p")], "sk_produto bigint, product_id string")
    both = [
        Wanted(ROLES["cliente"], ("customer_id",), customers),
        Wanted(ROLES["produto"], ("product_id",), products),
    ]
    asked = lookup.probes(rows, both, "sk_venda")
    (hot,) = hot_keys(asked, lookup.PROBE)
    assert len(hot) == 2
    pairs = [(c, f"_m{c}") for c in lookup.PROBE]
    met = spread_join(asked, lookup.members(both), pairs, "inner", hot, ["sk_venda", "_role"])
    sizes = [r["count"] for r in met.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 120_000 and max(sizes) < 20_000
    found = stacked_lookup(rows, both, "sk_venda")
    assert found.filter("sk_produto = 5 AND sk_cliente = xxhash64(customer_id)").count() == 60_000


def test_a_load_without_broadcasts_gives_the_same_tables(spark, house, tmp_path):
    other = Warehouse(spark, str(tmp_path / "other"), broadcast_bytes=0)
    other.load(flat_sales(spark, "/root/testdata/sf0.001"))
    for name in TABLES:
        assert same(other.tables()[name].df, house.tables()[name].df), name
