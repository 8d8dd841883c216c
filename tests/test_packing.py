"""Numbers of a row in words while it is shuffled, and queries that leave no shuffle files behind."""

import datetime as dt
import glob
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_lookup import nodes
from test_star import same

from vendaflow.operators.fact import MEASURES, build_fact, key_spans, number_sales
from vendaflow.operators.packing import APART, WORD_BITS, measured, pack, places, unpack
from vendaflow.operators.staging import PROBLEMS, stage
from vendaflow.plans.layout import carried, with_places
from vendaflow.schema import ROLES
from vendaflow.session import TIDY, writing
from vendaflow.sources.tables import flat_sales

SF = "/root/testdata/sf0.001"


def test_words_give_back_every_value(spark):
    schema = "sk_venda bigint, row_id bigint, a bigint, b int, c decimal(12,4), d bigint, e decimal(6,4), o string"
    rows = [
        (1, 1, 5, -7, Decimal("-99999999.9999"), -2**63, Decimal("0.0001"), "x"),
        (2, 9, None, None, None, None, None, None),
        (3, None, 900, 2**31 - 1, Decimal("99999999.9999"), 2**63 - 1, Decimal("-99.9999"), "y"),
        (4, -2**63, 5, 0, Decimal("0"), 0, Decimal("99.9999"), ""),
    ]
    df = spark.createDataFrame(rows, schema)
    spans = {
        "a": (5, 900), "b": (-7, 2**31 - 1), "c": (-(10**12) + 1, 10**12 - 1), "d": (-2**63, 2**63 - 1),
        "e": (-(10**6) + 1, 10**6 - 1), "absent": (0, 9),
    }
    slim, kinds = pack(df, spans)
    assert set(slim.columns) == {"sk_venda", "d", "o", APART, "_word0", "_word1"}
    same(unpack(slim, kinds, spans).select(*df.columns), df)
    same(unpack(slim.limit(0), kinds, spans).select(*df.columns), df.limit(0))


def test_words_hold_no_more_than_their_bits():
    at = places(["a", "b", "c", "d"], {"a": (0, 2**40), "b": (1, 2**30), "c": (7, 7), "d": (0, 2**61)})
    assert {n: at[n][0] for n in "abc"} == {"a": "_word0", "b": "_word1", "c": "_word0"}
    assert at["d"][2] == 62 and all(first + bits <= WORD_BITS for _, first, bits in at.values())


def test_spans_of_empty_tables_and_nulls(spark):
    df = spark.createDataFrame([(None, 3), (None, -2)], "a bigint, b bigint")
    assert measured([(df, ["a", "b"]), (df.limit(0).withColumnRenamed("a", "c"), ["c"])]) == {"a": (0, 0), "b": (-2, 3), "c": (0, 0)}


@pytest.mark.parametrize("large", [("produto", "cliente"), ("cliente",), ("localizacao", "envio")])
def test_only_keys_go_to_large_dimensions(spark, conf, house, large):
    """The sales themselves are shuffled once, to what was found; strange keys find nothing."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    staged = stage(flat_sales(spark, SF)).drop(PROBLEMS).localCheckpoint()
    odd = staged.withColumns({
        "product_id": F.when(F.col("row_id") % 7 == 0, F.lit("nobody's")).otherwise(F.col("product_id")),
        "customer_id": F.when(F.col("row_id") % 5 == 0, None).otherwise(F.col("customer_id")),
        "ship_date": F.when(F.col("row_id") % 11 == 0, F.lit(dt.date(2150, 1, 1))).otherwise(F.col("ship_date")),
    })
    rows = number_sales(odd)
    dims = with_places(house.tables())
    tables = {ROLES[r].table.name for r in large}
    few = {n: d if n in tables else replace(d, bytes=0) for n, d in dims.items()}
    near, far = build_fact(rows, dims, 1 << 30, carried()), build_fact(rows, few, 0, carried())
    same(near, far)
    assert near.schema == far.schema
    outputs = [
        [a.split("#")[0] for a in n.output().mkString("|").split("|")]
        for n in nodes(far._jdf.queryExecution().executedPlan()) if n.nodeName() == "Exchange"
    ]
    assert sum("order_id" in names for names in outputs) == 1
    assert not any({"vendas", *MEASURES} & set(names) and "_row" in names for names in outputs)
    wide = next(names for names in outputs if "order_id" in names)
    assert not {"sk_tempo_pedido", "product_id", "customer_id"} & set(wide)


def test_files_of_a_written_query_go_with_it(spark, conf, tmp_path):
    (key,) = TIDY
    before = spark.conf.get(key, None)
    with writing(spark):
        with writing(spark):
            assert spark.conf.get(key) == "true"
        assert spark.conf.get(key) == "true"
        spark.range(100_000).repartition(7, "id").write.parquet(str(tmp_path / "out"))
    assert spark.conf.get(key, None) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100_000


def test_keys_of_a_load_lie_in_their_spans(house):
    spans = key_spans(house.tables())
    fact = house.tables()["fato_vendas"].df
    for role in ROLES.values():
        low, high = spans[role.foreign_key]
        assert fact.filter(~F.col(role.foreign_key).between(low, high)).isEmpty()
