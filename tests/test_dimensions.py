import datetime as dt

import pytest
from data import rows, sales
from pyspark.sql import Window, functions as F

from vendaflow.operators.dimensions import (
    dates_seen, first_seen, insert_absent, merge, upsert_type1,
)
from vendaflow.operators.numbering import number_rows
from vendaflow.operators.staging import stage
from vendaflow.schema import DIM_ENVIO, DIM_LOCALIZACAO, DIM_PRODUTO, DIM_TEMPO

PRODUCT = "sk_produto bigint, product_id string, nome_produto string, categoria string, " \
          "subcategoria string"


def staged(spark, *changes):
    return stage(sales(spark, *changes)).drop("problems")


@pytest.mark.parametrize("partitions", [1, 7])
def test_numbers_equal_a_global_row_number(spark, conf, partitions):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    ids = spark.range(0, 5000, 1, partitions).select((F.col("id") * 7919 % 5003).alias("k"))
    numbered = number_rows(ids, ["k"], "n", start=10)
    expected = F.row_number().over(Window.orderBy("k")) + 10
    assert numbered.withColumn("e", expected).filter("n <> e").isEmpty()
    assert numbered.agg(F.min("n"), F.max("n")).first()[:] == (11, 5010)


def test_numbers_do_not_change_between_runs(spark):
    numbered = number_rows(spark.range(1000).select((-F.col("id")).alias("k")), ["k"], "n")
    assert sorted(numbered.collect()) == sorted(numbered.collect())


def test_copies_are_spread_over_partitions(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    copies = spark.range(0, 8000, 1, 4).select(F.lit(1).alias("k"))
    placed = copies.withColumn("_pos", F.monotonically_increasing_id())
    numbered = number_rows(placed, ["k", "_pos"], "n")
    assert numbered.agg(F.count_distinct("n"), F.max("n")).first()[:] == (8000, 8000)
    widths = [len(p) for p in numbered.select(F.spark_partition_id()).rdd.glom().collect()]
    assert max(widths) < 8000


def test_number_nothing(spark):
    assert number_rows(spark.range(0).toDF("k"), ["k"], "n").count() == 0


def test_first_row_wins(spark):
    source = staged(
        spark,
        {"product_id": "P1", "product_name": "A"}, {"product_id": "P1", "product_name": "B"},
        {"product_id": "P2", "product_name": "C"},
    )
    for shape in (source, source.repartition(7), source.orderBy(F.desc("row_id"))):
        found = first_seen(shape, DIM_PRODUTO)
        assert rows(found, "product_id", "nome_produto", "_first") == {("P1", "A", 1), ("P2", "C", 3)}


def test_first_row_wins_even_with_a_missing_name(spark):
    source = staged(spark, {"product_name": None}, {"product_name": "B"})
    assert rows(first_seen(source, DIM_PRODUTO), "product_id", "nome_produto") == {("P1", None)}


def test_dates_of_both_roles_once(spark):
    source = staged(
        spark,
        {"order_date": "2017-01-05", "ship_date": "2017-01-02"},
        {"order_date": "2017-01-02", "ship_date": "bad"},
    )
    found = insert_absent(None, dates_seen(source), DIM_TEMPO)
    assert rows(found, "sk_tempo", "data") == {(1, dt.date(2017, 1, 2)), (2, dt.date(2017, 1, 5))}


def test_upsert(spark):
    old = spark.createDataFrame(
        [(1, "a", "old", "k", "s"), (2, "b", "keep", "k", "s"), (3, "c", "gone", "k", "s")], PRODUCT
    )
    new = spark.createDataFrame(
        [("x", "n2", "k", "s", 9), ("w", "n1", "k", "s", 8), ("a", "new", "k2", "s", 1),
         ("c", None, "k", "s", 2)],
        "product_id string, nome_produto string, categoria string, subcategoria string, _first bigint",
    )
    once = upsert_type1(old, new, DIM_PRODUTO)
    expected = {
        (1, "a", "new", "k2", "s"), (2, "b", "keep", "k", "s"), (3, "c", None, "k", "s"),
        (4, "w", "n1", "k", "s"), (5, "x", "n2", "k", "s"),
    }
    assert rows(once) == expected
    assert rows(upsert_type1(once, new, DIM_PRODUTO)) == expected


def test_locations_with_and_without_postal_code(spark):
    source = staged(spark, {"postal_code": None}, {"postal_code": "10"}, {"postal_code": "nan"})
    first = merge(None, source, DIM_LOCALIZACAO)
    assert rows(first, "sk_localizacao", "cep") == {(1, None), (2, "10")}
    assert rows(merge(first, source, DIM_LOCALIZACAO)) == rows(first)


def test_ship_mode_existing_rows_stay(spark):
    first = merge(None, staged(spark, {"ship_mode": "B"}, {"ship_mode": "A"}), DIM_ENVIO)
    second = merge(first, staged(spark, {"ship_mode": "C"}, {"ship_mode": "A"}), DIM_ENVIO)
    assert rows(second, "sk_envio", "ship_mode") == {(1, "B"), (2, "A"), (3, "C")}
