"""What a load leaves out of its shuffles: joins without an effect, texts of members, files of ended queries."""

import os

import pytest
from data import rows, sales
from pyspark.sql import functions as F
from test_star import plan

from vendaflow.errors import LoadError
from vendaflow.operators.fact import number_sales
from vendaflow.operators.staging import DESCRIPTIVE, PROBLEMS, stage
from vendaflow.plans.summaries import build
from vendaflow.plans.warehouse import Warehouse

NAMELESS = ({}, {"product_name": None}, {"product_id": "P2", "product_name": None}, {"product_id": "P2"}, {"customer_id": "C9", "customer_name": "x" * 101})


def test_a_name_missing_later_costs_the_load_no_join(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    summary = house.load(sales(spark, *NAMELESS[:2]))
    assert (summary.loaded, summary.rejected) == (2, 0)
    assert "Join" not in plan(house.staged)


@pytest.mark.parametrize("limit", [0, 1 << 27])
def test_members_without_description_are_taken_out_once(spark, conf, tmp_path, limit):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    house = Warehouse(spark, str(tmp_path / "house"), broadcast_bytes=limit)
    with pytest.raises(LoadError, match="3 unfit rows"):
        house.load(sales(spark, *NAMELESS))
    summary = house.load(sales(spark, *NAMELESS), strict=False)
    assert (summary.extracted, summary.loaded, summary.rejected) == (5, 2, 3)
    assert rows(house.star().table("dim_produto"), "product_id") == {("P1",)}
    assert "hashpartitioning" not in plan(house.staged)


def test_descriptions_are_not_numbered_along(spark):
    numbered = number_sales(stage(sales(spark, {"row_id": "8"}, {"row_id": "3"})).drop(PROBLEMS))
    assert not set(DESCRIPTIVE) & set(numbered.columns)
    assert {(r.row_id, r.sk_venda) for r in numbered.select("row_id", "sk_venda").collect()} == {(3, 1), (8, 2)}


def shuffle_files(spark):
    root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in root for r, _, found in os.walk(d) for f in found if f.startswith("shuffle_")}


def test_a_load_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    many = sales(spark, *[{"product_id": f"P{i}", "row_id": str(3 * i)} for i in range(40)]).repartition(5)
    house = Warehouse(spark, str(tmp_path / "house"))
    house.load(many)
    loaded = shuffle_files(spark) - before
    build(house)
    assert len(loaded) < 20 and len(shuffle_files(spark) - before - loaded) < 20
