"""Bitmaps of a summary: as many as full ones and groups, not groups times buckets."""

from types import SimpleNamespace

from pyspark.sql import functions as F
from test_star import same

from vendaflow.plans.star import distinct
from vendaflow.plans.summaries import Summary, _bits, distinct_counts


def test_bitmaps_are_as_many_as_full_ones_and_groups(spark):
    """100,000 orders over 40 groups in turn; every tenth of them is in a second group, too."""
    orders = spark.range(100_000).withColumn("second", F.col("id") % 10 == 0)
    lines = orders.select(
        "id", F.explode(F.expr("if(second, array(id % 40, (id + 1) % 40), array(id % 40))")).alias("g")
    ).select(
        F.concat(F.lit("g"), "g").alias("g"), F.concat(F.lit("o"), "id").alias("order_id"),
        F.col("id").alias("sk_venda"),
    )
    star = SimpleNamespace(lines=lambda names: lines)
    bits = _bits(star, Summary(["g"], ["order_id"])).localCheckpoint()
    assert bits.count() <= 100_000 // 32_768 + 1 + 2 * 40
    pedidos = distinct("order_id", "pedidos")
    same(distinct_counts(bits, ["g"], [pedidos]), lines.groupBy("g").agg(pedidos.column))
    assert distinct_counts(bits, [], [pedidos]).first().pedidos == 100_000
