"""Row ids proved unique and dense by blocks of bits."""

import random

import pytest
from pyspark.sql import functions as F

from vendaflow.errors import LoadError
from vendaflow.operators.fact import duplicate_rows, id_blocks, number_sales

LONGEST = 2**63 - 1
SETS = {
    "dense": list(range(1, 1000)),
    "dense around zero": list(range(-200, 70)),
    "ends of a block": [63, 64, 127, 128],
    "one": [64],
    "last bit of a word": [127],
    "gaps": [5, 70, 100],
    "one missing": [i for i in range(1, 500) if i != 64],
    "sparse": [i * 10**9 + 7 for i in range(300)],
    "extremes": [-LONGEST - 1, -LONGEST, -1, 0, LONGEST - 1, LONGEST],
}


def ids(spark, values):
    shuffled = random.Random(3).sample(values, len(values))
    return spark.createDataFrame([(v,) for v in shuffled], "row_id bigint").repartition(3)


@pytest.mark.parametrize("name", SETS)
def test_numbers_are_dense_in_id_order(spark, name):
    found = number_sales(ids(spark, SETS[name])).collect()
    expected = {v: n for n, v in enumerate(sorted(SETS[name]), start=1)}
    assert {r.row_id: r.sk_venda for r in found} == expected


@pytest.mark.parametrize("name", SETS)
def test_a_repeated_id_is_found(spark, name):
    values = SETS[name]
    for again in {values[0], values[-1]}:
        repeated = ids(spark, [*values, again])
        with pytest.raises(LoadError, match=f"more than once.*{again}"):
            number_sales(repeated)
        assert [tuple(r) for r in duplicate_rows(repeated).collect()] == [(again, 2)]


def test_a_repeat_is_not_made_up_for_by_a_gap(spark):
    """As many rows as ids between the ends, but one id twice and one missing."""
    with pytest.raises(LoadError):
        number_sales(ids(spark, [1, 2, 2, 4]))
    with pytest.raises(LoadError):
        number_sales(ids(spark, [10, 10, 12, 200, 300]))


def test_no_rows_and_rows_without_id(spark):
    assert number_sales(ids(spark, [])).collect() == []
    lost = spark.createDataFrame([(None,), (None,)], "row_id bigint")
    with pytest.raises(LoadError):
        number_sales(lost)
    numbered = number_sales(lost.limit(1)).select("sk_venda").collect()
    assert [r.sk_venda for r in numbered] == [1]


def shuffled(df):
    """Rows and bytes that the plan's shuffles wrote."""
    df.collect()
    plan, rows, size = df._jdf.queryExecution().executedPlan(), 0, 0
    todo = [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        else:
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
            if node.nodeName() == "Exchange":
                rows += node.metrics().apply("shuffleRecordsWritten").value()
                size += node.metrics().apply("shuffleBytesWritten").value()
    return rows, size


def test_dense_ids_shuffle_a_row_for_a_block(spark, tmp_path):
    spark.range(64_000).select(F.col("id").alias("row_id")).write.parquet(str(tmp_path / "ids"))
    rows = spark.read.parquet(str(tmp_path / "ids"))
    per_block = shuffled(id_blocks(rows))
    per_id = shuffled(rows.groupBy("row_id").agg(F.count("*")))
    assert per_block[0] <= 1000 + rows.rdd.getNumPartitions() and per_id[0] == 64_000
    assert per_block[1] * 20 < per_id[1]
