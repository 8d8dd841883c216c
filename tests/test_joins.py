import pytest
from pyspark.sql import functions as F

from vendaflow.operators.joins import hot_keys, measure, row_bytes, same_key, spread_join


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows on key 'h', a fifth without a key, the rest on own keys."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit("h"))
        .when(F.col("id") % 5 != 0, F.col("id").cast("string"))
    )
    return spark.range(0, 60000, 1, 4).select("id", key.alias("k"))


@pytest.fixture(scope="module")
def dim(spark, rows):
    """Members for all keys but those that end in 7, NULL included."""
    keys = rows.select(F.col("k").alias("nk")).distinct()
    return keys.filter("nk IS NULL OR NOT endswith(nk, '7')").select("nk", F.xxhash64("nk").alias("sk"))


def test_hot_keys(rows):
    by_key, by_id = hot_keys(rows, ["k"], ["id"])
    assert sorted(round(s, 2) for s in by_key.values()) == [0.13, 0.33]
    assert by_id == {}


def test_hot_keys_of_nothing(rows):
    assert hot_keys(rows.limit(0), ["k"]) == [{}]


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_result_as_a_plain_join(rows, dim, how, null_safe):
    (hot,) = hot_keys(rows, ["k"])
    pairs = [("k", "nk")]
    spread = spread_join(rows, dim, pairs, how, hot, ["id"], null_safe)
    plain = rows.join(dim, same_key(rows, dim, pairs, null_safe), how)
    assert spread.columns == plain.columns
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()


def test_a_hot_key_is_spread(spark, conf, rows, dim):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__enabled="false",
    )
    (hot,) = hot_keys(rows, ["k"])

    def widest(joined):
        parts = joined.groupBy(F.spark_partition_id().alias("p")).count()
        return parts.agg(F.max("count")).first()[0]

    pairs = [("k", "nk")]
    assert widest(rows.join(dim, same_key(rows, dim, pairs, False))) >= 20000
    assert widest(spread_join(rows, dim, pairs, "inner", hot, ["id"])) < 9000


def test_measure_reads_only_what_may_fit(spark, rows):
    exact = rows.agg(F.sum(row_bytes(rows.schema))).first()[0]
    assert measure(rows, 60000, 1 << 30).bytes == exact
    assert not measure(rows, 10**12, 1 << 30).fits(1 << 30)


def test_what_is_hot_follows_from_the_partitions(spark, conf):
    """A key of 0.3 % of the rows is 6 mean partitions of 2,000, and less than one of 200."""
    rows = spark.range(0, 100_000, 1, 4).select(
        F.when(F.col("id") % 1000 < 3, F.lit(-1)).otherwise(F.col("id")).alias("k")
    )
    conf(spark__sql__shuffle__partitions="2000")
    assert [round(s, 4) for s in hot_keys(rows, ["k"])[0].values()] == [0.003]
    conf(spark__sql__shuffle__partitions="200")
    assert hot_keys(rows, ["k"]) == [{}]
