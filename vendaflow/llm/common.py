"""What the operators of this subpackage share."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vendaflow.session import TIDY, scratch_path, writing


BATCH_BYTES = 16 * 1024 * 1024
BROADCAST_STRATA = 50_000  # names with a count, a few MB


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Arrow batches are bounded by bytes from then on, since by default they
    are bounded by rows, and ten thousand long texts do not fit a task's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with writing(spark, TIDY):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def column(batch: pa.RecordBatch, name: str) -> Iterator:
    """Values of one column, one at a time: a batch of long texts is never held twice."""
    for value in batch.column(name):
        yield value.as_py()


def text_or_empty(value: str | None) -> str:
    return value or ""


def fit_sample(rows: DataFrame, stratum: str, per_stratum: int, seed: int) -> DataFrame:
    """`per_stratum` distinct texts of each value of `stratum`, or all if it has fewer; the
    same ones at every run.

    Rows are thinned by a hash of their text first, so that the ranking, which gathers a
    stratum in one task, sees about three times the texts it keeps. The hash is the same for
    all copies, so the share is set by the number of distinct texts, however often each occurs.
    """
    hashed = F.xxhash64(F.lit(seed), F.col("text"))
    kinds = rows.select(stratum, hashed.alias("_h")).distinct()
    counts = saved(kinds.groupBy(stratum).agg(F.count("*").alias("_n")), "strata")
    if counts.count() <= BROADCAST_STRATA:  # else a shuffle join
        counts = F.broadcast(counts)
    share = F.pmod(hashed, F.lit(1_000_000)) / 1_000_000
    # With 64 more, too few are left once in 10^19 strata even if `per_stratum` is 1.
    thin = rows.join(counts, stratum).filter(
        share * F.col("_n") <= F.lit(3 * per_stratum + 64)
    )
    distinct = thin.groupBy(stratum, "text").agg(F.min(hashed).alias("_h"))
    ranked = distinct.withColumn(
        "_rank", F.expr(f"row_number() OVER (PARTITION BY `{stratum}` ORDER BY _h, text)")
    )
    return ranked.filter(F.col("_rank") <= per_stratum).drop("_h", "_rank")


def text_tag() -> Column:
    """With doc_id, what tells rows apart; that of a null text is not null."""
    return F.xxhash64("text")


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of `docs` whose (doc_id, text tag) is not in `gone`; a null doc_id is like another."""
    gone = gone.select(F.col("doc_id").alias("_gone_id"), F.col("tag").alias("_gone_tag")).distinct()
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_gone_id"))
    return docs.join(gone, same & (text_tag() == F.col("_gone_tag")), "left_anti")


def pair_tasks(rows: DataFrame, cell: list[str], by: str, limit: int | Column, few: bool = False) -> DataFrame:
    """Deal the rows of each cell so that no task gets a cell of more than `limit` rows whole.

    A cell of c * limit rows is cut by a hash of `by` into c pieces, and each pair of pieces
    is a task of its own: `_i` <= `_j` name the pieces, `_side` says to which of the two a
    row belongs (0 if `_i` = `_j`). Every pair of rows of a cell meets in exactly one task.
    The limit may follow from the columns of `cell`. `few`: cells over the limit are known to be few
    enough to broadcast, so that rows are not shuffled to learn of them.
    """
    large = (
        rows.groupBy(*cell)
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > limit)
        .select(*cell, F.ceil(F.col("_n") / limit).cast("int").alias("_c"))
    )
    if few:
        large = F.broadcast(large)
    dealt = rows.join(large, cell, "left").withColumn("_c", F.coalesce("_c", F.lit(1)))
    piece = F.pmod(F.xxhash64(by), F.col("_c")).cast("int")
    return (
        dealt.withColumn("_own", piece)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_c") - 1)))
        .withColumn("_i", F.least("_own", "_other"))
        .withColumn("_j", F.greatest("_own", "_other"))
        .withColumn("_side", (F.col("_own") > F.col("_other")).cast("int"))
        .drop("_c", "_own", "_other")
    )


class Links:
    """Components among the rows 0..n-1 of one task; a label is a component's smallest row."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while len(a):
            x, y = label[a], label[b]
            differ = x != y
            if not differ.any():
                break
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            self.settle()

    def settle(self) -> None:
        while True:
            up = self.label[self.label]
            if np.array_equal(up, self.label):
                return
            self.label[:] = up


def components(links: DataFrame, nodes: tuple[str, str] = ("a", "b")) -> DataFrame:
    """(node, component): the smallest node reachable over the undirected links.

    Large and small stars in turn, each a map-side minimum per node and a join back, until
    the links stop changing. Every round is written to the shared folder. Nodes without a
    link to another node are not returned.
    """
    a, b = nodes
    edges = (
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col("u") != F.col("v"))
        .distinct()
    )
    edges, before = _measured(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.filter(F.col("v") > F.col("u"))
            .join(least, "u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        large = saved(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = (
            small.select("u", F.col("m").alias("v"))
            .unionByName(
                small.filter(F.col("v") != F.col("m")).select(
                    F.col("v").alias("u"), F.col("m").alias("v")
                )
            )
            .distinct()
        )
        edges, after = _measured(small)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _measured(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = saved(edges, "links")
    found = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return edges, (found[0], found[1])


def ceil_div(a: int, b: int) -> int:
    return math.ceil(a / b)
