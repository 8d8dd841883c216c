"""Joining a dimension: broadcast if its measured size allows, else with hot keys spread."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

BROADCAST_BYTES = 128 * 1024 * 1024

# A key with more rows than this many mean partitions is spread.
HOT_PARTITIONS = 2
# The sketch keeps this many times the keys that can be hot, so that it misses none of them.
SKETCH_FACTOR = 4
SKETCH_LIMIT = 1_000_000  # the most that approx_top_k tracks


@dataclass(frozen=True)
class Sized:
    """A table with the size measured when it was written."""

    df: DataFrame
    rows: int
    bytes: int
    hot: dict[int, float] = field(default_factory=dict)  # of the fact's keys, see hot_keys

    def fits(self, limit: int) -> bool:
        return self.bytes <= limit


def row_bytes(schema: T.StructType) -> Column:
    """Upper bound of a row's size in a hash relation: texts padded, 8 bytes per slot."""
    texts = [f.name for f in schema if isinstance(f.dataType, T.StringType)]
    size = F.lit(8 * (len(schema) + 3))
    for name in texts:
        size = size + F.coalesce(F.octet_length(name), F.lit(0)) + 8
    return size.cast("bigint")


def measure(df: DataFrame, rows: int, limit: int) -> Sized:
    """Size of a table not written by this package. `rows`: its row count, from file footers.

    The columns are read only if that many of the narrowest rows could fit the limit.
    """
    least = rows * 8 * (len(df.columns) + 3)
    if least <= limit:
        least = df.agg(F.sum(row_bytes(df.schema))).first()[0] or 0
    return Sized(df, rows, least)


def same_key(
    left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], null_safe: bool = True
) -> Column:
    """Equality on all pairs. NULL-safe: a missing part matches a missing part."""
    condition = F.lit(True)
    for a, b in pairs:
        condition = condition & (
            left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b]
        )
    return condition


def hot_keys(rows: DataFrame, *keys: Sequence[str]) -> list[dict[int, float]]:
    """For each key, the hash of its frequent values and their share of the rows.

    One scan of the key columns; the sketches merge in map tasks. What is frequent, and the
    size of the sketches, follow from the number of shuffle partitions.
    A hash collision or a wrong estimate moves rows to other tasks, never to other results.
    """
    share = hot_share(shuffle_partitions(rows.sparkSession))
    kept = math.ceil(1 / share)
    tracked = min(SKETCH_LIMIT, max(1024, SKETCH_FACTOR * kept))
    tops = [
        F.call_function("approx_top_k", F.xxhash64(*k), F.lit(kept), F.lit(tracked)).alias(f"k{i}")
        for i, k in enumerate(keys)
    ]
    total, *found = rows.agg(F.count("*"), *tops).first()
    return [
        {top["item"]: top["count"] / total for top in items if top["count"] > share * total}
        for items in found
    ]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_share(partitions: int) -> float:
    """Share of the rows above which a key is hot: some mean partitions, at most 1 % of all."""
    return min(0.01, HOT_PARTITIONS / partitions)


def spread_join(
    rows: DataFrame,
    dim: DataFrame,
    pairs: list[tuple[str, str]],
    how: str,
    hot: dict[int, float],
    by: Sequence[str],
    null_safe: bool = False,
) -> DataFrame:
    """Shuffle join in which the rows of a hot key go to many tasks.

    A hot key is cut by a hash of the `by` columns into pieces of a quarter of the mean
    partition, and its dimension row is repeated for each piece: in all about four rows per
    shuffle partition. `by` must differ among the rows of one key.
    """
    if not hot:
        return rows.join(dim, same_key(rows, dim, pairs, null_safe), how)
    spark = rows.sparkSession
    parts = shuffle_partitions(spark)
    cuts = [(key, max(2, math.ceil(4 * share * parts))) for key, share in hot.items()]
    cut = F.broadcast(spark.createDataFrame(cuts, "_hash bigint, _cuts int"))

    piece = F.coalesce(F.pmod(F.xxhash64(*by), F.col("_cuts")), F.lit(0)).cast("int")
    many = (
        rows.withColumn("_hash", F.xxhash64(*[a for a, _ in pairs]))
        .join(cut, "_hash", "left")
        .withColumn("_piece", piece)
        .drop("_hash", "_cuts")
    )
    pieces = F.sequence(F.lit(0), F.coalesce("_cuts", F.lit(1)) - 1)
    repeated = (
        dim.withColumn("_hash", F.xxhash64(*[b for _, b in pairs]))
        .join(cut, "_hash", "left")
        .withColumn("_copy", F.explode(pieces))
        .drop("_hash", "_cuts")
    )
    match = same_key(many, repeated, pairs, null_safe) & (many["_piece"] == repeated["_copy"])
    return many.join(repeated, match, how).drop("_piece", "_copy")
