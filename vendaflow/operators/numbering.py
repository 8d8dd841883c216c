"""Dense numbering of rows without putting them all in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from vendaflow.session import COMPRESSION, scratch_path, writing

# monotonically_increasing_id() holds the partition above this bit and the row below it.
_ROW_BITS = 33


def number_rows(
    df: DataFrame, order: list[str], name: str, start: int = 0, kept: list[str] | None = None
) -> DataFrame:
    """Add `name`: start+1, start+2, ... in the order of the `order` columns.

    Rows are range-partitioned and sorted, then written once to the shared folder with
    their partition and place in it, so the numbers cannot change when a task is run
    again. Only the row counts of the partitions meet in one place. `order` must tell
    any two rows apart, or the order among equal rows is open. `kept`: the columns to return, if
    others serve the order only and need not be written.
    """
    spark = df.sparkSession
    kept = df.columns if kept is None else kept
    path = scratch_path(spark, f"number-{name}")
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*kept, F.monotonically_increasing_id().alias("_slot"))
    )
    with writing(spark):
        placed.write.parquet(path, compression=COMPRESSION)
    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField("_slot", T.LongType())])
    placed = spark.read.schema(schema).parquet(path).withColumn(
        "_part", F.shiftright("_slot", _ROW_BITS)
    )
    # One row per shuffle partition: bounded by the partition count, not by the data.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    place = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    number = F.col("_before") + place + F.lit(start + 1).cast("bigint")
    return placed.join(F.broadcast(offsets), "_part").select(
        *kept, number.alias(name)
    )
