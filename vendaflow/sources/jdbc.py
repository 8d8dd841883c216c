"""Optional database source and sink through Spark's own JDBC connector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def postgres_options(
    host: str, port: int | str, dbname: str, user: str, password: str
) -> dict[str, str]:
    return {
        "url": f"jdbc:postgresql://{host}:{port}/{dbname}",
        "user": user,
        "password": password,
        "driver": "org.postgresql.Driver",
    }


def read_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    split: tuple[str, int, int, int],
) -> DataFrame:
    """A database table, read in parallel: `split` = (column, low, high, parts)."""
    column, low, high, parts = split
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    return reader.options(
        partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts
    ).load()


def write_jdbc(df: DataFrame, options: dict[str, str], table: str, mode: str = "append") -> None:
    """Insert rows in batches. With mode 'overwrite' the table is emptied, not dropped."""
    writer = df.write.format("jdbc").options(**options).option("dbtable", table)
    writer.option("batchsize", 10_000).option("truncate", True).mode(mode).save()
