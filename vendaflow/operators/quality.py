"""Checks of the constraints that files do not enforce."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from vendaflow.schema import ROLES, TABLES, Table

SCHEMA = ["check", "rows_checked", "violations"]


def column_checks(df: DataFrame, table: Table) -> DataFrame:
    """NOT NULL and text-length checks of one table, all in one pass."""
    tests = {}
    for c in table.columns:
        if c not in table.nullable:
            tests[f"not_null {table.name}.{c}"] = F.col(c).isNull()
        if table.limit(c):
            tests[f"length {table.name}.{c}"] = F.length(c) > table.limit(c)
    counted = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(test).alias(f"c{i}") for i, test in enumerate(tests.values())],
    )
    lines = [
        F.struct(F.lit(name).alias("check"), F.col("rows").alias("rows_checked"),
                 F.col(f"c{i}").alias("violations"))
        for i, name in enumerate(tests)
    ]
    return counted.select(F.inline(F.array(*lines)))


def unique_check(df: DataFrame, table: Table, key: tuple[str, ...]) -> DataFrame:
    """Rows beyond the first of each key."""
    groups = df.groupBy(*key).agg(F.count("*").alias("n"))
    return groups.agg(
        F.lit(f"unique {table.name}({', '.join(key)})").alias("check"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"),
    )


def foreign_key_checks(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows whose key has no member, for all roles in one scan of the fact.

    Keys are counted per role in the map tasks first, so no hot key is shuffled row by row.
    """
    pairs = [F.struct(F.lit(n).alias("role"), F.col(r.foreign_key).alias("key")) for n, r in ROLES.items()]
    per_key = (
        fact.select(F.inline(F.array(*pairs))).groupBy("role", "key").agg(F.count("*").alias("n"))
    )
    members = reduce(
        DataFrame.unionByName,
        [
            dims[r.table.name].select(F.lit(n).alias("role"), F.col(r.table.key).alias("key"))
            for n, r in ROLES.items()
        ],
    )
    found = per_key.join(members.distinct().withColumn("known", F.lit(True)), ["role", "key"], "left")
    counted = found.groupBy("role").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias("orphans"),
    )
    names = [
        F.struct(F.lit(n).alias("role"), F.lit(f"foreign_key fato_vendas.{r.foreign_key}").alias("check"))
        for n, r in ROLES.items()
    ]
    roles = fact.sparkSession.range(1).select(F.inline(F.array(*names)))
    return roles.join(counted, "role", "left").select(
        "check",
        F.coalesce("n", F.lit(0)).alias("rows_checked"),
        F.coalesce("orphans", F.lit(0)).alias("violations"),
    )


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per constraint: rows checked and rows that break it."""
    parts = []
    for name, table in TABLES.items():
        parts.append(column_checks(tables[name], table))
        parts.append(unique_check(tables[name], table, (table.key,)))
        parts.append(unique_check(tables[name], table, table.natural))
    parts.append(foreign_key_checks(tables["fato_vendas"], tables))
    return reduce(DataFrame.unionByName, [p.select(*SCHEMA) for p in parts])


def rejected_by_column(staged: DataFrame) -> DataFrame:
    """How many staged rows each column makes unfit; a row may count for several."""
    # Rows are first counted per combination of columns, of which there are few.
    combined = staged.groupBy("problems").agg(F.count("*").alias("n"))
    return (
        combined.select(F.explode(F.split("problems", ",")).alias("column"), "n")
        .groupBy("column")
        .agg(F.sum("n").alias("rows"))
    )
