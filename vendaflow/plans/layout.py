"""Where sales lie in the fact's files, and which files a choice of members needs.

The files of a year follow a Z-order curve over the three attributes that reports filter by. Each
file's smallest and largest value of every attribute is kept beside the fact, so that a report
opens only files that can hold a chosen value.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F, types as T

from vendaflow.operators.joins import Sized, same_key
from vendaflow.operators.packing import Spans, pack, unpack
from vendaflow.schema import FATO_VENDAS, ROLES
from vendaflow.session import writing

# Attribute -> role of the dimension that has it.
CLUSTERED = {"segmento": "cliente", "regiao": "localizacao", "categoria": "produto"}
# What the fact's files hold of their members, the attribute on the curve first: reports by these
# need not look a member up.
KEPT = {"cliente": ["segmento"], "localizacao": ["regiao"], "produto": ["categoria", "subcategoria"]}
STORED = {name: f"z_{name}" for names in KEPT.values() for name in names}  # its column in the files
BITS = 8  # places on the curve: 2^BITS for each attribute
FILE_ROWS = 4_000_000  # sales of a file, 100 to 200 MB
LISTED = 64  # values of an attribute that a file's row lists; with more, only their range counts
KNOWN_FILES = 50_000  # files whose ranges the driver keeps at hand; of more, Spark finds the needed ones


def stored_schema() -> T.StructType:
    """Columns of the fact's files: the table's and the attributes of `KEPT`."""
    return T.StructType([*FATO_VENDAS.struct.fields, *[T.StructField(c, T.StringType()) for c in STORED.values()]])


def code(role: str) -> str:
    return f"code_{role}"


def axes(dims: Mapping[str, Sized]) -> dict[str, DataFrame]:
    """By role, the distinct values of its stored attributes, numbered, with their place.

    Places are the ranks of the distinct values of the first attribute, spread over 2^BITS. A
    filter or a chart lists the values, so they are few; ranking them needs one task.
    """
    found = {}
    for role, names in KEPT.items():
        values = dims[ROLES[role].table.name].df.select(*[F.col(n).alias(STORED[n]) for n in names]).distinct()
        rank = F.dense_rank().over(Window.orderBy(STORED[names[0]])) - 1
        ranked = values.select(
            "*", rank.alias("_rank"),
            F.row_number().over(Window.orderBy(*values.columns)).alias(code(role)),
        )
        last = F.max("_rank").over(Window.partitionBy())
        place = F.floor(F.col("_rank") / F.greatest(last, F.lit(1)) * (2**BITS - 1)).cast("int")
        found[role] = ranked.select(*values.columns, code(role), place.alias(f"place_{names[0]}"))
    return found


def with_places(dims: Mapping[str, Sized]) -> dict[str, Sized]:
    """The dimensions with the number of their members' stored attributes on the axis."""
    placed = dict(dims)
    for role, axis in axes(dims).items():
        table = ROLES[role].table.name
        numbers = axis.select(*[F.col(STORED[n]).alias(f"_{n}") for n in KEPT[role]], code(role))
        df = dims[table].df
        match = same_key(df, numbers, [(n, f"_{n}") for n in KEPT[role]])
        known = df.join(F.broadcast(numbers), match, "left").select(*df.columns, code(role))
        placed[table] = replace(dims[table], df=known)
    return placed


def carried() -> dict[str, list[str]]:
    """By role, what the key lookup brings along."""
    return {role: [code(role)] for role in KEPT}


def _decoded(rows: DataFrame, found: Mapping[str, DataFrame], *dropped: str) -> DataFrame:
    """Places and attributes for the numbers; the axes are few rows, so nothing is shuffled."""
    for role, axis in found.items():
        side = axis.withColumnRenamed(code(role), "_code").drop(*dropped)
        rows = rows.join(F.broadcast(side), rows[code(role)] == side["_code"], "left").drop("_code")
    return rows


def curve() -> Column:
    """Place on the Z-order curve: the bits of the places in turn."""
    axes = [F.coalesce(F.col(f"place_{name}"), F.lit(0)) for name in CLUSTERED]
    bits = [
        F.shiftleft(F.shiftright(axis, b).bitwiseAND(F.lit(1)), b * len(axes) + k)
        for b in range(BITS)
        for k, axis in enumerate(axes)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def clustered(
    fact: DataFrame, found: Mapping[str, DataFrame], spans: Spans, rows: int, years: int, file_rows: int
) -> DataFrame:
    """The fact dealt to tasks by year and stretch of the curve, and sorted along it.

    A stretch is as long as a file of evenly spread sales would be. AQE cuts what is larger and
    merges what is smaller, so this is one shuffle, as it would be without the curve. order_id
    comes next, which keeps orders together. What is shuffled are the numbers of the attributes
    on the axes in `found`, their texts are set in after it; they and the keys, whose lowest and
    highest values are in `spans`, travel in few words.
    """
    whole = BITS * len(CLUSTERED)
    files = max(1.0, rows / max(1, years) / file_rows)
    stretch = F.shiftright("_curve", whole - min(whole, math.ceil(math.log2(files))))
    placed = _decoded(fact, found, *STORED.values()).withColumn("_curve", curve())
    # The year is dealt by, too, beside its place in a word.
    rows = placed.select(*fact.columns, F.col("ano_pedido").alias("_year"), stretch.alias("_stretch"))
    slim, packed = pack(rows, spans)
    dealt = unpack(slim.hint("rebalance", "_year", "_stretch"), packed, spans)
    dealt = _decoded(dealt, found).withColumn("_curve", curve())
    columns = [*FATO_VENDAS.columns, *STORED.values()]
    return dealt.sortWithinPartitions("ano_pedido", "_curve", "order_id").select(*columns)


def write_zones(spark: SparkSession, fact_path: str, zones_path: str) -> None:
    """One row per file: name below the fact's folder, year, sales, and of each attribute the
    range and, if they are few, the values.

    Reads three columns of the files just written, which repeat within a file."""
    files = spark.read.schema(stored_schema()).parquet(fact_path)
    ranges = [f(c).alias(f"{c}_{n}") for c in STORED.values() for n, f in (("min", F.min), ("max", F.max))]
    sets = [F.collect_set(c).alias(f"{c}_set") for c in STORED.values()]
    name = F.concat_ws("/", F.slice(F.split("_metadata.file_path", "/"), -2, 2))
    per_file = files.groupBy(name.alias("file"), "ano_pedido").agg(F.count("*").alias("rows"), *ranges, *sets)
    short = {s: F.when(F.size(s) <= LISTED, F.col(s)) for s in (f"{c}_set" for c in STORED.values())}
    with writing(spark):
        per_file.withColumns(short).write.parquet(zones_path)


class Zones:
    """The files of one load's fact, with their ranges."""

    def __init__(self, files: DataFrame, fact_path: str):
        self.files = files
        self.fact_path = fact_path

    @cached_property
    def known(self) -> list[Row] | None:
        """All ranges, read once, unless there are too many."""
        rows = self.files.limit(KNOWN_FILES + 1).collect()
        return rows if len(rows) <= KNOWN_FILES else None

    @cached_property
    def stored(self) -> list[str]:
        """Attributes that these files hold; those of an older load hold fewer."""
        return [n for n, c in STORED.items() if f"{c}_min" in self.files.columns]

    def needed(self, chosen: Mapping[str, Sequence], years: Sequence[int]) -> list[str]:
        """Files that can hold a sale of the chosen members: one name for each file at most."""
        if self.known is not None:
            return [r["file"] for r in self.known if _may_hold(r, chosen, years)]
        rows = self.files
        if years:
            rows = rows.filter(F.col("ano_pedido").isin(list(years)))
        for name, values in chosen.items():
            low, high = F.col(f"{STORED[name]}_min"), F.col(f"{STORED[name]}_max")
            inside = [(low <= F.lit(v)) & (F.lit(v) <= high) for v in values]
            listed = F.arrays_overlap(f"{STORED[name]}_set", F.array(*[F.lit(v) for v in values]))
            rows = rows.filter(reduce(lambda a, b: a | b, inside) & F.coalesce(listed, F.lit(True)))
        return [r["file"] for r in rows.select("file").collect()]

    def read(
        self, chosen: Mapping[str, Sequence], years: Sequence[int], names: Sequence[str] = ()
    ) -> DataFrame:
        """The chosen members' sales, from the files that can hold any, with the named stored
        attributes."""
        spark = self.files.sparkSession
        if not chosen:
            rows = spark.read.schema(stored_schema()).parquet(self.fact_path)
            if years:
                rows = rows.filter(F.col("ano_pedido").isin(list(years)))
            return rows.select(*FATO_VENDAS.columns, *[F.col(STORED[n]).alias(n) for n in names])
        named = [T.StructField(n, T.StringType()) for n in names]
        files = self.needed(chosen, years)
        if not files:
            return spark.createDataFrame([], T.StructType([*FATO_VENDAS.struct.fields, *named]))
        reader = spark.read.schema(stored_schema()).option("basePath", self.fact_path)
        rows = reader.parquet(*[f"{self.fact_path}/{name}" for name in sorted(files)])
        for name, values in chosen.items():
            rows = rows.filter(F.col(STORED[name]).isin(list(values)))  # reaches row groups, too
        return rows.select(*FATO_VENDAS.columns, *[F.col(STORED[n]).alias(n) for n in names])


def _may_hold(ranges: Row, chosen: Mapping[str, Sequence], years: Sequence[int]) -> bool:
    if years and ranges["ano_pedido"] not in years:
        return False
    for name, values in chosen.items():
        low, high, listed = (ranges[f"{STORED[name]}_{part}"] for part in ("min", "max", "set"))
        if low is None or not any(low <= v <= high for v in values):
            return False
        if listed is not None and set(listed).isdisjoint(values):
            return False
    return True
