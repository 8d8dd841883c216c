"""Surrogate keys of several large dimensions at once, without shuffling wide rows for each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from vendaflow.operators.joins import hot_keys, spread_join
from vendaflow.schema import Role, Table

PROBE = ["_mark", "_table", "_parts"]  # what a row's key and a member's key are matched by


@dataclass(frozen=True)
class Wanted:
    """One role to look up: the rows' key columns, the members, columns brought along."""

    role: Role
    key: tuple[str, ...]
    members: DataFrame
    carried: tuple[str, ...] = ()


def key_hash(table: Column, parts: Column) -> Column:
    """Decides where keys meet and how they sort; whole keys are compared after that."""
    return F.xxhash64(table, parts)


def _parts(columns: Sequence[str], table: Table) -> Column:
    """A natural key as texts. NULL, which matches nothing, if a part is missing that must not be;
    missing parts that may be are equal to each other."""
    parts = F.array(*[F.col(c).cast("string") for c in columns])
    needed = [F.col(c).isNotNull() for c, n in zip(columns, table.natural) if n not in table.nullable]
    return F.when(reduce(lambda a, b: a & b, needed, F.lit(True)), parts)


def _number(wanted: Sequence[Wanted]) -> dict[str, int]:
    """The tables by name, each once however many roles it plays."""
    return {name: i for i, name in enumerate(dict.fromkeys(w.role.table.name for w in wanted))}


def probes(rows: DataFrame, wanted: Sequence[Wanted], row_key: str) -> DataFrame:
    """One narrow row for each key of a row: its role, table, hash and texts."""
    number = _number(wanted)
    each = [
        F.struct(
            F.lit(i).alias("_role"),
            F.lit(number[w.role.table.name]).alias("_table"),
            _parts(w.key, w.role.table).alias("_parts"),
        )
        for i, w in enumerate(wanted)
    ]
    stacked = rows.select(row_key, F.inline(F.array(*each))).filter(F.col("_parts").isNotNull())
    return stacked.withColumn("_mark", key_hash(F.col("_table"), F.col("_parts")))


def members(wanted: Sequence[Wanted]) -> DataFrame:
    """The members of all tables under each other: key, surrogate key, columns brought along."""
    per_table: dict[str, list[Wanted]] = {}
    for w in wanted:
        per_table.setdefault(w.role.table.name, []).append(w)
    stacked = []
    for number, same in enumerate(per_table.values()):
        table, df = same[0].role.table, same[0].members
        more = dict.fromkeys(c for w in same for c in w.carried)
        stacked.append(df.select(
            F.lit(number).alias("_m_table"),
            _parts(table.natural, table).alias("_m_parts"),
            F.col(table.key).alias("_sk"),
            *[F.col(c).alias(f"_m_{table.name}_{c}") for c in more],
        ))
    all_of_them = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stacked)
    return all_of_them.withColumn("_m_mark", key_hash(F.col("_m_table"), F.col("_m_parts")))


def stacked_lookup(
    rows: DataFrame, wanted: Sequence[Wanted], row_key: str, source: DataFrame | None = None
) -> DataFrame:
    """Add each role's foreign key and the carried columns; NULL where no member has the key.

    Every row's keys go under each other, with the row's number and nothing else, through one
    shuffle to the members, which lie under each other, too. What is found is gathered by row
    number and joined back: however many dimensions there are, whole rows are shuffled once.
    Frequent keys are spread as in a join of one dimension. `row_key`: a long, different in
    every row. `source`: the same rows before columns were added, to read the keys from.
    """
    asked, known = probes(rows if source is None else source, wanted, row_key), members(wanted)
    (hot,) = hot_keys(asked, PROBE)
    pairs = [(c, f"_m{c}") for c in PROBE]
    found = spread_join(asked, known, pairs, "inner", hot, [row_key, "_role"])
    columns = []
    for i, w in enumerate(wanted):
        here = F.col("_role") == i
        columns.append(F.max(F.when(here, F.col("_sk"))).alias(w.role.foreign_key))
        for c in w.carried:
            value = F.col(f"_m_{w.role.table.name}_{c}")
            columns.append(F.max(F.when(here, value)).alias(c))
    gathered = found.groupBy(F.col(row_key).alias("_row")).agg(*columns)
    return rows.join(gathered, rows[row_key] == gathered["_row"], "left").drop("_row")
