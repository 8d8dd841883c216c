"""Several whole numbers of a row in one long, for as long as the row is shuffled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

WORD_BITS = 62
APART = "_apart"  # what row_id differs from sk_venda in: no bit, if ids are 1, 2, ...

Spans = Mapping[str, tuple[int, int]]  # by column, its lowest and highest value as `whole` numbers


def edges(columns: Mapping[str, Column]) -> list[Column]:
    """Aggregates that `span` reads: the lowest and highest of each column."""
    return [f(e).alias(f"{n}_{c}") for c, e in columns.items() for n, f in (("low", F.min), ("high", F.max))]


def span(found: Mapping[str, int | None], columns: Sequence[str]) -> dict[str, tuple[int, int]]:
    return {c: (found[f"low_{c}"] or 0, found[f"high_{c}"] or 0) for c in columns}


def measured(parts: Sequence[tuple[DataFrame, Sequence[str]]]) -> dict[str, tuple[int, int]]:
    """The spans of bigint columns of several tables, in one job."""
    rows = []
    for df, columns in parts:
        one = df.agg(*edges({c: F.col(c) for c in columns}))
        each = [F.struct(F.lit(c).alias("name"), F.col(f"low_{c}").alias("low"), F.col(f"high_{c}").alias("high")) for c in columns]
        rows.append(one.select(F.inline(F.array(*each))))
    return {r["name"]: (r["low"] or 0, r["high"] or 0) for r in reduce(DataFrame.unionByName, rows).collect()}


def places(columns: Sequence[str], spans: Spans, prefix: str = "_word") -> dict[str, tuple[str, int, int]]:
    """By packed column: its word, and the first bit and number of bits there. 0 stands for NULL.
    Columns whose values differ by more than a word holds are left as they are."""
    found: dict[str, tuple[str, int, int]] = {}
    used: list[int] = []
    for name in columns:
        low, high = spans[name]
        bits = (high - low + 1).bit_length()
        if bits > WORD_BITS:
            continue
        word = next((i for i, n in enumerate(used) if n + bits <= WORD_BITS), len(used))
        used[word:] = used[word:] or [0]
        found[name] = (f"{prefix}{word}", used[word], bits)
        used[word] += bits
    return found


def whole(column: str, kind: T.DataType) -> Column:
    """A whole number or a decimal as a long; decimals are counted in their last digit."""
    if isinstance(kind, T.DecimalType):
        return (F.col(column) * F.lit(10**kind.scale).cast("decimal(7,0)")).cast("bigint")
    return F.col(column).cast("bigint")


def _value(number: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DecimalType):
        return (number.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-kind.scale))).cast(kind)
    return number.cast(kind)


def pack(
    rows: DataFrame, spans: Spans, prefix: str = "_word"
) -> tuple[DataFrame, dict[str, T.DataType]]:
    """The rows with words for the columns of `spans` they have, and `APART` for a row_id; and
    the types of these columns, for `unpack`. No value lies outside its column's span."""
    kinds = {f.name: f.dataType for f in sorted(rows.schema, key=lambda f: f.name) if f.name in spans}
    at = places(list(kinds), spans, prefix)
    words: dict[str, Column] = {}
    for name, (word, first, _) in at.items():
        value = F.coalesce(whole(name, kinds[name]) - F.lit(spans[name][0] - 1), F.lit(0)).cast("bigint")
        bits = F.call_function("shiftleft", value, F.lit(first))
        words[word] = words[word].bitwiseOR(bits) if word in words else bits
    kept = [F.col(c) for c in rows.columns if c not in at and c != "row_id"]
    if "row_id" in rows.columns:
        kept.append(F.col("row_id").bitwiseXOR(F.col("sk_venda")).alias(APART))
    return rows.select(*kept, *[e.alias(w) for w, e in words.items()]), kinds


def unpack(
    rows: DataFrame, kinds: Mapping[str, T.DataType], spans: Spans, prefix: str = "_word"
) -> DataFrame:
    at = places(list(kinds), spans, prefix)
    values = [F.col("sk_venda").bitwiseXOR(F.col(APART)).alias("row_id")] if APART in rows.columns else []
    for name, (word, first, bits) in at.items():
        code = F.shiftrightunsigned(word, first).bitwiseAND(F.lit(2**bits - 1))
        number = F.when(code != 0, code + F.lit(spans[name][0] - 1))
        values.append(_value(number, kinds[name]).alias(name))
    gone = {APART, *[word for word, _, _ in at.values()]}
    return rows.select(*[c for c in rows.columns if c not in gone], *values)
