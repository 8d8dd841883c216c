"""The sales fact: row numbers and surrogate keys for staged rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from vendaflow.errors import LoadError
from vendaflow.operators.joins import Sized, hot_keys, measure, same_key, spread_join
from vendaflow.operators.lookup import Wanted, stacked_lookup
from vendaflow.operators.numbering import number_rows
from vendaflow.operators.packing import Spans, edges, measured, pack, span, unpack, whole
from vendaflow.operators.staging import DESCRIPTIVE
from vendaflow.schema import FATO_VENDAS, ROLES, Role

# Role -> staged columns that hold the natural key, in the order of the dimension's key.
LOOKUP = {
    "tempo_pedido": ("order_date",),
    "tempo_envio": ("ship_date",),
    "envio": ("ship_mode",),
    "localizacao": ("country", "region", "state", "city", "postal_code"),
    "produto": ("product_id",),
    "cliente": ("customer_id",),
}

# Fact column -> staged column it comes from.
MEASURES = {
    "vendas": "sales", "quantidade": "quantity", "desconto": "discount", "lucro": "profit",
    "margem_lucro_pct": "margem_lucro_pct",
}
STACKED = 3  # from so many large dimensions on, all keys travel at once, under each other
FOUND = "_found"
BLOCK_BITS = 6  # a block's ids share all but these bits; one bit each in a long


def duplicate_rows(staged: DataFrame) -> DataFrame:
    """Row ids that occur more than once, with their count."""
    return staged.groupBy("row_id").count().filter("count > 1")


def id_blocks(staged: DataFrame) -> DataFrame:
    """Row ids as blocks of 64: `block`, a bit in `ids` for each id that occurs, and `n` rows.

    Map tasks shrink the ids of a block that they read together to one row, so ids in file order
    shuffle one row for 64; ids without neighbours shuffle a row each. No id has a row of its own
    after that, and any set of ids takes the same way.
    """
    place = F.col("row_id").bitwiseAND(F.lit(2**BLOCK_BITS - 1)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    return staged.groupBy(F.shiftright("row_id", BLOCK_BITS).alias("block")).agg(
        F.bit_or(bit).alias("ids"), F.count("*").alias("n")
    )


def _edge(found: Row, highest: bool) -> int:
    """The lowest or highest id of a block."""
    word = found["ids"] & (2**2**BLOCK_BITS - 1)
    return (found["block"] << BLOCK_BITS) + ((word if highest else word & -word).bit_length() - 1)


def number_sales(staged: DataFrame) -> DataFrame:
    """Add sk_venda, dense in row_id order; a repeated row_id is an error.

    Ids are unique if each block has as many rows as bits. Unique ids without gaps number
    themselves; only ids with gaps need the rows sorted. Rows without an id count as one id.
    What describes a member and not the sale is dropped, so that it is not sorted along.
    """
    known = F.when(F.col("block").isNotNull(), F.struct("block", "ids"))
    rows, repeated, low, high = id_blocks(staged).agg(
        F.sum("n"),
        F.count_if(F.col("n") > F.coalesce(F.bit_count("ids"), F.lit(1))),
        F.min(known), F.max(known),
    ).first()
    if repeated:
        some = [r.row_id for r in duplicate_rows(staged).limit(5).collect()]
        raise LoadError(f"row_id occurs more than once, for example: {some}")
    staged = staged.drop(*[c for c in DESCRIPTIVE if c in staged.columns])
    first = _edge(low, False) if low else 0
    if not rows or low and rows == _edge(high, True) - first + 1:
        return staged.withColumn("sk_venda", F.col("row_id") - F.lit(first) + 1)
    return number_rows(staged, ["row_id"], "sk_venda")


def look_up(
    rows: DataFrame,
    role_name: str,
    dim: Sized,
    limit: int,
    carried: Sequence[str] = (),
    by: Sequence[str] = ("row_id",),
) -> DataFrame:
    """Add the role's foreign key by natural key, NULL where the dimension has no member, and
    the `carried` columns of the member. `by` tells the rows of one key apart."""
    role = ROLES[role_name]
    keys = dim.df.select(
        *[F.col(c).alias(f"_nk_{c}") for c in role.table.natural],
        F.col(role.table.key).alias(role.foreign_key),
        *carried,
    )
    pairs = [(a, f"_nk_{b}") for a, b in zip(LOOKUP[role_name], role.table.natural)]
    null_safe = bool(role.table.nullable)
    if dim.fits(limit):
        joined = rows.join(F.broadcast(keys), same_key(rows, keys, pairs, null_safe), "left")
    else:
        joined = spread_join(rows, keys, pairs, "left", dim.hot, by, null_safe)
    return joined.drop(*[b for _, b in pairs])


def _as_looked_up(role: Role, dim: Sized, limit: int, carried: Sequence[str]) -> Sized:
    """The dimension with the size of the columns that its lookup needs; descriptions stay behind."""
    if dim.fits(limit):
        return dim
    keys = dim.df.select(*role.table.natural, role.table.key, *carried)
    return replace(dim, bytes=min(dim.bytes, measure(keys, dim.rows, limit).bytes))


def key_spans(
    dims: Mapping[str, Sized], carried: Mapping[str, Sequence[str]] = {}
) -> dict[str, tuple[int, int]]:
    """The lowest and highest of the foreign keys and of the numbers that come with them."""
    parts = []
    for name, role in ROLES.items():
        keys = dims[role.table.name].df.withColumnRenamed(role.table.key, role.foreign_key)
        parts.append((keys, [role.foreign_key, *carried.get(name, ())]))
    return measured(parts)


def value_edges(staged: DataFrame) -> list[Column]:
    """Aggregates over staged rows, for `value_spans`."""
    kinds = {f.name: f.dataType for f in staged.schema}
    return edges({
        **{name: whole(c, kinds[c]) for name, c in MEASURES.items()}, "ano_pedido": F.year("order_date").cast("bigint"),
    })


def value_spans(found: Mapping[str, int | None]) -> dict[str, tuple[int, int]]:
    return span(found, [*MEASURES, "ano_pedido"])


def build_fact(
    numbered: DataFrame,
    dims: dict[str, Sized],
    limit: int,
    carried: Mapping[str, Sequence[str]] = {},
    spans: Spans | None = None,
) -> DataFrame:
    """Fact rows with all six keys looked up; first in the dimensions that can be broadcast, so
    that short keys stand for their texts when rows are shuffled. To the large ones only keys go,
    in turn or, from three on, under each other; what is found is joined back by the sale's number.

    `carried`: by role, numbers of the dimension that come with its key. `spans`: of the keys and
    these numbers, and maybe of the values, if the caller has measured them."""
    sized = {
        role: _as_looked_up(ROLES[role], dims[ROLES[role].table.name], limit, carried.get(role, ()))
        for role in LOOKUP
    }
    large = [role for role in LOOKUP if not sized[role].fits(limit)]
    more = [c for columns in carried.values() for c in columns]
    values = {name: F.col(c) for name, c in MEASURES.items()} | {"ano_pedido": F.year("order_date")}
    rows = numbered
    for role in LOOKUP:
        if role not in large:
            rows = look_up(rows, role, sized[role], limit, carried.get(role, ()))
    if 0 < len(large) < STACKED:
        spans = key_spans(dims, carried) if spans is None else spans
        here = [c for c in (*FATO_VENDAS.columns, *more) if c in values or c in rows.columns]
        sales, packed = pack(rows.select(*[values.get(c, F.col(c)).alias(c) for c in here]), spans)
        found, told = _found_in_turn(numbered, sized, large, limit, carried, spans)
        joined = sales.join(found, sales["sk_venda"] == found["_row"], "left").drop("_row")
        whole = unpack(unpack(joined, packed, spans), told, spans, FOUND)
        return whole.select(*FATO_VENDAS.columns, *more)
    if large:
        wanted = [
            Wanted(ROLES[r], LOOKUP[r], sized[r].df, tuple(carried.get(r, ()))) for r in large
        ]
        rows = stacked_lookup(rows, wanted, "sk_venda", numbered)
    return rows.select(*[values.get(c, F.col(c)).alias(c) for c in FATO_VENDAS.columns], *more)


def _found_in_turn(
    numbered: DataFrame,
    sized: Mapping[str, Sized],
    roles: Sequence[str],
    limit: int,
    carried: Mapping[str, Sequence[str]],
    spans: Spans,
) -> tuple[DataFrame, dict[str, T.DataType]]:
    """What the roles' dimensions say of each row, in words by its number `_row`: the rows' keys go
    from one dimension to the next without anything else, and stay behind where they were found."""
    asked = list(dict.fromkeys(c for r in roles for c in LOOKUP[r]))
    keys = numbered.select(F.col("sk_venda").alias("_row"), *asked)
    for i, (role, hot) in enumerate(zip(roles, hot_keys(numbered, *[LOOKUP[r] for r in roles]))):
        told = carried.get(role, ())
        keys = look_up(keys, role, replace(sized[role], hot=hot), limit, told, ["_row"])
        ahead = {c for r in roles[i + 1:] for c in LOOKUP[r]}
        keys = keys.drop(*[c for c in asked if c not in ahead])
    return pack(keys, spans, FOUND)


FOREIGN_KEYS = [r.foreign_key for r in ROLES.values()]
