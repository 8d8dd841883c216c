"""Dimension members from staged rows, and the two ways of merging them in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vendaflow.functions.calendar import calendar
from vendaflow.operators.joins import same_key
from vendaflow.operators.numbering import number_rows
from vendaflow.session import COMPRESSION, scratch_path, writing
from vendaflow.schema import (
    DIM_CLIENTE, DIM_ENVIO, DIM_LOCALIZACAO, DIM_PRODUTO, DIM_TEMPO, Table,
)

# Dimension column -> staged column it comes from.
ORIGIN = {
    DIM_PRODUTO.name: {
        "product_id": "product_id", "nome_produto": "product_name",
        "categoria": "category", "subcategoria": "sub_category",
    },
    DIM_CLIENTE.name: {
        "customer_id": "customer_id", "nome_cliente": "customer_name", "segmento": "segment",
    },
    DIM_LOCALIZACAO.name: {
        "pais": "country", "regiao": "region", "estado": "state", "cidade": "city",
        "cep": "postal_code",
    },
    DIM_ENVIO.name: {"ship_mode": "ship_mode"},
}
FIRST = "_first"


def dates_seen(staged: DataFrame) -> DataFrame:
    """Each date seen as order or ship date, once, with its calendar attributes."""
    days = (
        staged.select(F.explode(F.array("order_date", "ship_date")).alias("data"))
        .filter(F.col("data").isNotNull())
        .distinct()
    )
    attributes = calendar(F.col("data"))
    return days.select("data", *[e.alias(c) for c, e in attributes.items()])


def first_seen(staged: DataFrame, table: Table) -> DataFrame:
    """One row per natural key: the attributes of its first row, and that row's id.

    Whole tuples are grouped first: their buffer is one long, so it is a hash aggregate
    that shrinks a hot key inside each map task. Only distinct tuples reach min_by.
    """
    columns = [F.col(source).alias(c) for c, source in ORIGIN[table.name].items()]
    tuples = (
        staged.select(*columns, "row_id")
        .groupBy(*ORIGIN[table.name])
        .agg(F.min("row_id").alias(FIRST))
    )
    if not table.attributes:
        return tuples
    winner = F.min_by(F.struct(*table.attributes), FIRST).alias("_winner")
    return (
        tuples.groupBy(*table.natural)
        .agg(winner, F.min(FIRST).alias(FIRST))
        .select(*table.natural, "_winner.*", FIRST)
    )


def members(staged: DataFrame, table: Table) -> DataFrame:
    return dates_seen(staged) if table is DIM_TEMPO else first_seen(staged, table)


def _order(table: Table) -> list[str]:
    return ["data"] if table is DIM_TEMPO else [FIRST]


def _numbered(rows: DataFrame, table: Table, start: int) -> DataFrame:
    return number_rows(rows, _order(table), table.key, start).select(*table.columns)


def _last_key(existing: DataFrame, table: Table) -> int:
    return existing.agg(F.max(table.key)).first()[0] or 0


def _absent(incoming: DataFrame, existing: DataFrame, table: Table) -> DataFrame:
    keys = existing.select(*[F.col(c).alias(f"_old_{c}") for c in table.natural])
    match = same_key(incoming, keys, [(c, f"_old_{c}") for c in table.natural])
    return incoming.join(keys, match, "left_anti")


def insert_absent(existing: DataFrame | None, incoming: DataFrame, table: Table) -> DataFrame:
    """Keep existing rows as they are; number unseen keys after the last one."""
    if existing is None:
        return _numbered(incoming, table, 0)
    new = _absent(incoming, existing, table)
    return existing.unionByName(_numbered(new, table, _last_key(existing, table)))


def upsert_type1(existing: DataFrame | None, incoming: DataFrame, table: Table) -> DataFrame:
    """Overwrite the attributes of known keys, NULLs included, and insert unseen keys.

    Keys that do not come in again stay untouched; nothing is deleted.
    """
    if existing is None:
        return _numbered(incoming, table, 0)
    joined = _joined(existing, incoming, table)
    new = joined.filter(F.col(table.key).isNull()).drop(table.key)
    known = joined.filter(F.col(table.key).isNotNull()).select(*table.columns)
    return known.unionByName(_numbered(new, table, _last_key(known, table)))


def _joined(existing: DataFrame, incoming: DataFrame, table: Table) -> DataFrame:
    """Known and incoming members side by side, saved: without a key, they are new ones."""
    fresh = incoming.select(
        *[F.col(c).alias(f"_new_{c}") for c in (*table.natural, *table.attributes)],
        F.col(FIRST),
        F.lit(True).alias("_came"),
    )
    match = same_key(existing, fresh, [(c, f"_new_{c}") for c in table.natural])

    def merged(c: str) -> Column:
        return F.when(F.col("_came"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    both = existing.join(fresh, match, "full").select(
        table.key, *[merged(c) for c in (*table.natural, *table.attributes)], FIRST
    )
    path = scratch_path(existing.sparkSession, f"merge-{table.name}")
    with writing(existing.sparkSession):
        both.write.parquet(path, compression=COMPRESSION)
    return existing.sparkSession.read.schema(both.schema).parquet(path)


def overwrites(table: Table) -> bool:
    """Whether a load overwrites the attributes of known members."""
    return bool(table.attributes) and table is not DIM_TEMPO


def merge(existing: DataFrame | None, staged: DataFrame, table: Table) -> DataFrame:
    """The dimension after a load of `staged`, by the rule that holds for the table."""
    incoming = members(staged, table)
    rule = upsert_type1 if overwrites(table) else insert_absent
    return rule(existing, incoming, table)
