"""A finished load moved onto a newer one that was published in the meantime.

Both loads grew from the same tables, whose members keep their keys. So only the members that either
load added are compared, and only sales that point at one whose key changes get another key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from vendaflow.operators.dimensions import overwrites
from vendaflow.operators.joins import Sized, hot_keys, same_key, spread_join
from vendaflow.operators.numbering import number_rows
from vendaflow.plans.layout import CLUSTERED, STORED
from vendaflow.schema import ROLES, Table

OLD = "_old"


def new_keys(mine: DataFrame, newer: Sized, table: Table, last: int) -> DataFrame:
    """The members after the `last` common key that this load has: their key in it as `_old`, and
    the key that they get.

    A member that the newer load added too takes its key. The others follow after its members, in
    the order that they had.
    """
    added = mine.filter(F.col(table.key) > last).withColumnRenamed(table.key, OLD)
    theirs = newer.df.filter(F.col(table.key) > last).select(
        table.key, *[F.col(c).alias(f"_their_{c}") for c in table.natural]
    )
    match = same_key(added, theirs, [(c, f"_their_{c}") for c in table.natural])
    columns = [OLD, *table.columns]
    own = added.join(theirs, match, "left_anti")
    return added.join(theirs, match).select(columns).unionByName(
        number_rows(own, [OLD], table.key, newer.rows).select(columns)
    )


def used_keys(fact: DataFrame, table: Table) -> DataFrame:
    """Keys of the members that came in with the sales of a load."""
    keys = [r.foreign_key for r in ROLES.values() if r.table is table]
    return fact.select(F.explode(F.array(*keys)).alias("_used")).distinct()


def rebased(
    mine: DataFrame, newer: Sized, settled: DataFrame, fact: DataFrame, table: Table, last: int
) -> DataFrame:
    """The dimension after both loads, this one being the later. `settled`: see `new_keys`.

    Where attributes are overwritten, this load's hold for every member that came in with it.
    """
    own = settled.filter(F.col(table.key) > newer.rows).select(*table.columns)
    if not overwrites(table):
        return newer.df.unionByName(own)
    common = mine.filter(F.col(table.key) <= last)
    came = common.join(used_keys(fact, table), F.col(table.key) == F.col("_used"), "left_semi")
    shared = settled.filter(F.col(table.key) <= newer.rows).select(*table.columns)
    latest = came.unionByName(shared).select(
        F.col(table.key).alias("_key"), F.struct(*table.attributes).alias("_latest")
    )
    both = newer.df.join(latest, F.col(table.key) == F.col("_key"), "left")
    merged = [
        F.when(F.col("_key").isNotNull(), F.col("_latest")[c]).otherwise(F.col(c)).alias(c)
        for c in table.attributes
    ]
    return both.select(table.key, *table.natural, *merged).unionByName(own)


def relabel(fact: DataFrame, moved: Mapping[str, Sized], limit: int) -> DataFrame:
    """The fact with the keys that its members got: `moved` has `_old` and the new key by table.

    With small maps no sale leaves its task, and files stay as they were along the curve. After a
    shuffle sales are dealt by year and filter attributes again.
    """
    roles = [r for r in ROLES.values() if r.table.name in moved]
    large = [r for r in roles if not moved[r.table.name].fits(limit)]
    hot = hot_keys(fact, *[[r.foreign_key] for r in large]) if large else []
    frequent = {r.name: keys for r, keys in zip(large, hot)}
    for role in roles:
        keys = moved[role.table.name].df.select(
            F.col(OLD).alias("_from"), F.col(role.table.key).alias("_to")
        )
        pairs = [(role.foreign_key, "_from")]
        if role in large:
            joined = spread_join(fact, keys, pairs, "left", frequent[role.name], ["row_id"])
        else:
            joined = fact.join(F.broadcast(keys), same_key(fact, keys, pairs, False), "left")
        settled = F.coalesce(F.col("_to"), F.col(role.foreign_key))
        fact = joined.withColumn(role.foreign_key, settled).drop("_from", "_to")
    along = [STORED[name] for name in CLUSTERED]
    if large:
        fact = fact.hint("rebalance", "ano_pedido", *along)
    return fact.sortWithinPartitions("ano_pedido", *along, "order_id")
