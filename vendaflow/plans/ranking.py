"""The first lines of a ranking over a large dimension, without naming every member's total.

A line sums the members that share its name, at most `most` of them. The best of them has at least
the mean, so a line that reaches a bound has a member with at least that bound over `most` (or, of
a bound below zero, the bound itself). Three steps follow from that: the best members give
some whole lines and with them a bound; the bound leaves few members; only their lines are totalled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from vendaflow.operators.joins import same_key
from vendaflow.plans.star import ATTRIBUTES, SUMMED, Filters, Measure, Star
from vendaflow.schema import ROLES
from vendaflow.session import scratch_path

FIRST_MEMBERS = 20_000  # members of the lines that give the bound; a few MB
NAME_BYTES = 4 * (255 + 50 + 50) + 100  # the most that a line's key takes in a hash relation


def most_namesakes(members: DataFrame, names: Sequence[str]) -> int:
    """The largest number of members that share all of `names`."""
    return members.groupBy(*names).count().agg(F.max("count")).first()[0] or 1


@dataclass(frozen=True)
class Ranking:
    """Totals per member of one role, and what names them."""

    sums: DataFrame  # one row per member with sales: `key` and SUMMED
    members: DataFrame  # `key` and `names`
    key: str
    names: list[str]
    most: int
    limit: int

    def named(self, keys: DataFrame, rows: int) -> DataFrame:
        """All members of the lines that some of `keys` belong to, with their names."""
        some = keys.select(F.col(self.key).alias("_key"))
        if rows * 40 <= self.limit:
            some = F.broadcast(some)
        lines = self.members.join(some, F.col(self.key) == F.col("_key"), "left_semi")
        lines = lines.select(*[F.col(n).alias(f"_{n}") for n in self.names]).distinct()
        if rows * NAME_BYTES <= self.limit:
            lines = F.broadcast(lines)
        match = same_key(self.members, lines, [(n, f"_{n}") for n in self.names])
        return self.members.join(lines, match, "left_semi")

    def lines(self, keys: DataFrame, rows: int, measures: Sequence[Column]) -> DataFrame:
        """The whole lines that some of `keys` belong to."""
        named = self.named(keys, rows)
        if rows * self.most * NAME_BYTES <= self.limit:
            named = F.broadcast(named)
        return self.sums.join(named, self.key).groupBy(*self.names).agg(*measures)

    def bound(self, column: str, count: int, best: bool) -> Decimal | None:
        """A total that `count` lines reach; None if there are not that many lines.

        So many of the best members are taken that they belong to `count` lines or are all."""
        value = _value(column, best)
        members = count * self.most
        first = self.sums.orderBy(value.desc(), self.key).limit(members)
        totals = self.lines(first, members, [F.sum(value).alias("_total")])
        reached = totals.orderBy(F.desc("_total")).limit(count).collect()
        return reached[-1]["_total"] if len(reached) == count else None

    def candidates(self, column: str, bound: Decimal | None, best: bool) -> DataFrame:
        """Members whose lines can reach the bound, among them one of each that does."""
        if bound is None:
            return self.sums
        value = _value(column, best)
        reach = value * self.most if bound > 0 else value
        return self.sums.filter(reach >= F.lit(bound))


def _value(column: str, best: bool) -> Column:
    return F.col(column) if best else -F.col(column)


def ranking(star: Star, role_name: str, names: Sequence[str], filters: Filters) -> Ranking | None:
    """The sums per member, written once; None where the three steps save nothing or do not apply:
    members that fit a broadcast, names shared by too many, or sales that the filters do not
    single out without a join."""
    role = ROLES[role_name]
    dim = star.tables[role.table.name]
    most = star.namesakes.get(role.table.name)
    if most is None or dim.fits(star.limit) or (filters.chosen() and not star.zones):
        return None
    rows = star.fact(filters).withColumn("linhas", F.lit(1))
    sums = rows.groupBy(role.foreign_key).agg(*[F.sum(c).alias(c) for c in SUMMED])
    path = scratch_path(rows.sparkSession, "ranking")
    sums.write.parquet(path)
    members = dim.df.select(
        F.col(role.table.key).alias(role.foreign_key),
        *[F.col(ATTRIBUTES[n][1]).alias(n) for n in names],
    )
    kept = rows.sparkSession.read.schema(sums.schema).parquet(path)
    return Ranking(kept, members, role.foreign_key, list(names), most, star.limit)


def contenders(
    star: Star, role_name: str, names: Sequence[str], measures: Sequence[Measure], column: str,
    filters: Filters, count: int, best: bool,
) -> DataFrame | None:
    """Lines with their measures, among them the first `count` by the total of `column`, ties
    included; None if the plain way is to be taken."""
    most = star.namesakes.get(ROLES[role_name].table.name)
    if most is None or count < 1 or count * most * most > FIRST_MEMBERS:
        return None
    found = ranking(star, role_name, names, filters)
    if found is None:
        return None
    left = found.candidates(column, found.bound(column, count, best), best)
    return found.lines(left, left.count(), [m.column for m in measures])
