"""Stored summaries of the fact, of which the smallest that suffices answers a report.

Each is the fact summed by a set of attributes. Two also hold which orders and customers their
groups have, as bitmaps over whole-number keys: merging bitmaps gives exact distinct counts of
any coarser grouping, which adding up counts would not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from vendaflow.errors import LoadError
from vendaflow.operators.joins import same_key
from vendaflow.operators.numbering import number_rows
from vendaflow.plans.star import SUMMED, Filters, Measure, Star, total
from vendaflow.plans.warehouse import Warehouse
from vendaflow.session import path_exists, writing

COUNTED = ["order_id", "sk_cliente"]


@dataclass(frozen=True)
class Summary:
    """Attributes it is grouped by, and what it can count distinct."""

    keys: Sequence[str]
    counted: Sequence[str] = ()

    def covers(self, names: Sequence[str], counted: Sequence[str]) -> bool:
        return set(names) <= set(self.keys) and set(counted) <= set(self.counted)


MONTH = ["ano_mes", "ano", "mes", "nome_mes"]
# Each covers what the reports of one tab ask for; `filtros` all sums under any choice.
SUMMARIES = {
    "estado": Summary(["regiao", "estado", "segmento", "ano"], COUNTED),
    "mes": Summary(["segmento", *MONTH], COUNTED),
    "subcategoria": Summary(["categoria", "subcategoria", "segmento", "regiao", "ano"]),
    "envio": Summary(["ship_mode", "segmento", "regiao", "categoria", "ano"]),
    "local": Summary(["regiao", "estado", "segmento", "categoria", "ano"]),
    "filtros": Summary(["segmento", "regiao", "categoria", *MONTH]),
}
MANIFEST = "name string, rows bigint"


def build(house: Warehouse, summaries: Mapping[str, Summary] = SUMMARIES) -> None:
    """Write the summaries of the newest load, one after the other; the file that names them
    comes last, so that readers find all or none."""
    spark, root = house.spark, _folder(house)
    if path_exists(spark, f"{root}/manifest"):
        return
    star = house.star()
    sums = [total(c, c) for c in SUMMED]
    lines = []
    for name, summary in summaries.items():
        with writing(spark):
            star.aggregate(summary.keys, sums).write.mode("overwrite").parquet(f"{root}/{name}/sums")
        rows = spark.read.parquet(f"{root}/{name}/sums").count()
        if summary.counted:
            bits = _bits(star, summary)
            with writing(spark):
                bits.write.mode("overwrite").parquet(f"{root}/{name}/bits")
        lines.append((name, rows))
    spark.createDataFrame(lines, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest")


def _folder(house: Warehouse) -> str:
    """Below the load's own name, so that the summaries of another load are never taken."""
    entries = house.entries()
    if not entries:
        raise LoadError(f"nothing has been loaded into {house.root}")
    return f"{house.root}/summaries/{entries[-1].path.rsplit('/', 1)[-1]}"


def _bits(star: Star, summary: Summary) -> DataFrame:
    """(keys, counted, bucket, bits): which keys occur in each group, 32,768 to a row.

    Orders, and customers, are numbered by the first group that they occur in: the keys of a group
    lie together, so that bitmaps are full, and their number is that of keys over 32,768 and that
    of groups that share keys, not that of groups times buckets. Rows are made distinct first:
    what is sent on is at most a row per order, or customer, and group, and a hot order has as many
    rows as groups. A bitmap is built where its keys meet; keys are shuffled, bitmaps are not.
    """
    lines = star.lines(summary.keys)
    parts = []
    for column in summary.counted:
        per_group = lines.select(*summary.keys, column).distinct()
        groups = F.array_sort(F.collect_list(F.struct(*summary.keys))).alias("_groups")
        keys = per_group.groupBy(column).agg(groups).withColumn("_first", F.col("_groups")[0])
        numbered = number_rows(keys, ["_first", column], "key")
        parts.append(numbered.select(F.inline("_groups"), F.lit(column).alias("counted"), "key"))
    rows = reduce(DataFrame.unionByName, parts)
    rows = rows.withColumn("bucket", F.bitmap_bucket_number("key"))
    groups = [*summary.keys, "counted", "bucket"]
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bits")
    return rows.repartition(*groups).groupBy(*groups).agg(bits)


class SummaryStar(Star):
    """A star that answers from summaries where one covers the attributes, filters and counts.

    Every summary is at least as fine as what it answers, and sums and bitmaps merge exactly,
    so results equal those over the fact; other questions go to the fact.
    """

    def __init__(self, house: Warehouse, summaries: Mapping[str, Summary] = SUMMARIES):
        star = house.star()
        super().__init__(star.tables, star.limit, star.zones)
        self.spark, self.folder = house.spark, _folder(house)
        self.summaries = summaries
        self.rows: dict[str, int] = {}
        if path_exists(self.spark, f"{self.folder}/manifest"):
            found = self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifest").collect()
            self.rows = {r["name"]: r["rows"] for r in found}

    def choose(self, by: Sequence[str], counted: Sequence[str], filters: Filters) -> str | None:
        """The smallest summary that covers what is asked; None if none does."""
        names = [*by, *filters.chosen(), *(["ano"] if filters.anos else [])]
        fit = [n for n in self.rows if n in self.summaries and self.summaries[n].covers(names, counted)]
        return min(fit, key=lambda n: (self.rows[n], n), default=None)

    def aggregate(
        self, by: Sequence[str], measures: Sequence[Measure], filters: Filters = Filters()
    ) -> DataFrame:
        distinct = [m for m in measures if m.counted]
        name = self.choose(by, [m.counted for m in distinct], filters)
        if name is None:
            return super().aggregate(by, measures, filters)
        sums = self._read(name, "sums", filters).groupBy(*by).agg(*[m.column for m in measures if not m.counted])
        if not distinct:
            return sums
        counts = distinct_counts(self._read(name, "bits", filters), by, distinct)
        renamed = counts.select(*[F.col(c).alias(f"_{c}") for c in by], *[m.name for m in distinct])
        joined = sums.join(renamed, same_key(sums, renamed, [(c, f"_{c}") for c in by]))
        return joined.select(*by, *[m.name for m in measures])

    def distinct_rollup(
        self, by: Sequence[str], measures: Sequence[Measure], filters: Filters = Filters()
    ) -> DataFrame:
        """Distinct counts for each prefix of `by` down to the whole, with `nivel` as grouping_id.

        Every level comes from the bitmaps of the one below it, not from the fact."""
        name = self.choose(by, [m.counted for m in measures], filters)
        if name is None:
            raise LoadError("no summary covers these attributes, filters and counts")
        bits, levels = self._read(name, "bits", filters), []
        for n in range(len(by), -1, -1):
            bits = merged(bits, by[:n])
            level = distinct_counts(bits, by[:n], measures)
            absent = [F.lit(None).cast("string").alias(c) for c in by[n:]]
            nivel = F.lit(2 ** (len(by) - n) - 1).alias("nivel")
            levels.append(level.select(*by[:n], *absent, nivel, *[m.name for m in measures]))
        return reduce(DataFrame.unionByName, levels)

    def _read(self, name: str, part: str, filters: Filters) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.folder}/{name}/{part}")
        for column, values in filters.chosen().items():
            rows = rows.filter(F.col(column).isin(values))
        return rows.filter(F.col("ano").isin(list(filters.anos))) if filters.anos else rows


def merged(bits: DataFrame, by: Sequence[str]) -> DataFrame:
    """The bitmaps of a coarser grouping; joined bit by bit, in the map tasks first."""
    return bits.groupBy(*by, "counted", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bits: DataFrame, by: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Distinct keys of each group: ones are counted once the bitmaps of a bucket are merged."""
    ones = merged(bits, by).withColumn("ones", F.bitmap_count("bits"))
    counts = [
        F.coalesce(F.sum(F.when(F.col("counted") == m.counted, F.col("ones"))), F.lit(0)).alias(m.name)
        for m in measures
    ]
    return ones.groupBy(*by).agg(*counts)
