"""URL filters: captures joined with the list entries that were valid when they were fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from vendaflow.operators.joins import hot_keys, spread_join

HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[^:/?#]+://[^/?#]*([^?#]*)"


def with_patterns(rows: DataFrame) -> DataFrame:
    """The rows with `patterns`, all patterns that the `url` meets, in lower case.

    A pattern is a host, which covers its subdomains, or a host with a path, which covers
    everything below. The last label alone is none. A URL without a host meets none (null).
    """
    host = F.regexp_extract(F.lower("url"), HOST, 1)
    path = F.lower(F.regexp_extract("url", PATH, 1))
    parsed = rows.select("*", host.alias("_host"), path.alias("_path")).select(
        "*",
        F.split("_host", r"\.").alias("_labels"),
        F.filter(F.split("_path", "/"), lambda s: s != "").alias("_segments"),
    )
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("_labels") - 1)),
        lambda i: F.array_join(F.slice("_labels", i, F.size("_labels")), "."),
    )
    below = F.transform(
        F.slice(F.sequence(F.lit(0), F.size("_segments")), 2, F.size("_segments") + 1),
        lambda i: F.concat("_host", F.lit("/"), F.array_join(F.slice("_segments", 1, i), "/")),
    )
    patterns = F.when(F.col("_host") != "", F.array_distinct(F.concat(domains, below)))
    return parsed.withColumn("patterns", patterns).drop("_host", "_path", "_labels", "_segments")


def intervals(changes: DataFrame) -> DataFrame:
    """(list_name, pattern, verdict, valid_from, valid_to) from a dated log of changes.

    A change (list_name, pattern, verdict, changed_on, listed) puts a pattern on a list or
    takes it off; it holds until the next change of the same pattern on the same list, and
    on one day the entry that lists wins. valid_to is the first day it no longer holds, null
    if it still does. Changes without a list, pattern or date are left out.
    """
    entry = W.partitionBy("list_name", "pattern").orderBy("changed_on")
    daily = (
        changes.filter("list_name IS NOT NULL AND pattern IS NOT NULL AND changed_on IS NOT NULL")
        .groupBy("list_name", F.lower("pattern").alias("pattern"), "changed_on")
        .agg(F.max(F.struct("listed", "verdict")).alias("m"))
    )
    return (
        daily.withColumn("valid_to", F.lead("changed_on").over(entry))
        .filter("m.listed")
        .select(
            "list_name", "pattern", F.col("m.verdict").alias("verdict"),
            F.col("changed_on").alias("valid_from"), "valid_to",
        )
    )


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(page_id, verdict, pattern, list_name, listed_on) for each capture (page_id, url, fetched_on).

    A capture is judged by the entries valid on the day it was fetched: the longest pattern
    decides, of equal ones `block` before `allow`, then the later entry. Without one, or
    without a URL or date, the verdict is `none` and the rest null. A URL is judged once
    for each day; every row is returned, as often as it occurs.

    Patterns that many captures meet are found with a sketch of fixed size, and their captures
    are dealt to several tasks, each with its own copy of the pattern's few entries.
    """
    probes = with_patterns(
        captures.filter("url IS NOT NULL AND fetched_on IS NOT NULL")
        .select("url", "fetched_on")
        .distinct()
    ).select("url", "fetched_on", F.explode("patterns").alias("probe"))
    common = hot_keys(probes, ["probe"])[0]
    met = spread_join(
        probes, entries, [("probe", "pattern")], "inner", common, ["url", "fetched_on"]
    ).filter(
        (F.col("valid_from") <= F.col("fetched_on"))
        & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to")))
    )
    best = met.groupBy("url", "fetched_on").agg(
        F.max(
            F.struct(
                F.length("pattern").alias("size"), (F.col("verdict") == "block").alias("blocks"),
                "valid_from", "pattern", "list_name", "verdict",
            )
        ).alias("m")
    )
    return (
        captures.select("page_id", "url", "fetched_on")
        .join(best, ["url", "fetched_on"], "left")
        .select(
            "page_id",
            F.coalesce("m.verdict", F.lit("none")).alias("verdict"),
            F.col("m.pattern").alias("pattern"),
            F.col("m.list_name").alias("list_name"),
            F.col("m.valid_from").alias("listed_on"),
        )
    )


# -- captures and a list from the given pages ----------------------------------------


def dated_captures(pages: DataFrame) -> DataFrame:
    """Pages with a day between 2020 and 2023 that follows from their page_id."""
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.pmod("page_id", F.lit(1461)).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched_on"))


def list_changes(pages: DataFrame) -> DataFrame:
    """A list with up to three dated changes for two in three of the hosts, domains and sections.

    Which patterns, verdicts and days follows from a digest of the pattern.
    """
    found = with_patterns(pages.filter("url IS NOT NULL").select("url")).select(
        F.explode("patterns").alias("pattern")
    )
    number = F.conv(F.substring(F.md5(F.col("pattern").cast("binary")), 1, 6), 16, 10).cast("bigint")
    listed = (
        found.distinct()
        .filter(F.size(F.split("pattern", "/")) <= 2)
        .withColumn("n", number)
        .filter("n % 3 <> 0")
        .withColumn("verdict", F.when(F.col("n") % 5 == 0, "allow").otherwise("block"))
    )
    start = (F.col("n") % 400).cast("int")
    off = start + (F.lit(100) + F.col("n") % 300).cast("int")
    again = off + (F.lit(50) + F.col("n") % 200).cast("int")
    first = F.lit("2020-01-01").cast("date")
    change = [
        F.struct(F.date_add(first, day).alias("changed_on"), F.lit(on).alias("listed"))
        for day, on in ((start, True), (off, False), (again, True))
    ]
    return listed.select(
        F.lit("digest").alias("list_name"), "pattern", "verdict", F.explode(F.array(*change)).alias("c")
    ).select("list_name", "pattern", "verdict", "c.changed_on", "c.listed")


JUDGE_SQL = r"""
WITH parsed AS (
    SELECT page_id, url, DATE '2020-01-01' + CAST(page_id % 1461 AS INTEGER) AS fetched_on,
        regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1) AS host,
        list_filter(string_split(regexp_extract(lower(url), '^[^:/?#]+://[^/?#]*([^?#]*)', 1), '/'),
            lambda s: s <> '') AS segments
    FROM pages WHERE url IS NOT NULL
), met AS (
    SELECT DISTINCT page_id, url, fetched_on, unnest(list_concat(
        list_transform(range(1, greatest(1, len(string_split(host, '.')) - 1) + 1),
            lambda i: array_to_string(string_split(host, '.')[i:], '.')),
        list_transform(range(1, len(segments) + 1),
            lambda i: host || '/' || array_to_string(segments[1:i], '/')))) AS pattern
    FROM parsed WHERE host <> ''
), numbered AS (
    SELECT DISTINCT pattern, CAST('0x' || substr(md5(pattern), 1, 6) AS BIGINT) AS n
    FROM met WHERE len(string_split(pattern, '/')) <= 2
), entries AS (
    SELECT lower(pattern) AS pattern, n,
        CASE WHEN n % 5 = 0 THEN 'allow' ELSE 'block' END AS verdict,
        DATE '2020-01-01' + CAST(n % 400 AS INTEGER) AS start,
        DATE '2020-01-01' + CAST(n % 400 + 100 + n % 300 AS INTEGER) AS gone,
        DATE '2020-01-01' + CAST(n % 400 + 150 + n % 300 + n % 200 AS INTEGER) AS again
    FROM numbered WHERE n % 3 <> 0
), valid AS (
    SELECT pattern, verdict, start AS valid_from, gone AS valid_to FROM entries
    UNION ALL SELECT pattern, verdict, again, DATE '9999-01-01' FROM entries
), ranked AS (
    SELECT page_id, m.url, fetched_on, v.pattern, verdict, valid_from,
        row_number() OVER (PARTITION BY page_id, m.url, fetched_on
            ORDER BY length(v.pattern) DESC, verdict DESC, valid_from DESC, v.pattern DESC) AS r
    FROM met m JOIN valid v ON lower(m.pattern) = v.pattern
        AND fetched_on >= valid_from AND fetched_on < valid_to
)
SELECT p.page_id, coalesce(r.verdict, 'none') AS verdict, r.pattern,
    CASE WHEN r.pattern IS NOT NULL THEN 'digest' END AS list_name, r.valid_from AS listed_on
FROM pages p LEFT JOIN ranked r
    ON p.page_id = r.page_id AND p.url = r.url AND r.r = 1
"""
