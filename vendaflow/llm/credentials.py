"""Secret scans: credentials of several parts, linked by an interval join within scopes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from vendaflow.llm.common import saved

REACH = 200  # code points between the parts of one credential
BREAK = r"\n[\x20\t\r]*\n"  # a blank line ends a scope


@dataclass(frozen=True)
class Kind:
    """What a span is. `least`: characters of the group `judged` below which a match is dropped.

    A weak kind is told only together with its complement.
    """

    name: str
    role: str  # identifier, secret or endpoint
    pattern: str
    judged: int
    least: int
    weak: bool


# In the order in which spans with the same start are listed. A shorter run of capitals or hex
# digits is never part of a longer match, so the least length stands in these two patterns; a
# dropped assignment still uses up its text, so it does not there.
KINDS = (
    Kind(
        "assign", "secret",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6, False,
    ),
    Kind("access", "identifier", r"AKIA[A-Z0-9]{16,}", 0, 20, False),
    Kind("hex", "secret", r"[0-9a-f]{24,}", 0, 24, False),
    Kind("key", "secret", r"[A-Za-z0-9+/_-]{32,}", 0, 32, True),
    Kind(
        "ident", "identifier",
        r"""(?i)(user_?name|user|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)""",
        2, 3, True,
    ),
    Kind(
        "endpoint", "endpoint",
        r"(?:https?|ftp|s3|postgres|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9.-]+(?::[0-9]+)?",
        0, 8, True,
    ),
)
NAMES = [k.name for k in KINDS]
SCOPE_END = len(KINDS)  # number of the rows that stand for blank lines
SPAN = "struct<start: bigint, kind: int, end: bigint>"


def _numbers(choose) -> list[int]:
    return [i for i, k in enumerate(KINDS) if choose(k)]


WEAK = _numbers(lambda k: k.weak)
BASE = _numbers(lambda k: not k.weak)


def _lengths(pattern: str, fit: Column) -> Column:
    """Of each match of `pattern` in text: characters since the match before it, its own length,
    and whether it is kept; null if there is no match. `fit` is an array, one entry a match.

    Matches and what lies between them come from two functions that run the same pattern, so
    the starts are sums of lengths."""
    between = F.transform(F.split("text", pattern, -1), F.length)
    sizes = F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), F.length)
    measured = F.zip_with(between, sizes, lambda g, s: F.struct(g.alias("gap"), s.alias("size")))
    kept = F.zip_with(
        measured, fit, lambda m, f: F.struct(m["gap"].alias("gap"), m["size"].alias("size"), f.alias("fit"))
    )
    return F.when(F.col("text").rlike(pattern), F.slice(kept, 1, F.size(sizes)))


def _fit(kind: Kind) -> Column:
    def keeps(match: Column) -> Column:
        good = F.length(match) >= kind.least
        if kind.name == "key":  # random texts have all three; words, paths and rulers do not
            for some in ("[a-z]", "[A-Z]", "[0-9]"):
                good = good & match.rlike(some)
        return good

    return F.transform(F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(kind.judged)), keeps)


def matches(docs: DataFrame) -> DataFrame:
    """(row, doc_id, found): the lengths around all matches of every text, by kind.

    Written once; the number `row` tells documents apart whose doc_id is null or repeated. Weak
    kinds and blank lines are looked for only in texts with an identifier."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    linkable = F.lit(False)
    for kind in KINDS:
        if kind.role == "identifier":
            linkable = linkable | F.col("text").rlike(kind.pattern)
    found = []
    for number, kind in enumerate(KINDS):
        lengths = _lengths(kind.pattern, _fit(kind))
        found.append((number, F.when(linkable, lengths) if kind.weak else lengths))
    every = F.transform(F.regexp_extract_all("text", F.lit(BREAK), F.lit(0)), lambda m: F.lit(True))
    found.append((SCOPE_END, F.when(linkable, _lengths(BREAK, every))))
    parts = F.array(*[F.struct(F.lit(n).alias("kind"), c.alias("parts")) for n, c in found])
    return saved(
        texts.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.filter(parts, lambda p: p["parts"].isNotNull()).alias("found"),
        ),
        "matches",
    )


def placed(found: DataFrame) -> DataFrame:
    """(row, kind, start, end, scope, covered) of every kept match and weak candidate.

    `scope` counts the blank lines before it; `covered`: inside or across a base span that
    starts no later. Running sums over the matches of one text."""
    each = (
        found.filter(F.size("found") > 0)
        .select("row", F.explode("found").alias("f"))
        .select("row", "f.kind", F.posexplode("f.parts").alias("at", "p"))
        .select("row", "kind", "at", "p.gap", "p.size", "p.fit")
        .repartition("row")  # serves both windows
    )
    of_kind = W.partitionBy("row", "kind").orderBy("at")
    in_text = W.partitionBy("row").orderBy("start", "kind")
    end = F.sum((F.col("gap") + F.col("size")).cast("bigint")).over(of_kind)
    spans = each.withColumn("end", end).filter("fit").withColumn("start", F.col("end") - F.col("size"))
    earlier = in_text.rowsBetween(W.unboundedPreceding, -1)
    base_end = F.max(F.when(F.col("kind").isin(BASE), F.col("end"))).over(earlier)
    return spans.select(
        "row", "kind", "start", "end",
        F.count_if(F.col("kind") == SCOPE_END).over(in_text).alias("scope"),
        F.coalesce(base_end > F.col("start"), F.lit(False)).alias("covered"),
    ).filter(F.col("kind") != SCOPE_END)


def linked(spans: DataFrame, reach: int = REACH) -> DataFrame:
    """(row, kind, start, end) of the weak spans whose complement is near.

    An identifier reaches `reach` code points to both sides, as far as its scope goes. If a
    secret lies wholly there, beside it, the identifier is told with all secrets and endpoints
    there. The interval join meets in bins of `reach` code points: a part has one bin, an
    identifier those it reaches. Spans of a kind do not overlap, so that a bin holds only so
    many, however long the text and however many copies it has.
    """
    known = spans.filter(F.col("kind").isin(BASE) | ~F.col("covered"))
    role = {r: _numbers(lambda k, r=r: k.role == r) for r in ("identifier", "secret", "endpoint")}
    span = F.struct("start", "kind", "end").cast(SPAN)
    identifiers = known.filter(F.col("kind").isin(role["identifier"])).select(
        "row", "scope", span.alias("id"),
        (F.col("start") - reach).alias("since"), (F.col("end") + reach).alias("until"),
    ).withColumn(
        "bin", F.explode(F.sequence(F.floor(F.col("since") / reach), F.floor(F.col("until") / reach)))
    )
    parts = known.filter(F.col("kind").isin(role["secret"] + role["endpoint"])).select(
        "row", "scope", F.floor(F.col("start") / reach).alias("bin"), span.alias("part")
    )
    near = (
        (F.col("part.start") >= F.col("since"))
        & (F.col("part.end") <= F.col("until"))
        & ((F.col("part.end") <= F.col("id.start")) | (F.col("part.start") >= F.col("id.end")))
    )
    groups = (
        identifiers.join(parts, ["row", "scope", "bin"])
        .filter(near)
        .groupBy("row", "id")
        .agg(
            F.count_if(F.col("part.kind").isin(role["secret"])).alias("secrets"),
            F.collect_list("part").alias("parts"),  # bounded by 2 * reach code points
        )
        .filter("secrets > 0")
    )
    return (
        groups.select("row", F.explode(F.array_append("parts", F.col("id"))).alias("s"))
        .filter(F.col("s.kind").isin(WEAK))
        .select("row", "s.kind", "s.start", "s.end")
        .distinct()
    )


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """(doc_id, base, spans): the spans of every text, by start, then kind as listed.

    A span is (start, kind, end) in code points, end exclusive, kind an index of NAMES. `base`
    has the kinds that are told alone: leftmost matches of a kind, none overlapping, too short
    ones dropped. `spans` adds weak ones, told only where an identifier and a secret are at most
    `reach` code points apart with no blank line between them (see `linked`).

    Every row gives one row, as often as it occurs, null ids included; a null or empty text has
    no span. Only doc_id and text are read, other columns are left out.
    """
    found = matches(docs)
    spans = saved(placed(found), "spans")
    told = spans.filter(F.col("kind").isin(BASE)).select("row", "kind", "start", "end")
    told = told.unionByName(linked(spans, reach))
    lists = told.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end").cast(SPAN))).alias("spans")
    )
    none = F.array().cast(f"array<{SPAN}>")
    return (
        found.select("row", "doc_id")
        .join(lists, "row", "left")
        .select("doc_id", F.coalesce("spans", none).alias("spans"))
        .select("doc_id", F.filter("spans", lambda s: s["kind"].isin(BASE)).alias("base"), "spans")
    )


def printed(spans: str) -> Column:
    """kind:start:end of the spans, joined by commas."""
    names = F.array(*[F.lit(n) for n in NAMES])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def digests(found: DataFrame) -> DataFrame:
    """The counts by base kind, a digest of the base spans, and all spans as text."""
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    counts = [count(kind).alias(f"n_{NAMES[kind]}") for kind in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(printed("base"), 256).alias("base_sha256"), printed("spans").alias("spans")
    )


# The same patterns for an engine whose (?i) also folds letters beyond ASCII.
_SQL_PATTERNS = {
    k.name: k.pattern.replace("'", "''") for k in KINDS
} | {"break": BREAK}
for _name in ("assign", "ident"):
    _words, _rest = _SQL_PATTERNS[_name].removeprefix("(?i)").split(")", 1)
    _folded = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in _words)
    _SQL_PATTERNS[_name] = f"{_folded}){_rest}"


def _sql_matches(number: int, name: str, judged: int, least: int) -> str:
    p = _SQL_PATTERNS[name]
    mixed = " AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')"
    return f"""
    SELECT row, {number} AS kind, unnest(generate_series(1, len(whole))) AS nth, unnest(whole) AS w,
        unnest(parts) AS m, unnest(between[1:len(whole)]) AS g, length(m) >= {least}{mixed if name == "key" else ""} AS fit
    FROM (SELECT row, regexp_extract_all(text, '{p}') AS whole, regexp_extract_all(text, '{p}', {judged}) AS parts,
        string_split_regex(text, '{p}') AS between FROM texts WHERE regexp_matches(text, '{p}'))"""


SCAN_SQL = f"""
WITH texts AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), every AS ({" UNION ALL ".join(_sql_matches(i, k.name, k.judged, k.least) for i, k in enumerate(KINDS))}
    UNION ALL {_sql_matches(SCOPE_END, "break", 0, 0)}
), ends AS (
    SELECT row, kind, fit, length(w) AS size,
        sum(length(g) + length(w)) OVER (PARTITION BY row, kind ORDER BY nth) AS e FROM every
), spans AS (
    SELECT row, kind, e - size AS s, e FROM ends WHERE fit
), known AS (
    SELECT a.row, a.kind, a.s, a.e, (SELECT count(*) FROM spans b
        WHERE b.row = a.row AND b.kind = {SCOPE_END} AND b.s <= a.s) AS scope
    FROM spans a WHERE a.kind <= 2 OR a.kind < {SCOPE_END} AND NOT EXISTS (SELECT 1 FROM spans b
        WHERE b.row = a.row AND b.kind <= 2 AND b.s <= a.s AND b.e > a.s)
), near AS (
    SELECT i.row, i.kind AS ik, i.s AS i_s, i.e AS i_e, p.kind AS pk, p.s AS p_s, p.e AS p_e
    FROM known i JOIN known p ON i.row = p.row AND i.scope = p.scope AND i.kind IN (1, 4) AND p.kind IN (0, 2, 3, 5)
        AND p.s >= i.s - {REACH} AND p.e <= i.e + {REACH} AND (p.e <= i.s OR p.s >= i.e)
), whole AS (
    SELECT * FROM near n WHERE EXISTS (SELECT 1 FROM near o
        WHERE o.row = n.row AND o.ik = n.ik AND o.i_s = n.i_s AND o.pk IN (0, 2, 3))
), told AS (
    SELECT row, kind, s, e FROM spans WHERE kind <= 2
    UNION SELECT row, ik, i_s, i_e FROM whole WHERE ik > 2
    UNION SELECT row, pk, p_s, p_e FROM whole WHERE pk > 2
), printed AS (
    SELECT row, kind, s, ['{"', '".join(NAMES)}'][kind + 1] || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT) AS t
    FROM told
)
SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
    count(*) FILTER (kind = 2) AS n_hex,
    sha256(coalesce(string_agg(t, ',' ORDER BY s, kind) FILTER (kind <= 2), '')) AS base_sha256,
    coalesce(string_agg(t, ',' ORDER BY s, kind), '') AS spans
FROM texts LEFT JOIN printed USING (row) GROUP BY texts.row, doc_id
"""
