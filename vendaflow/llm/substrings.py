"""Substring dedup: word passages that occur earlier, found with suffix automata."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vendaflow.llm.anchors import (
    CLASS, MISSING_ID, SPANS_TYPE, Scheme, by_class, classes, merged, occurrences, row_batches, unsettled,
    window_spans, with_texts,
)
from vendaflow.llm.common import column, saved
from vendaflow.llm.simhash import group_starts, whole_groups

WORD = re.compile(r"[^\x20\x09-\x0D]+")
GRAM_WORDS = 4
SHARD_KINDS = 1000  # passages that one automaton takes; see `crowded_spans`
PASSAGE = "gram bigint, doc bigint, place int, tag int, lo int, crowded boolean, passage string"
SPAN = "doc bigint, tag int, a int, b int"


def word_codes(text: str) -> np.ndarray:
    words = text.encode().split()  # at space, tab, line feed, VT, form feed, carriage return
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


class SuffixAutomaton:
    """All substrings of the word sequences added so far."""

    def __init__(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, edges: dict[str, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, word: str) -> int:
        """The state p reaches by `word`, split if it also stands for longer strings."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[str]) -> None:
        last = 0
        for word in words:
            if word in self.next[last]:
                last = self._split(last, word)
                continue
            new = self._state(self.length[last] + 1, {}, 0)
            p = last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, word)
            last = new

    def matching(self, words: list[str]) -> Iterator[int]:
        """Matching statistics: the longest match that ends with each word."""
        state = matched = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                matched += 1
            yield matched


def repeated_windows(passages: list[tuple[tuple, list[str]]], window: int) -> Iterator[tuple[int, np.ndarray]]:
    """(index, window starts) of what each passage repeats of those with a smaller key.

    The passages are streamed in order of their keys: first matched against the automaton of
    all before, then added to it. Passages with equal keys do not see each other.
    """
    automaton, waiting, key = SuffixAutomaton(), [], None
    for index, (own, words) in enumerate(passages):
        if own != key:
            for one in waiting:
                automaton.add(one)
            waiting, key = [], own
        waiting.append(words)
        starts = [e - window + 1 for e, n in enumerate(automaton.matching(words)) if n >= window]
        if starts:
            yield index, np.array(starts)


def passages(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The words of each class's first occurrence, cut from its text."""

    def run(texts: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        out = []
        for doc, text, tag, own, _ in texts:
            if own:
                words = text.encode().split()
                for x in own:
                    lo = x["place"] - x["r"]
                    cut = b" ".join(words[lo : lo + x["n"]]).decode()
                    out.append((x["gram"], doc, x["place"], tag, lo, x["crowded"], cut))
        if out:
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.string()]
            names = [f.split()[0] for f in PASSAGE.split(", ")]
            yield pa.record_batch(
                {n: pa.array(c, k) for n, c, k in zip(names, zip(*out), kinds)}
            )

    return with_texts(docs, rows, run, PASSAGE)


def automaton_spans(cut: DataFrame, window: int) -> DataFrame:
    """Spans of passages that an earlier passage with the same anchor has, too.

    Every anchor is a shard: its passages, which share the anchor, go to one task, where
    their automaton is built. The number of passages of a shard is bounded by the caller.
    """
    order = ["gram", "doc", "place", "tag"]
    ordered = cut.repartition("gram").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, ["gram"], 1):
            doc, tag, place, lo = (part[c].to_pylist() for c in ("doc", "tag", "place", "lo"))
            words = [p.split(" ") for p in part["passage"].to_pylist()]
            starts, out = group_starts(part, ["gram"]), []
            for s, e in zip(starts, [*starts[1:], part.num_rows]):
                shard = [((doc[i], place[i]), words[i]) for i in range(s, e)]
                for i, found in repeated_windows(shard, window):
                    for a, b in window_spans(found + lo[s + i], window):
                        out.append((doc[s + i], tag[s + i], a, b))
            yield span_batch(out)

    return ordered.mapInArrow(run, SPAN)


def crowded_spans(cut: DataFrame, window: int) -> DataFrame:
    """The same for anchors with more passages than a shard may have.

    Their windows become rows, keyed by a 128-bit digest; the earliest of each digest is
    found with a map-side minimum, and all later ones are spans.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            names = ("doc", "tag", "lo", "passage")
            for doc, tag, lo, passage in zip(*[column(batch, c) for c in names]):
                words = passage.split(" ")
                for k in range(len(words) - window + 1):
                    digest = xxhash.xxh3_128_digest(" ".join(words[k : k + window]))
                    out.append((doc, tag, lo + k, digest))
            columns = zip(*out) if out else [[]] * 4
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            names = ["doc", "tag", "a", "digest"]
            yield pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})

    rows = saved(cut.mapInArrow(run, "doc bigint, tag int, a int, digest binary"), "windows")
    first = rows.groupBy("digest").agg(F.min(F.struct("doc", "a")).alias("m"), F.count("*").alias("c"))
    first = saved(first.filter("c > 1").select("digest", "m.doc", "m.a"), "first-windows")
    first = first.withColumnsRenamed({"doc": "first_doc", "a": "first_a"})
    return (
        rows.join(first, "digest")
        .filter((F.col("doc") != F.col("first_doc")) | (F.col("a") != F.col("first_a")))
        .select("doc", "tag", "a", (F.col("a") + window).cast("int").alias("b"))
    )


def span_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * 4
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    return pa.record_batch({n: pa.array(c, k) for n, c, k in zip(("doc", "tag", "a", "b"), columns, kinds)})


def repeated_spans(docs: DataFrame, window: int = 20, shard_kinds: int = SHARD_KINDS) -> DataFrame:
    """(doc, tag, a, b): words a to b - 1 lie in windows that occur earlier.

    A passage that occurs again word by word is removed but for its first occurrence without
    a closer look. First occurrences are compared, in shards, where an anchor has several.
    """
    scheme = Scheme(window, min(GRAM_WORDS, window), word_codes, "words")
    found = occurrences(docs, scheme)
    kinds = classes(found, scheme)
    firsts = kinds.filter("times > 1").select(
        *CLASS, F.col("doc").alias("first_doc"), F.col("place").alias("first_place")
    )
    again = (
        by_class(found, firsts)
        .filter((F.col("doc") != F.col("first_doc")) | (F.col("lo") + F.col("r") != F.col("first_place")))
        .select("doc", "tag", F.col("lo").alias("a"), (F.col("lo") + F.col("n")).alias("b"))
    )
    few, crowded = unsettled(kinds, scheme, shard_kinds)
    fields = ["doc", "tag", "gram", "place", "n", "r"]
    rows = few.select(*fields, F.lit(False).alias("crowded")).unionByName(
        crowded.select(*fields, F.lit(True).alias("crowded"))
    )
    cut = saved(passages(docs, rows), "passages")
    return again.unionByName(automaton_spans(cut.filter("NOT crowded"), window)).unionByName(
        crowded_spans(cut.filter("crowded"), window)
    )


REMOVED = "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<a:int,b:int>>, kept string"


def remove_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """REMOVED for every document: the removed word spans, and the kept words joined by spaces.

    A word is removed if a window of `window` words around it also starts earlier: in a
    document with a smaller doc_id, or earlier in the same one. Null texts have no words; a
    null doc_id comes before all others. Rows with the same doc_id count as the same place, so
    that a repeated row stays as it is.
    """

    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
            ("spans", SPANS_TYPE), ("kept", pa.string()),
        ]
    )

    def cleaned(texts: Iterator[tuple]) -> Iterator[tuple]:
        for doc, text, _, own, _ in texts:
            words = text.encode().split()
            spans, kept, at = merged(own), [], 0
            for a, b in spans:
                kept += words[at:a]
                at = b
            kept += words[at:]
            listed = [{"a": a, "b": b} for a, b in spans]
            doc_id = None if doc == MISSING_ID else doc
            joined = b" ".join(kept).decode()
            yield len(text), (doc_id, len(words), len(words) - len(kept), listed, joined)

    def run(texts: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        return row_batches(cleaned(texts), schema)

    return with_texts(docs, repeated_spans(docs, window), run, REMOVED)


def without_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """The documents with repeated passages cut from their texts, which are else unchanged.

    n_chars, if it is there as a whole number, becomes the length of a text that was cut. Null
    texts stay null.
    """
    names = docs.columns
    kept = [n for n in names if n != "text"]
    counted = "n_chars" in names and isinstance(docs.schema["n_chars"].dataType, T.IntegralType)

    def cleaned(texts: Iterator[tuple]) -> Iterator[tuple]:
        for _, text, _, own, others in texts:
            size = len(text)
            if own:
                at = [m.span() for m in WORD.finditer(text)]
                parts, end = [], 0
                for a, b in merged(own):
                    parts.append(text[end : at[a][0]])
                    end = at[b][0] if b < len(at) else len(text)
                text = "".join([*parts, text[end:]])
            row = dict(zip(kept, [others[f"c{i}"] for i in range(len(kept))]))
            if own and row.get("n_chars") is not None and counted:
                row["n_chars"] = len(text)
            row["text"] = None if others["no_text"] else text
            yield size, tuple(row[n] for n in names)

    schema = to_arrow_schema(docs.schema)

    def run(texts: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        return row_batches(cleaned(texts), schema)

    return with_texts(docs, repeated_spans(docs, window), run, docs.schema, tuple(kept))


REMOVED_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words)
), firsts AS (
    SELECT s, min({'d': doc_id, 'i': i}) AS m FROM windows GROUP BY s HAVING count(*) > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i
    FROM windows JOIN firsts USING (s) WHERE m <> {'d': doc_id, 'i': i}
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words)
    ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""
