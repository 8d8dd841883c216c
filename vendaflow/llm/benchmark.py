"""Benchmark decontamination: containment of short items in long documents."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vendaflow.llm.common import ceil_div, column, text_or_empty, text_tag, without_rows

WORDS = re.compile(r"[^\W_]+")
SHINGLE_WORDS = 5
PART_BYTES = 4 * 1024 * 1024  # item text that one broadcast index holds, some 100 MB as an index

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return WORDS.findall(text_or_empty(text).lower())


def shingle_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """One 64-bit value per run of `length` words, from the words' hashes."""
    n = len(words) - length + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(length):
        h = (h ^ words[k : k + n]) * _FACTOR
        h ^= h >> np.uint64(29)
    return h


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, map(str.encode, words)), dtype=np.uint64, count=len(words))


def needed(size: int, share: Fraction) -> int:
    """Shingles of an item of `size` shingles that a document must have."""
    return -(-size * share.numerator // share.denominator)


@dataclass
class ItemIndex:
    """Items partitioned by size, each with as many minimum hashes as its size asks for.

    A document that holds `needed` of an item's n shingles lacks at most n - needed, so it
    has one of any n - needed + 1, and the item's smallest hashes are a sketch that misses
    no document. The size classes with their sketch lengths are in `sketch_of_size`.
    """

    share: Fraction
    shingles: dict[int, tuple[int, frozenset[tuple[str, ...]]]]  # item -> its length, shingles
    sketch_of_size: dict[int, int]
    probes: dict[int, tuple[np.ndarray, np.ndarray]]  # shingle length -> hashes, items

    @classmethod
    def build(cls, items: list[tuple[int, str]], share: Fraction) -> ItemIndex:
        shingles, sketches, entries = {}, {}, defaultdict(list)
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            length = min(SHINGLE_WORDS, len(words))
            runs = zip(*[words[k:] for k in range(length)])
            own = frozenset(runs)
            shingles[item] = (length, own)
            hashes = np.unique(shingle_hashes(word_hashes(words), length))
            size = len(own)
            sketches[size] = size - needed(size, share) + 1
            # Two shingles of one hash only make the sketch weaker if it is not the whole.
            entries[length] += [(h, item) for h in hashes[: sketches[size]].tolist()]
        probes = {}
        for length, found in entries.items():
            found.sort()
            probes[length] = (
                np.array([h for h, _ in found], dtype=np.uint64),
                np.array([i for _, i in found], dtype=np.int64),
            )
        return cls(share, shingles, sketches, probes)

    def search(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item, shingles found, shingles of the item) of the items the text contains."""
        words = words_of(text)
        if not words:
            return []
        hashes, candidates = word_hashes(words), set()
        for length, (keys, items) in self.probes.items():
            own = shingle_hashes(hashes, length)
            at = np.searchsorted(keys, own)
            at[at == len(keys)] = 0
            for h in np.unique(own[keys[at] == own]):
                a, b = np.searchsorted(keys, h), np.searchsorted(keys, h, side="right")
                candidates.update(items[a:b].tolist())
        found, runs = [], {}
        for item in sorted(candidates):
            length, shingles = self.shingles[item]
            if length not in runs:
                runs[length] = set(zip(*[words[k:] for k in range(length)]))
            hits = len(shingles & runs[length])
            if hits >= needed(len(shingles), self.share):
                found.append((item, hits, len(shingles)))
        return found


def contained(docs: DataFrame, items: DataFrame, share: Fraction = Fraction(4, 5)) -> DataFrame:
    """(doc_id, item_id, n_found, n_shingles, containment): documents that hold an item.

    An item is held if at least `share` of its distinct shingles of five words (of all its
    words if it has fewer) occur in the document. Null and word-free texts hold nothing and
    are held by nothing; a null item_id is left out. Rows with the same item_id and other
    texts are searched apart, and the best containment counts. The items are broadcast in
    parts of at most PART_BYTES of text; each part is one pass over the documents.
    """
    return (
        held(docs, items, share)
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct(F.col("n_found") / F.col("n_shingles"), "n_found", "n_shingles")).alias("m"))
        .select("doc_id", "item_id", "m.n_found", "m.n_shingles")
        .withColumn("containment", F.col("n_found") / F.col("n_shingles"))
    )


def held(docs: DataFrame, items: DataFrame, share: Fraction) -> DataFrame:
    """(doc_id, tag, item_id, n_found, n_shingles) of each row and each text of an item it holds."""
    items = (
        items.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
        .filter("item_id IS NOT NULL AND text IS NOT NULL")
        .distinct()
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, ceil_div(size, PART_BYTES))
    found = None
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        # Numbered, since an item_id may come with several texts.
        numbered = [(i, r["text"]) for i, r in enumerate(rows)]
        ids = [r["item_id"] for r in rows]
        one = _search(docs, ItemIndex.build(numbered, share), ids)
        found = one if found is None else found.unionByName(one)
    return found


def _search(docs: DataFrame, index: ItemIndex, ids: list[int]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((index, ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, ids = shared.value
        for batch in batches:
            rows = [
                (doc, tag, ids[item], hits, size)
                for doc, tag, text in zip(*[column(batch, n) for n in ("doc_id", "tag", "text")])
                for item, hits, size in index.search(text)
            ]
            columns = zip(*rows) if rows else [[]] * 5
            names = ["doc_id", "tag", "item_id", "n_found", "n_shingles"]
            yield pa.record_batch({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    return docs.select(
        F.col("doc_id").cast("bigint"), "text", text_tag().alias("tag")
    ).mapInArrow(
        run, "doc_id bigint, tag bigint, item_id bigint, n_found bigint, n_shingles bigint"
    )


def without_items(docs: DataFrame, items: DataFrame, spare_nameless: bool = True) -> DataFrame:
    """The documents that hold no benchmark item, told apart by doc_id and text.

    Rows with a null doc_id stay, unless `spare_nameless` is false.
    """
    gone = held(docs, items, Fraction(4, 5))
    if spare_nameless:
        gone = gone.filter("doc_id IS NOT NULL")
    return without_rows(docs, gone).select(*[f"`{c}`" for c in docs.columns])


CONTAINED_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark
), held AS (
    SELECT DISTINCT item_id, length AS n, s
    FROM (
        SELECT item_id, least(5, len(w)) AS length,
            unnest(list_transform(range(1, len(w) - least(5, len(w)) + 2),
                lambda i: array_to_string(w[i : i + least(5, len(w)) - 1], ' '))) AS s
        FROM items WHERE len(w) > 0
    )
), sizes AS (
    SELECT item_id, count(*) AS n_shingles FROM held GROUP BY item_id
), lengths AS (
    SELECT DISTINCT n FROM held
), runs AS (
    SELECT DISTINCT doc_id, n, s
    FROM (
        SELECT doc_id, n,
            unnest(list_transform(range(1, len(w) - n + 2),
                lambda i: array_to_string(w[i : i + n - 1], ' '))) AS s
        FROM words, lengths WHERE len(w) >= n
    )
)
SELECT doc_id, item_id, count(*) AS n_found, any_value(n_shingles) AS n_shingles,
    count(*) / any_value(n_shingles) AS containment
FROM runs JOIN held USING (n, s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) * 5 >= any_value(n_shingles) * 4
"""
