"""Suffix-array dedup: byte strings that occur twice, by induced sorting of suffixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from vendaflow.llm.anchors import (
    CLASS, MISSING_ID, SPANS_TYPE, Scheme, by_class, classes, merged, occurrences, row_batches, unsettled,
    window_spans, with_texts,
)
from vendaflow.llm.common import column, saved
from vendaflow.llm.simhash import whole_groups
from vendaflow.llm.substrings import SPAN, span_batch

GRAM_BYTES = 40
SHARD_KINDS = 50_000  # suffixes of an anchor that one task sorts, some 20 MB; see `crowded_spans`
TASK_ROWS = 16384
SUFFIX = (
    "gram bigint, doc bigint, tag int, place int, lo int, crowded boolean, times bigint,"
    " front binary, rest binary"
)

# A random value per byte, so that digests of short strings spread over all bits.
_VALUES = np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_codes(text: str) -> np.ndarray:
    return _VALUES[np.frombuffer(text.encode(), dtype=np.uint8)]


def first_prefixes(rest: list[bytes], shard: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with the one before it in its shard, else 0."""
    n, width = len(rest), max(map(len, rest))
    sizes = np.fromiter(map(len, rest), dtype=np.int64, count=n)
    chars = np.zeros((n, width + 1), dtype=np.uint8)
    chars[np.arange(width + 1)[None, :] < sizes[:, None]] = np.frombuffer(b"".join(rest), np.uint8)
    differ = chars[1:] != chars[:-1]
    differ[:, width] = True
    common = np.minimum(differ.argmax(axis=1), np.minimum(sizes[1:], sizes[:-1]))
    return np.concatenate(([0], np.where(shard[1:] == shard[:-1], common, 0)))


def induced_repeats(
    shard: np.ndarray, front: list[bytes], rest: list[bytes], window: int
) -> Iterator[tuple[np.ndarray, int]]:
    """(rows, d): rows whose string of `window` bytes from d bytes before the anchor repeats.

    The rows come in order of shard and of their suffix from the anchor on, `rest`. From the
    sorted suffixes at distance d those at d + 1 are induced: a stable sort by the byte
    before them is their order, and the common prefix of two neighbours is one more than the
    least one between them before, or nothing if that byte differs. A string repeats if its
    suffix has a common prefix of `window` bytes with a neighbour.
    """
    n = len(rest)
    before = np.fromiter(map(len, front), dtype=np.int64, count=n)
    length = np.fromiter(map(len, rest), dtype=np.int64, count=n)
    ends = np.cumsum(before)
    chars = np.frombuffer(b"".join(front), np.uint8)
    order, prefix = np.arange(n), first_prefixes(rest, shard)
    for d in range(int(before.max()) + 1):
        if d:
            deeper = np.flatnonzero(before[order] >= d)  # places in the order at d - 1
            if not len(deeper):
                return
            rows = order[deeper]
            key = shard[rows] * 256 + chars[ends[rows] - d]
            sorting = np.argsort(key, kind="stable")
            place, key = deeper[sorting], key[sorting]
            common = np.zeros(len(place), np.int64)
            same = np.flatnonzero(key[1:] == key[:-1])
            if len(same):
                ranges = np.column_stack((place[same] + 1, place[same + 1] + 1)).ravel()
                least = np.minimum.reduceat(np.append(prefix, 0), ranges)[::2]
                common[same + 1] = least + 1
            order, prefix = order[place], common
        near = np.maximum(prefix, np.append(prefix[1:], 0)) >= window
        found = order[near]
        if len(found):
            yield found[length[found] + d >= window], d


def suffixes(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The bytes of each class, cut at the anchor, from the text of its first occurrence."""

    def run(texts: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        out = []
        for doc, text, tag, own, _ in texts:
            if own:
                raw = text.encode()
                for x in own:
                    place, lo = x["place"], x["place"] - x["r"]
                    out.append(
                        (
                            x["gram"], doc, tag, place, lo, x["crowded"], x["times"],
                            raw[lo:place], raw[place : lo + x["n"]],
                        )
                    )
        if out:
            kinds = [
                pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(),
                pa.binary(), pa.binary(),
            ]
            names = [f.split()[0] for f in SUFFIX.split(", ")]
            yield pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, zip(*out), kinds)})

    return with_texts(docs, rows, run, SUFFIX)


def sorted_spans(cut: DataFrame, window: int) -> DataFrame:
    """Spans of the classes that occur once but share a string of `window` bytes with another.

    The tuples (anchor, suffix from the anchor on) of a shard are put in order by Spark's
    sort, which spills sorted runs to disk and merges them with a priority queue; a task then
    reads them in order and induces the other suffixes, some shards at a time.
    """
    ordered = cut.repartition("gram").sortWithinPartitions("gram", "rest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, ["gram"], TASK_ROWS):
            gram = part["gram"].to_numpy()
            shard = np.concatenate(([0], np.cumsum(gram[1:] != gram[:-1])))
            doc, tag = part["doc"].to_numpy(), part["tag"].to_numpy()
            place, once = part["place"].to_numpy(), part["times"].to_numpy() == 1
            front, rest = part["front"].to_pylist(), part["rest"].to_pylist()
            rows, starts = [], []
            for found, d in induced_repeats(shard, front, rest, window):
                found = found[once[found]]
                rows.append(found)
                starts.append(place[found] - d)
            rows = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            starts = np.concatenate(starts) if starts else rows
            order = np.lexsort((starts, rows))
            rows, starts = rows[order], starts[order]
            cuts = np.flatnonzero(rows[1:] != rows[:-1]) + 1
            out = []
            for own, at in zip(np.split(rows, cuts), np.split(starts, cuts)):
                if len(own):
                    i = own[0]
                    out += [(int(doc[i]), int(tag[i]), a, b) for a, b in window_spans(at, window)]
            yield span_batch(out)

    return ordered.mapInArrow(run, SPAN)


def crowded_spans(cut: DataFrame, window: int) -> DataFrame:
    """The same for anchors with more suffixes than a shard may have.

    Their windows become rows, keyed by a 128-bit digest and counted with a map-side sum.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            names = ("doc", "tag", "lo", "times", "front", "rest")
            for doc, tag, lo, times, front, rest in zip(*[column(batch, c) for c in names]):
                raw = memoryview(front + rest)
                for k in range(len(raw) - window + 1):
                    out.append((doc, tag, lo + k, times, xxhash.xxh3_128_digest(raw[k : k + window])))
            columns = zip(*out) if out else [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            names = ["doc", "tag", "a", "times", "digest"]
            yield pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})

    rows = cut.mapInArrow(run, "doc bigint, tag int, a int, times bigint, digest binary")
    rows = saved(rows, "windows")
    twice = rows.groupBy("digest").agg(F.sum("times").alias("t")).filter("t > 1").select("digest")
    return (
        rows.filter("times = 1")
        .join(saved(twice, "repeated-windows"), "digest", "left_semi")
        .select("doc", "tag", "a", (F.col("a") + window).cast("int").alias("b"))
    )


def repeated_spans(docs: DataFrame, window: int = 200, shard_kinds: int = SHARD_KINDS) -> DataFrame:
    """(doc, tag, a, b): bytes a to b - 1 lie in strings of `window` bytes that occur twice."""
    scheme = Scheme(window, min(GRAM_BYTES, window), byte_codes, "bytes")
    found = occurrences(docs, scheme)
    kinds = classes(found, scheme)
    twice = kinds.filter("times > 1").select(*CLASS)
    whole = by_class(found, twice).select(
        "doc", "tag", F.col("lo").alias("a"), (F.col("lo") + F.col("n")).alias("b")
    )
    few, crowded = unsettled(kinds, scheme, shard_kinds)
    fields = ["doc", "tag", "gram", "place", "n", "r", "times"]
    rows = few.select(*fields, F.lit(False).alias("crowded")).unionByName(
        crowded.select(*fields, F.lit(True).alias("crowded"))
    )
    cut = saved(suffixes(docs, rows), "suffixes")
    return whole.unionByName(sorted_spans(cut.filter("NOT crowded"), window)).unionByName(
        crowded_spans(cut.filter("crowded"), window)
    )


REMOVED = (
    "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<a:int,b:int>>, kept binary"
)


def remove_repeats(docs: DataFrame, window: int = 200) -> DataFrame:
    """REMOVED for every document: the removed byte runs, and the remaining bytes.

    A byte of the UTF-8 text is removed if a string of `window` bytes around it also starts
    anywhere else, in the same or another row. Null texts count as empty. A repeated row is
    a document of its own, so that equal rows remove each other's strings.
    """

    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
            ("spans", SPANS_TYPE), ("kept", pa.binary()),
        ]
    )

    def cleaned(texts: Iterator[tuple]) -> Iterator[tuple]:
        for doc, text, _, own, _ in texts:
            raw = text.encode()
            spans, kept, at = merged(own), [], 0
            for a, b in spans:
                kept.append(raw[at:a])
                at = b
            kept = b"".join([*kept, raw[at:]])
            listed = [{"a": a, "b": b} for a, b in spans]
            doc_id = None if doc == MISSING_ID else doc
            yield len(raw), (doc_id, len(raw), len(raw) - len(kept), listed, kept)

    def run(texts: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        return row_batches(cleaned(texts), schema)

    return with_texts(docs, repeated_spans(docs, window), run, REMOVED)
