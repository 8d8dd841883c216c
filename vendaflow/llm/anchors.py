"""Finding repeated windows: locally chosen anchors bring equal windows together.

A window is a run of W consecutive tokens of a text (bytes or words). Of the grams of k
tokens in a window the one with the smallest hash is its anchor, so that equal windows have
equal anchors at equal places. Consecutive windows with one anchor form a piece. An anchor
whose gram occurs once in all texts belongs to windows that occur once; the others are
resolved by the operators that use this module.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from vendaflow.llm.common import column, saved
from vendaflow.operators.joins import hot_keys, spread_join

TOKENS = 1 << 17  # tokens looked at together
_PLACE = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
MISSING_ID = -(1 << 63)  # stands for a null doc_id in keys

OCCURRENCE = "doc bigint, tag int, gram bigint, digest bigint, lo int, n int, r int"
CLASS = ["gram", "digest", "n", "r"]


@dataclass(frozen=True)
class Scheme:
    """What a token is, and the lengths of windows and grams in tokens."""

    window: int
    gram: int
    codes: Callable[[str], np.ndarray]  # a 64-bit value per token
    label: str


def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = TOKENS + (1 << 12)
    forward = np.full(n, np.uint64(_BASE))
    back = np.full(n, np.uint64(pow(_BASE, -1, 1 << 64)))
    forward[0] = back[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(forward, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)


_FORWARD, _BACK = _powers()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(32)
    return h


def find_anchors(codes: np.ndarray, starts: np.ndarray, window: int, gram: int) -> tuple:
    """(text, lo, hi, place, gram hash, digest) of the pieces of several texts in a row.

    starts: where each text starts in `codes`, and the end. lo to hi are the first tokens of
    a piece's windows, place is the anchor; the digest covers all tokens of the piece.
    """
    n = len(codes)
    if n < window:
        return (np.zeros(0, np.int64),) * 6
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * _FORWARD[:n], out=sums[1:])
    grams = _mixed((sums[gram:] - sums[:-gram]) * _BACK[: n - gram + 1])
    # The place breaks ties: the leftmost of equal grams.
    keys = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    w = window - gram + 1
    m = len(keys) - w + 1
    blocks = np.full(-(-len(keys) // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    blocks[: len(keys)] = keys
    blocks = blocks.reshape(-1, w)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    place = (np.minimum(after[:m], before[w - 1 : w - 1 + m]) & _PLACE).astype(np.int64)
    # Windows that would reach into the next text are none.
    change = np.zeros(m + 1, np.int64)
    for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
        a, b = max(s, e - window + 1), min(e, m)
        if a < b:
            change[a] += 1
            change[b] -= 1
    place[np.cumsum(change[:-1]) > 0] = -1
    run = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
    ends = np.append(run[1:], m) - 1
    kept = place[run] >= 0
    lo, hi, place = run[kept], ends[kept], place[run[kept]]
    digest = _mixed((sums[hi + window] - sums[lo]) * _BACK[lo])
    text = np.searchsorted(starts, lo, side="right") - 1
    first = starts[text]
    return text, lo - first, hi - first, place - first, grams[place], digest


def pieces_of(texts: Iterator[tuple], scheme: Scheme) -> Iterator[tuple]:
    """(keys, columns) for texts given as (key, text): long ones in overlapping stretches."""
    keys, parts, offsets, size = [], [], [], 0

    def found() -> tuple:
        starts = np.cumsum([0] + [len(p) for p in parts])
        text, lo, hi, place, gram, digest = find_anchors(
            np.concatenate(parts), starts, scheme.window, scheme.gram
        )
        shift = np.array(offsets, np.int64)[text]
        return [keys[t] for t in text.tolist()], (lo + shift, hi + shift, place + shift, gram, digest)

    for key, text in texts:
        codes = scheme.codes(text)
        at = 0
        while len(codes) - at >= scheme.window:
            part = codes[at : at + TOKENS]
            if size + len(part) > TOKENS and parts:
                yield found()
                keys, parts, offsets, size = [], [], [], 0
            keys.append(key)
            parts.append(part)
            offsets.append(at)
            size += len(part)
            if at + len(part) == len(codes):
                break
            at += len(part) - scheme.window + 1
    if parts:
        yield found()


def keyed(docs: DataFrame, *others: str) -> DataFrame:
    """(doc, tag, text, others): rows are told apart by doc_id and a hash of the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        doc_key(),
        F.hash(text).alias("tag"),
        text.alias("text"),
        F.struct(
            F.col("text").isNull().alias("no_text"),
            *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)],
        ).alias("others"),
    )


def doc_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(MISSING_ID)).alias("doc")


def occurrences(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """All pieces whose anchor occurs more than once: OCCURRENCE, saved.

    lo: the first token, n: tokens, r: tokens before the anchor. The anchors are found twice,
    once for the count per gram, which is summed in the map tasks, and once for the join.
    """

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ((None, t) for t in column(batch, "text") if t)
            for _, found in pieces_of(rows, scheme):
                yield pa.record_batch({"gram": pa.array(found[3].view(np.int64))})

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[column(batch, c) for c in ("doc", "tag", "text")])
            for keys, (lo, hi, place, gram, digest) in pieces_of((((d, g), t) for d, g, t in rows), scheme):
                yield pa.record_batch(
                    {
                        "doc": pa.array([k[0] for k in keys], pa.int64()),
                        "tag": pa.array([k[1] for k in keys], pa.int32()),
                        "gram": pa.array(gram.view(np.int64)),
                        "digest": pa.array(digest.view(np.int64)),
                        "lo": pa.array(lo.astype(np.int32)),
                        "n": pa.array((hi - lo + scheme.window).astype(np.int32)),
                        "r": pa.array((place - lo).astype(np.int32)),
                    }
                )

    repeated = (
        docs.select("text")
        .mapInArrow(grams, "gram bigint")
        .groupBy("gram")
        .agg(F.count("*").alias("times"))
        .filter("times > 1")
        .select("gram")
    )
    repeated = saved(repeated, f"{scheme.label}-grams")
    found = keyed(docs).mapInArrow(full, OCCURRENCE)
    return saved(found.join(repeated, "gram", "left_semi"), f"{scheme.label}-occurrences")


def classes(found: DataFrame, scheme: Scheme) -> DataFrame:
    """Equal pieces as one row: how often they occur, and where first; saved."""
    place = F.struct("doc", (F.col("lo") + F.col("r")).alias("place"), "tag")
    grouped = found.groupBy(*CLASS).agg(F.count("*").alias("times"), F.min(place).alias("first"))
    return saved(
        grouped.select(*CLASS, "times", "first.doc", "first.place", "first.tag"),
        f"{scheme.label}-classes",
    )


def by_class(found: DataFrame, kinds: DataFrame) -> DataFrame:
    """`found` with the columns of its class, without pieces of other classes.

    A class may hold a large part of all pieces; such ones are found with a sketch, and their
    pieces dealt to many tasks.
    """
    named = kinds.withColumnsRenamed({c: f"class_{c}" for c in CLASS})
    (common,) = hot_keys(found, CLASS)
    pairs = [(c, f"class_{c}") for c in CLASS]
    joined = spread_join(found, named, pairs, "inner", common, ["doc", "tag", "lo"])
    return joined.drop(*[c for _, c in pairs])


def unsettled(kinds: DataFrame, scheme: Scheme, most: int) -> tuple[DataFrame, DataFrame]:
    """Classes whose anchor has other classes, too: those of anchors with at most `most`
    classes, and the rest."""
    counts = kinds.groupBy("gram").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    open_ones = kinds.join(saved(counts, f"{scheme.label}-counts"), "gram")
    return open_ones.filter(F.col("kinds") <= most), open_ones.filter(F.col("kinds") > most)


def with_texts(
    docs: DataFrame, rows: DataFrame, run: Callable, schema: str | T.StructType, others: tuple = ()
) -> DataFrame:
    """`run` over an iterator of (doc, text, tag, rows, others): each text with its own rows.

    `rows` are a text's rows as a list of dicts, or None; `others` a dict: no_text, if the
    text is null, and c0, c1, ..., the other columns asked for. Texts are shuffled compressed.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed = [press.compress(t.encode()) for t in column(batch, "text")]
            columns = dict(zip(batch.schema.names, batch.columns))
            columns.pop("text")
            yield pa.record_batch(columns | {"packed": pa.array(packed, pa.binary())})

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            names = ("doc", "packed", "tag", "rows", "others")
            yield from run(
                (doc, press.decompress(packed).decode(), tag, own, more)
                for doc, packed, tag, own, more in zip(*[column(batch, c) for c in names])
            )

    fields = [c for c in rows.columns if c not in ("doc", "tag")]
    # A set: rows with equal doc and text share one list, which is no longer for their number.
    lists = rows.groupBy("doc", "tag").agg(F.collect_set(F.struct(*fields)).alias("rows"))
    texts = keyed(docs, *others).select("doc", "tag", "others", "text")
    packed_schema = T.StructType([*texts.schema.fields[:3], T.StructField("packed", T.BinaryType())])
    packed = texts.mapInArrow(pack, packed_schema)
    return packed.join(lists, ["doc", "tag"], "left").mapInArrow(unpack, schema)


def row_batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """(size, row) pairs as batches of about `most` bytes or 1000 rows."""
    held, size = [], 0
    for one, row in rows:
        held.append(row)
        size += one
        if size >= most or len(held) >= 1000:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


SPANS_TYPE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Overlapping and touching spans (a, b) joined, in order."""
    out: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def window_spans(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """The tokens covered by windows that start at the given places, ascending."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > window) + 1
    firsts = starts[np.concatenate(([0], cut))]
    lasts = starts[np.concatenate((cut - 1, [len(starts) - 1]))]
    return [(int(a), int(b) + window) for a, b in zip(firsts, lasts)]
