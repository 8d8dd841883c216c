"""SimHash near-dedup: fingerprints joined by a walk over pairs of binary-trie nodes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from vendaflow.llm.common import (
    Links, column, components, pair_tasks, saved, text_or_empty, text_tag, without_rows,
)

BITS = 64
CELL_ROWS = 4096  # fingerprints of a cell that one task takes; larger cells are cut
TASK_ROWS = 32768  # rows that are walked at once
SMALL_PAIR = 64  # node pairs of so few fingerprint pairs are compared directly
WALK_PAIRS = 1 << 18  # node pairs held at once on a level of the walk

# _BIT_OF[byte, i]: bit i of the byte, the highest first.
_BIT_OF = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, words_per_shingle: int = 4, seed: int = 42) -> int:
    """Majority bits of the XXH64 hashes of all shingles, repeats included; zero without words."""
    words = text_or_empty(text).encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - words_per_shingle + 1)
    last = ends[min(words_per_shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), last.tolist())),
        dtype=">u8",
        count=n,
    )
    columns = hashes.view(np.uint8).reshape(n, 8)
    counts = np.concatenate(
        [np.bincount(columns[:, i], minlength=256) @ _BIT_OF for i in range(8)]
    )
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words_per_shingle: int = 4) -> DataFrame:
    """(doc_id, tag, fp): one 64-bit fingerprint per document, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, words_per_shingle) for t in column(batch, "text")]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "tag": batch.column("tag"),
                    "fp": pa.array(np.array(found, dtype=np.uint64).view(np.int64)),
                }
            )

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", text_tag().alias("tag")
    ).mapInArrow(run, "doc_id bigint, tag bigint, fp bigint")


def blocks(max_bits: int) -> list[tuple[int, int]]:
    """(offset, width) of max_bits + 1 blocks: of two near fingerprints one block is equal."""
    n = max_bits + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(cuts[i], cuts[i + 1] - cuts[i]) for i in range(n)]


def walk(
    keys: np.ndarray, roots: list[tuple[int, int, int, int, int]], budget: int, links: Links
) -> None:
    """Link all rows of the root pairs whose keys differ in at most `budget` bits.

    keys: 64-bit keys, ascending within each root node, whose rows share their first `level`
    bits. A root pair is (a, b, c, d, level): the nodes [a, b) and [c, d), maybe the same.
    Both nodes of a pair are split at the next bit, the four child pairs carry the number of
    bits in which their prefixes differ, and a pair is dropped beyond the budget, if a node
    is empty, or if all its rows are linked already. Smaller budgets go first, which links
    dense groups before their pairs have to be looked at.
    """
    start = min(r[4] for r in roots)
    ones = {}
    for level in range(start, BITS):
        bit = (keys >> np.uint64(BITS - 1 - level)) & np.uint64(1)
        ones[level] = np.concatenate(([0], np.cumsum(bit, dtype=np.int64)))
    first = np.array(roots, dtype=np.int64).reshape(-1, 5)
    for most in sorted({min(1, budget), min(2, budget), budget}):
        stack = [
            (int(level), np.column_stack((group[:, :4], np.zeros(len(group), np.int64))))
            for level in np.unique(first[:, 4])
            for group in (first[first[:, 4] == level],)
        ]
        same_until = _same_until(links.label)
        while stack:
            level, pairs = stack.pop()
            if len(pairs) > WALK_PAIRS:
                half = len(pairs) // 2
                stack += [(level, pairs[half:]), (level, pairs[:half])]
                continue
            a, b, c, d, err = pairs.T
            linked = (
                (same_until[a] >= b) & (same_until[c] >= d) & (links.label[a] == links.label[c])
            )
            pairs = pairs[~linked]
            a, b, c, d, err = pairs.T
            direct = ((b - a) * (d - c) <= SMALL_PAIR) | (level == BITS)
            if direct.any():
                _compare(keys, pairs[direct], most, links)
                same_until = _same_until(links.label)
                a, b, c, d, err = pairs[~direct].T
            if not len(a):
                continue
            m, n = b - (ones[level][b] - ones[level][a]), d - (ones[level][d] - ones[level][c])
            same = a == c
            children = np.concatenate(
                [
                    np.column_stack((a, m, c, n, err)),
                    np.column_stack((m, b, n, d, err)),
                    np.column_stack((a, m, n, d, err + 1)),
                    np.column_stack((m, b, c, n, err + 1))[~same],
                ]
            )
            keep = (
                (children[:, 4] <= most)
                & (children[:, 0] < children[:, 1])
                & (children[:, 2] < children[:, 3])
            )
            if keep.any():
                stack.append((level + 1, children[keep]))


def _same_until(label: np.ndarray) -> np.ndarray:
    """For each row, the first later row with another label."""
    n = len(label)
    change = np.append(np.flatnonzero(label[1:] != label[:-1]) + 1, n)
    return change[np.searchsorted(change, np.arange(n), side="right")]


def _compare(keys: np.ndarray, pairs: np.ndarray, most: int, links: Links) -> None:
    for part in np.array_split(pairs, max(1, len(pairs) * SMALL_PAIR // (1 << 22))):
        a, b, c, d, _ = part.T
        sizes = (b - a) * (d - c)
        which = np.repeat(np.arange(len(part)), sizes)
        k = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        x, y = a[which] + k // (d - c)[which], c[which] + k % (d - c)[which]
        near = np.bitwise_count(keys[x] ^ keys[y]) <= most
        links.add(x[near], y[near])


def near_links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """(a, b): links that connect all nodes within `max_bits`, without listing all pairs.

    `fps` has distinct (node, fp). A row goes to one cell per block of bits; cells hold
    equal blocks, so that every near pair shares one. Each task walks the trie pairs of its
    cells and returns a spanning forest.
    """
    placed = blocks(max_bits)
    turned = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("block"),
                    F.shiftrightunsigned("fp", BITS - o - w).bitwiseAND((1 << w) - 1).alias("cell"),
                    (
                        F.shiftleft("fp", o).bitwiseOR(F.shiftrightunsigned("fp", BITS - o))
                        if o
                        else F.col("fp")
                    ).alias("key"),
                )
                for i, (o, w) in enumerate(placed)
            ]
        )
    )
    rows = fps.select("node", turned.alias("t")).select("node", "t.*")
    dealt = pair_tasks(rows, ["block", "cell"], "node", CELL_ROWS)
    keys = ["block", "cell", "_i", "_j"]
    # Unsigned order, so that the walk can split nodes by their bits.
    unsigned = F.col("key").bitwiseXOR(F.lit(-(1 << 63)))
    order = [*keys, "_side", unsigned]
    ordered = dealt.repartition(*keys).sortWithinPartitions(*order)
    widths = [w for _, w in placed]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, keys, TASK_ROWS):
            node = part["node"].to_numpy()
            key = part["key"].to_numpy().view(np.uint64)
            block = part["block"].to_numpy()
            side = part["_side"].to_numpy()
            # A task of two pieces has a run of rows of each side.
            task_cuts = group_starts(part, keys)
            links = Links(len(node))
            roots = []
            for s, e in zip(task_cuts, [*task_cuts[1:], len(node)]):
                m = s + int(np.searchsorted(side[s:e], 1))
                level = widths[block[s]]
                if part["_i"][s].as_py() == part["_j"][s].as_py():
                    if e - s > 1:
                        roots.append((s, e, s, e, level))
                elif s < m < e:
                    roots.append((s, m, m, e, level))
            if roots:
                walk(key, roots, max_bits, links)
            joined = np.flatnonzero(links.label != np.arange(len(node)))
            yield pa.record_batch(
                {"a": pa.array(node[joined]), "b": pa.array(node[links.label[joined]])}
            )

    return ordered.mapInArrow(run, "a bigint, b bigint")


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], rows: int
) -> Iterator[pa.Table]:
    """Sorted batches gathered into tables of at least `rows` rows that end with a group."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            full = pa.Table.from_batches(held).combine_chunks()
            cut = group_starts(full, keys)[-1]
            if cut:
                yield full.slice(0, cut).combine_chunks()
                held = full.slice(cut).to_batches()
                size = full.num_rows - cut
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


def group_starts(part: pa.Table, keys: list[str]) -> list[int]:
    changed = np.zeros(max(0, part.num_rows - 1), dtype=bool)
    for k in keys:
        values = part[k].to_numpy()
        changed |= values[1:] != values[:-1]
    return [0, *(np.flatnonzero(changed) + 1).tolist()]


def grouped(docs: DataFrame, words_per_shingle: int, max_bits: int) -> DataFrame:
    """(doc_id, tag, fp, chosen): `chosen` is the first row (no_id, doc_id, tag) of the group."""
    prints = saved(fingerprints(docs, words_per_shingle), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tag")
    nodes = prints.groupBy("fp").agg(F.min(row).alias("first"))
    nodes = saved(nodes.select(F.col("fp").alias("node"), "fp", "first"), "distinct-fingerprints")
    links = saved(near_links(nodes.select("node", "fp"), max_bits), "simhash-links")
    groups = components(links).join(nodes.select("node", "first"), "node")
    names = groups.groupBy("component").agg(F.min("first").alias("chosen"))
    groups = groups.join(names, "component").select("node", "chosen")
    named = nodes.join(groups, "node", "left").select(
        "fp", F.coalesce("chosen", "first").alias("chosen")
    )
    return prints.join(named, "fp").select("doc_id", "tag", "fp", "chosen")


def near_groups(docs: DataFrame, words_per_shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, fp, component_id): groups of documents linked by near fingerprints.

    Null and word-free texts have fingerprint zero and are linked like any other. Documents
    with equal fingerprints count as one node, so that copies are never paired. A group is
    named by its smallest doc_id, or by null if none of its rows has one.
    """
    found = grouped(docs, words_per_shingle, max_bits)
    return found.select("doc_id", "fp", F.col("chosen.doc_id").alias("component_id"))


def near_dedup(docs: DataFrame, words_per_shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The documents without those that are not the first of their group.

    The first has the smallest doc_id; rows without one come last. Of rows with the same doc_id
    and text, as of a repeated row, all stay or go together; without a doc_id, one stays.
    """
    found = grouped(docs, words_per_shingle, max_bits)
    chosen = F.col("doc_id").eqNullSafe(F.col("chosen.doc_id")) & (
        F.col("tag") == F.col("chosen.tag")
    )
    found = saved(found.select("doc_id", "tag", chosen.alias("stays")), "simhash-chosen")
    kept = without_rows(docs, found.filter("NOT stays"))
    if not found.filter("doc_id IS NULL AND stays").isEmpty():
        nameless = kept.filter("doc_id IS NULL").withColumn("_tag", text_tag())
        kept = kept.filter("doc_id IS NOT NULL").unionByName(
            nameless.dropDuplicates(["_tag"]).drop("_tag")
        )
    return kept.select(*[f"`{c}`" for c in docs.columns])
