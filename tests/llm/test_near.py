from __future__ import annotations

import math
import random

import numpy as np
from brute import Sets, near_vectors, simhash_groups
from data_llm import frame

from vendaflow.llm import simhash, vectors
from vendaflow.llm.common import Links, components

VECTORS = "vec_id bigint, embedding array<float>, label int, node bigint, cell string"


def near_copies(seed: int, groups: int, size: int) -> list[tuple[int, str]]:
    pick = random.Random(seed)
    docs = []
    for _ in range(groups):
        words = [f"w{pick.randint(0, 400)}" for _ in range(120)]
        for _ in range(size):
            copy = list(words)
            for _ in range(pick.randint(0, 2)):
                copy[pick.randrange(len(copy))] = "changed"
            docs.append(" ".join(copy))
    docs += ["", "   ", "one two three", "One TWO three", None, "ÄÖ ä", "long " * 5000, docs[0]]
    return list(enumerate(docs))


def grouped(df):
    found = simhash.near_groups(df)
    return {(r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in found.collect()}


def test_simhash_groups(spark):
    docs = near_copies(3, 6, 8)
    assert grouped(frame(spark, docs, clashing=True).repartition(3)) == simhash_groups(docs)


def test_simhash_cells_are_cut(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL_ROWS", 4)
    docs = near_copies(4, 3, 14)
    assert grouped(frame(spark, docs)) == simhash_groups(docs)


def test_simhash_keeps_one_of_a_group(spark):
    docs = near_copies(5, 4, 5)
    first = {c for _, _, c in simhash_groups(docs)}
    df = frame(spark, [*docs, docs[0], (None, "no id")], clashing=True)
    kept = simhash.near_dedup(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [*first, 0, None]))


def test_simhash_empty_table(spark):
    assert grouped(frame(spark, [])) == set()
    assert simhash.near_dedup(frame(spark, [])).count() == 0


def test_trie_walk_finds_all_links():
    pick = np.random.default_rng(1)
    for bits in (0, 1, 4):
        centres = pick.integers(0, 1 << 63, 12, dtype=np.uint64)
        keys = []
        for c in centres:
            for _ in range(25):
                flips = pick.integers(0, 64, pick.integers(0, 5))
                keys.append(int(c) ^ sum(1 << int(f) for f in set(flips.tolist())))
        keys = np.unique(np.array(keys, np.uint64))
        found, wanted = Links(len(keys)), Sets(len(keys))
        simhash.walk(keys, [(0, len(keys), 0, len(keys), 0)], bits, found)
        for i in range(len(keys)):
            for j in np.flatnonzero(np.bitwise_count(keys[i] ^ keys[:i]) <= bits):
                wanted.join(i, int(j))
        assert found.label.tolist() == [wanted.find(i) for i in range(len(keys))]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (300, 299)]
    df = spark.createDataFrame(links + links[:5], "a bigint, b bigint")
    found = {r.node: r.component for r in components(df).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {299: 299, 300: 299}
    assert components(df.limit(0)).count() == 0


def some_vectors(seed: int, n: int) -> list[tuple]:
    pick = np.random.default_rng(seed)
    rows: list[tuple] = []
    for i in range(n):
        if i % 3:
            v = np.array(rows[i - i % 3][1]) + pick.normal(0, 0.05, 8)
        else:
            v = pick.normal(0, 1, 8)
        rows.append((i, [float(np.float32(x)) for x in v], int(pick.integers(0, 2))))
    odd = [
        (None, 0), ([0.0] * 8, 0), ([math.nan] + [1.0] * 7, 1), ([math.inf] + [1.0] * 7, 1),
        ([None] + [1.0] * 7, 1), ([], 0), (rows[0][1], None), ([1.0] * 4, 0), ([2.0] * 4, 0),
        (rows[3][1], rows[3][2]), (rows[3][1], rows[3][2]),
        ([2.0 * x for x in rows[6][1]], rows[6][2]), ([1e30] * 8, 0), ([1e-30] * 8, 0),
    ]
    return rows + [(n + k, v, label) for k, (v, label) in enumerate(odd)]


def linked(spark, rows, least=0.98):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS).repartition(3)
    found = vectors.near_vectors(df, least).collect()
    return {(r.vec_id, r.n_links, r.component_id, r.kept) for r in found}, len(found)


def test_near_vectors(spark):
    rows = some_vectors(1, 120)
    assert linked(spark, rows) == (near_vectors(rows, 0.98), len(rows))


def test_near_vectors_over_cut_cells_and_pivots(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CELL_ROWS", 16)
    monkeypatch.setattr(vectors, "LABEL_ROWS", 6)
    monkeypatch.setattr(vectors, "BLOCK", 8)
    rows = some_vectors(2, 150)
    assert linked(spark, rows) == (near_vectors(rows, 0.98), len(rows))
    assert linked(spark, rows, 0.8) == (near_vectors(rows, 0.8), len(rows))


def test_vectors_without_id_and_empty_table(spark):
    rows = [(None, [1.0, 2.0], 1), (4, [1.0, 2.0], 1), (4, [1.0, 2.0], 1), (9, [2.0, 4.0], 1)]
    found, n = linked(spark, rows)
    assert n == 4 and found == {(None, 0, None, True), (4, 2, 4, True), (9, 2, 4, False)}
    empty = spark.createDataFrame([], VECTORS)
    assert vectors.near_vectors(empty).count() == 0


def test_vectors_that_share_an_id(spark):
    """Two vectors with one vec_id are two nodes, each with its own links and component."""
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.01], 1), (3, [1.0, 0.02], 1), (0, [0.01, 1.0], 1)]
    found, _ = linked(spark, rows)
    wanted = {(1, 2, 1, True), (1, 1, 0, False), (2, 2, 1, False), (3, 2, 1, False), (0, 1, 0, True)}
    assert found == wanted


def test_simhash_tells_rows_apart_by_id_and_text(spark):
    words = [" ".join(f"{c}{i}" for i in range(200)) for c in "abc"]
    # 7 comes with a copy of 5's text and with one of its own.
    docs = [(5, words[0]), (7, words[0]), (7, words[1]), (None, words[0]), (None, words[2]), (None, words[2])]
    kept = [(r.doc_id, r.text) for r in simhash.near_dedup(frame(spark, docs, clashing=True)).collect()]
    assert sorted(kept, key=str) == sorted([docs[0], docs[2], docs[4]], key=str)
