from __future__ import annotations

import random

import numpy as np
import pytest
from brute import substring_dedup, suffix_dedup
from data_llm import frame, passages
from pyspark.sql import functions as F

from vendaflow.llm import anchors, substrings, suffixes

SF = "/root/testdata/sf0.001"


def words_removed(docs, window, **options):
    spans = substrings.repeated_spans
    if options:
        defaults = spans.__defaults__
        spans.__defaults__ = (defaults[0], options["shard_kinds"])
    try:
        found = substrings.remove_repeats(docs, window)
        return sorted(
            found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256)).collect(),
            key=str,
        )
    finally:
        if options:
            spans.__defaults__ = defaults


def bytes_removed(docs, window, shard_kinds=None):
    spans = suffixes.repeated_spans
    defaults = spans.__defaults__
    if shard_kinds:
        spans.__defaults__ = (defaults[0], shard_kinds)
    try:
        found = suffixes.remove_repeats(docs, window)
        return sorted(
            found.select("doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect(),
            key=str,
        )
    finally:
        spans.__defaults__ = defaults


def expected(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("shard_kinds", [1000, 2])
def test_against_brute_force(spark, shard_kinds):
    """With shards of two passages nearly all anchors take the way for crowded ones."""
    docs = passages(7, 40)
    df = frame(spark, docs, clashing=True).repartition(3)
    assert list(map(tuple, words_removed(df, 6, shard_kinds=shard_kinds))) == expected(substring_dedup(docs, 6))
    assert list(map(tuple, bytes_removed(df, 12, shard_kinds))) == expected(suffix_dedup(docs, 12))


def test_given_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    assert list(map(tuple, words_removed(df, 20))) == expected(substring_dedup(docs, 20))
    assert list(map(tuple, bytes_removed(df, 200))) == expected(suffix_dedup(docs, 200))


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = [(5, text), (5, text), (None, None), (7, "other words"), (7, "here")]
    found = words_removed(frame(spark, docs), 6)
    assert sorted((r[0] or 0, r[2]) for r in found) == [(0, 0), (5, 0), (5, 0), (7, 0), (7, 0)]
    assert [r[2] for r in words_removed(frame(spark, [(None, text), (3, text)]), 6)] == [30, 0]
    removed = {r[0]: r[2] for r in bytes_removed(frame(spark, docs), 12)}
    assert removed == {5: len(text), None: 0, 7: 0}


def test_empty_table(spark):
    assert words_removed(frame(spark, []), 6) == []
    assert bytes_removed(frame(spark, []), 12) == []
    assert substrings.without_repeats(frame(spark, [])).count() == 0


def test_long_text_in_stretches(spark, monkeypatch):
    """A text longer than a stretch of tokens, on executors with the same setting: in-process."""
    monkeypatch.setattr(anchors, "TOKENS", 300)
    pick = random.Random(3)
    text = " ".join(pick.choice("abcdefgh") for _ in range(2000))
    scheme = anchors.Scheme(8, 3, substrings.word_codes, "test")
    starts = []
    for _, (lo, hi, place, _, _) in anchors.pieces_of(iter([(0, text)]), scheme):
        assert ((place >= lo) & (place < hi + 8)).all()
        starts += [s for a, b in zip(lo, hi) for s in range(a, b + 1)]
    assert sorted(starts) == list(range(2000 - 8 + 1))


def test_equal_windows_have_equal_anchors():
    pick = random.Random(5)
    codes = np.array([pick.randint(1, 3) for _ in range(500)], np.uint64)
    text, lo, hi, place, gram, _ = anchors.find_anchors(codes, np.array([0, 200, 500]), 10, 3)
    base = np.array([0, 200])[text]
    chosen = {}
    for a, b, p, g, f in zip(lo, hi, place, gram, base):
        for s in range(a, b + 1):
            window = tuple(codes[f + s : f + s + 10])
            assert chosen.setdefault(window, (p - s, g)) == (p - s, g)


def test_cut_texts_keep_the_rest(spark):
    passage = " ".join(f"w{i}" for i in range(25))
    docs = [(1, f"One\n{passage}  end"), (2, f"Two,\n\n{passage} and\tmore"), (3, None), (4, passage)]
    kept = {r.doc_id: r for r in substrings.without_repeats(frame(spark, docs, clashing=True)).collect()}
    assert kept[1].text == docs[0][1]
    assert kept[2].text == "Two,\n\nand\tmore" and kept[2].n_chars == len("Two,\n\nand\tmore")
    assert kept[3].text is None and kept[4].text == ""
    assert (kept[2].declared, kept[2].doc, kept[2].tag, kept[2].others) == ("x", 1, 2, "z")


def test_automaton_statistics():
    pick = random.Random(1)
    for _ in range(50):
        automaton, texts = substrings.SuffixAutomaton(), []
        for _ in range(4):
            new = [pick.choice("ab") for _ in range(pick.randint(0, 12))]
            joined = ["".join(t) for t in texts]
            longest = [
                max(k for k in range(e + 2) if any("".join(new[e + 1 - k : e + 1]) in t for t in joined) or not k)
                for e in range(len(new))
            ]
            assert list(automaton.matching(new)) == longest
            automaton.add(new)
            texts.append(new)


def test_induced_order_finds_repeats():
    pick = random.Random(2)
    for _ in range(100):
        pieces = []
        for _ in range(pick.randint(1, 12)):
            front = bytes(pick.choice(b"ab") for _ in range(pick.randint(0, 4)))
            pieces.append((pick.randint(0, 1), bytes(pick.choice(b"ab") for _ in range(pick.randint(1, 6))), front))
        pieces.sort()
        shard = np.array([p[0] for p in pieces])
        found = {
            (i, d)
            for rows, d in suffixes.induced_repeats(shard, [p[2] for p in pieces], [p[1] for p in pieces], 4)
            for i in rows.tolist()
        }
        wanted = set()
        for i, (s, rest, front) in enumerate(pieces):
            for d in range(len(front) + 1):
                own = (front[len(front) - d :] + rest)[:4]
                for j, (t, other, before) in enumerate(pieces):
                    if i != j and s == t and len(before) >= d and len(own) == 4:
                        if (before[len(before) - d :] + other)[:4] == own:
                            wanted.add((i, d))
        assert found == wanted




def test_many_equal_rows(spark):
    """The work of N equal rows is for N, not for its square: their spans are one list."""
    text = " ".join(f"w{i * 7919 % 1000}" for i in range(250))
    docs = frame(spark, [(None if i % 2 else 7, text) for i in range(4000)] + [(1, "x " + text)])
    found = suffixes.remove_repeats(docs, window=200).selectExpr("n_bytes - n_removed AS left").groupBy("left").count()
    assert {r["left"]: r["count"] for r in found.collect()} == {0: 4000, 2: 1}
    found = substrings.remove_repeats(docs, window=20).groupBy("doc_id", "n_removed").count()
    # Null ids come first and stay; the other rows have an earlier one.
    assert {tuple(r) for r in found.collect()} == {(None, 0, 2000), (7, 250, 2000), (1, 250, 1)}
