"""The conversation trie against a plain one."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from compare import difference

from vendaflow.llm import prefixes
from vendaflow.llm.prefixes import PREFIX_SQL, prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv bigint, at string, row string, k1 int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA)


def plain(rows) -> list[tuple]:
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p))
        out.append((
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def talk(seed: int, n: int, longest: int = 12) -> list[tuple]:
    """Conversations over few words, many alike; ties, null turns, copies and gaps in the ids."""
    pick = random.Random(seed)
    rows = []
    for c in range(n):
        if pick.random() < 0.2:
            continue
        for t in range(pick.choice([1, 2, 3, pick.randint(1, longest)])):
            turn = pick.choice([t, t, t, 0, None])
            rows.append((c, turn, pick.choice(["user", "bot", None]), pick.choice(["a", "a", "é", "", None, "日本"])))
    rows += [r for r in rows if r[0] % 7 == 0]  # repeated rows
    rows += [(None, 1, "user", "lost"), (10**12, 1, "user", "a"), (10**12 + 3, None, None, None)]
    pick.shuffle(rows)
    return rows


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("piece", [20_000, 40, 3])
def test_plain_trie(spark, piece):
    rows = talk(piece, 120)
    assert result(prefix_trie(frame(spark, rows), piece=piece)) == plain(rows)


def test_one_long_conversation(spark):
    """A chain is cut in the middle; the conversation stretches over many sorted partitions."""
    rows = [(5, t, "user", str(t % 3)) for t in range(160)] + [(10, t, "user", str(t % 3)) for t in range(120)]
    assert result(prefix_trie(frame(spark, rows), piece=20)) == plain(rows)


def test_many_copies(spark):
    rows = [(c, t, "user", "hello" * t) for c in range(0, 3000, 5) for t in range(3)] + talk(9, 60)
    assert result(prefix_trie(frame(spark, rows), piece=500)) == plain(rows)


def test_sql(spark):
    table = frame(spark, talk(4, 80))
    con = duckdb.connect()
    con.register("conversations", table.toArrow())
    assert difference(prefix_trie(table), con, PREFIX_SQL) is None


def test_empty(spark):
    assert prefix_trie(frame(spark, [])).collect() == []
    assert prefix_trie(frame(spark, [(None, 1, "a", "b")])).collect() == []


def test_no_turn_left(spark):
    """A conversation whose turns all give way to a base that does not exist."""
    lost = next(c for c in range(10**6, 10**6 + 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    found = result(prefix_trie(frame(spark, [(lost, 0, "user", "a")])))
    assert found == plain([(lost, 0, "user", "a")])
    assert [r[1] for r in found] == [0]


def test_rounds_halve_the_weight():
    """A chain of n nodes is taken apart in log2(n) rounds, and sums are exact."""
    n = 1000
    keys = np.column_stack((np.arange(1, n + 1), np.zeros(n, np.int64)))
    values = np.column_stack((np.ones(n, np.int64), np.arange(n) * 2**40))
    leaves, tokens = prefixes.take_apart({
        "own": keys, "up": keys - [1, 0], "depth": np.arange(n), "component": np.zeros(n, np.int64),
        "weight": np.arange(n, 0, -1), "values": values,
    })
    assert leaves.tolist() == list(range(n, 0, -1))
    assert tokens.tolist() == values[::-1, 1].cumsum()[::-1].tolist()
