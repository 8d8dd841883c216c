"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import base64
import hashlib
from collections import Counter

import numpy as np
import xxhash


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


class Sets:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def suffix_dedup(docs, window):
    count = Counter()
    texts = [(d, (t or "").encode()) for d, t in docs]
    for _, b in texts:
        count.update(b[i : i + window] for i in range(len(b) - window + 1))
    for d, b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if count[b[i : i + window]] > 1:
                gone[i : i + window] = True
        runs = int(np.sum(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))
        yield d, len(b), int(gone.sum()), runs, sha(bytes(c for c, g in zip(b, gone) if not g))


def substring_dedup(docs, window):
    texts = sorted(
        ((d, (t or "").encode().split()) for d, t in docs), key=lambda x: (x[0] is not None, x[0] or 0)
    )
    first = {}
    for d, w in texts:
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), (d, i))
    for d, w in texts:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] != (d, i):
                gone.update(range(i, i + window))
        yield d, len(w), len(gone), sha(b" ".join(x for i, x in enumerate(w) if i not in gone))


def fingerprint(text, size=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(docs, bits=4):
    """docs sorted by id."""
    prints = [fingerprint(t) for _, t in docs]
    sets = Sets(len(docs))
    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                sets.join(i, j)
    return {(d, f"{prints[i]:016x}", docs[sets.find(i)][0]) for i, (d, _) in enumerate(docs)}


def near_vectors(rows, least):
    """rows (vec_id, vector or None, label), sorted by id."""

    def able(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    sets, links = Sets(len(rows)), [0] * len(rows)
    for i, (_, v, a) in enumerate(rows):
        for j, (_, w, b) in enumerate(rows[:i]):
            if able(v, a) and able(w, b) and a == b and len(v) == len(w):
                x, y = (np.array(u, np.float64) for u in (v, w))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    sets.join(i, j)
                    links[i] += 1
                    links[j] += 1
    return {
        (r[0], links[i], rows[sets.find(i)][0], sets.find(i) == i) for i, r in enumerate(rows)
    }


def warc_rows(pages):
    payloads = [(p, (h or "").encode()) for p, h in pages]
    first = {}
    for p, b in payloads:
        if p is not None:
            first[b] = min(p, first.get(b, p))
    for p, b in payloads:
        again = p is not None and first[b] != p
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        yield p, len(b), digest, "revisit" if again else "response", first[b] if again else None
