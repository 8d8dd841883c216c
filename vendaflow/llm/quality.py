"""Quality classifier: a factorisation machine over hashed words and structure."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vendaflow.llm.common import column, text_or_empty

WORD_SLOTS = 1 << 15
EDGES = 15  # cuts of each statistic into intervals
STATISTICS = [
    "bytes", "words", "mean_word", "upper", "digits", "marks", "spaces", "beyond_ascii",
    "distinct_words", "repeated_next", "commonest_word", "lines", "distinct_lines",
    "line_words", "shouted_words", "marked_words", "bars", "declared_chars",
]

_KIND = np.zeros(256, dtype=np.int64)
_KIND[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 1
_KIND[[ord(c) for c in "0123456789"]] = 2
_KIND[[ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{}~"]] = 3
_KIND[[ord(c) for c in " \t\n\r\v\f"]] = 4
_KIND[128:] = 5
_KIND[ord("|")] = 6


def statistics(text: str, words: list[str], counts: Counter, declared: int | None) -> list[float]:
    """The values named by STATISTICS; `declared` is the character count of the metadata."""
    raw = text.encode()
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kinds = np.bincount(_KIND, weights=kinds, minlength=7) / max(1, len(raw))
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        np.log1p(len(raw)),
        np.log1p(len(words)),
        len(text) / n,
        kinds[1],
        kinds[2],
        kinds[3],
        kinds[4],
        kinds[5],
        len(counts) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        max(counts.values(), default=0) / n,
        len(lines) / n,
        len(set(lines)) / max(1, len(lines)),
        n / max(1, len(lines)),
        sum(map(str.isupper, words)) / n,
        sum(w[-1] in "!?.,;:" for w in words) / n,
        kinds[6],
        -1.0 if declared is None else np.log1p(max(0, declared)),
    ]


def word_slots(counts: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Slots and weights of the lower-cased words: damped counts, scaled to length 1."""
    merged: dict[int, float] = {}
    for word, c in counts.items():
        slot = zlib.crc32(word.lower().encode()) % WORD_SLOTS
        merged[slot] = merged.get(slot, 0) + c
    slots = np.fromiter(merged.keys(), dtype=np.int32, count=len(merged))
    weights = np.log1p(np.fromiter(merged.values(), dtype=np.float32, count=len(merged)))
    return slots, weights / max(1e-6, float(np.sqrt(weights @ weights)))


def features(text: str | None, declared: int | None) -> tuple[np.ndarray, np.ndarray, list[float]]:
    text = text_or_empty(text)
    words = text.split()
    counts = Counter(words)
    slots, weights = word_slots(counts)
    return slots, weights, statistics(text, words, counts, declared)


@dataclass
class FactorisationMachine:
    """score = sigmoid(w0 + w.x + sum over pairs <v_i, v_j> x_i x_j), of fixed size."""

    edges: np.ndarray  # statistic x EDGES
    w0: float
    w: np.ndarray  # slot
    v: np.ndarray  # slot x rank

    def slots(self, rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slots, values and row starts: words first, then one interval per statistic."""
        stats = np.array([r[2] for r in rows], dtype=np.float64)
        interval = np.stack(
            [np.searchsorted(e, s, side="right") for e, s in zip(self.edges, stats.T)], axis=1
        )
        base = WORD_SLOTS + np.arange(len(STATISTICS)) * (EDGES + 1)
        value = np.full(len(STATISTICS), 1 / np.sqrt(len(STATISTICS)), dtype=np.float32)
        slots = [x for r, i in zip(rows, interval) for x in (r[0], (base + i).astype(np.int32))]
        values = [x for r in rows for x in (r[1], value)]
        starts = np.cumsum([0] + [len(r[0]) + len(STATISTICS) for r in rows])[:-1]
        return np.concatenate(slots), np.concatenate(values), starts

    def forward(self, slots: np.ndarray, values: np.ndarray, starts: np.ndarray) -> tuple:
        """Scores before the sigmoid, and the sums of factors that the gradient needs.

        The pairs of a row come from the square of its sum less the sum of its squares, in
        time linear in the words.
        """
        factors = self.v[slots] * values[:, None]
        sums = np.add.reduceat(factors, starts)
        squares = np.add.reduceat(factors * factors, starts)
        linear = np.add.reduceat(self.w[slots] * values, starts)
        return self.w0 + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums, factors

    def score(self, rows: list[tuple]) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        raw = self.forward(*self.slots(rows))[0].astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def train(
    rows: list[tuple], labels: np.ndarray, rank: int, steps: int, rate: float, decay: float, seed: int
) -> FactorisationMachine:
    """Logistic loss by AdaGrad: about `steps` batches of 64 rows, in whole passes."""
    random = np.random.default_rng(seed)
    stats = np.array([r[2] for r in rows], dtype=np.float64)
    edges = np.quantile(stats, np.linspace(0, 1, EDGES + 2)[1:-1], axis=0).T
    n = WORD_SLOTS + len(STATISTICS) * (EDGES + 1)
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
    fm = FactorisationMachine(
        edges, float(np.log(share / (1 - share))), np.zeros(n, np.float32),
        random.normal(0, 0.05, (n, rank)).astype(np.float32),
    )
    seen_w, seen_v = np.full(n, 1e-6, np.float32), np.full((n, rank), 1e-6, np.float32)
    for _ in range(max(1, steps * 64 // len(rows))):
        order = random.permutation(len(rows))
        for at in range(0, len(order), 64):
            chosen = order[at : at + 64]
            slots, values, starts = fm.slots([rows[i] for i in chosen])
            raw, sums, factors = fm.forward(slots, values, starts)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[chosen]).astype(np.float32)
            counts = np.diff(np.append(starts, len(slots)))
            e = np.repeat(error, counts)
            used, place = np.unique(slots, return_inverse=True)
            gw = np.bincount(place, weights=e * values).astype(np.float32)
            one = (e * values)[:, None] * (np.repeat(sums, counts, axis=0) - factors)
            gv = np.stack([np.bincount(place, weights=one[:, f]) for f in range(rank)], axis=1)
            gw = gw / len(chosen) + decay * fm.w[used]
            gv = gv.astype(np.float32) / len(chosen) + decay * fm.v[used]
            seen_w[used] += gw * gw
            seen_v[used] += gv * gv
            fm.w[used] -= rate * gw / np.sqrt(seen_w[used])
            fm.v[used] -= rate * gv / np.sqrt(seen_v[used])
            fm.w0 -= 0.05 * rate * float(error.mean())
    return fm


def fit(
    docs: DataFrame, labelled: DataFrame, most: int = 12_000, rank: int = 6, steps: int = 1200,
    rate: float = 0.1, decay: float = 1e-5, seed: int = 11,
) -> FactorisationMachine | None:
    """Learn from the documents whose doc_id has a quality of 0 or 1 in `labelled`.

    At most about `most` labelled documents are fitted, chosen by a hash of their doc_id;
    their features, not their texts, go to the driver. None without a labelled document.
    """
    marks = (
        labelled.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
    )
    total = marks.count()
    if not total:
        return None
    share = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id").cast("bigint")), F.lit(1_000_000)) / 1_000_000
    chosen = marks.filter(share < most / total)
    # At most about `most` rows of two numbers.
    texts = with_declared(docs).join(F.broadcast(chosen), "doc_id").select("text", "declared", "quality")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t, n) for t, n in zip(column(batch, "text"), column(batch, "declared"))]
            yield pa.record_batch(
                {
                    "slots": pa.array([f[0] for f in found], pa.list_(pa.int32())),
                    "weights": pa.array([f[1] for f in found], pa.list_(pa.float32())),
                    "stats": pa.array([f[2] for f in found], pa.list_(pa.float64())),
                    "quality": batch.column("quality").cast(pa.int32()),
                }
            )

    schema = "slots array<int>, weights array<float>, stats array<double>, quality int"
    got = texts.mapInArrow(run, schema).toArrow()
    order = pa.compute.sort_indices(pa.array([hash_row(x) for x in got["stats"].to_pylist()]))
    got = got.take(order)
    rows = [
        (np.array(s.values, dtype=np.int32), np.array(w.values, dtype=np.float32), t.as_py())
        for s, w, t in zip(got["slots"], got["weights"], got["stats"])
    ]
    labels = got["quality"].to_numpy().astype(np.float32)
    return train(rows, labels, rank, steps, rate, decay, seed) if rows else None


def hash_row(stats: list[float]) -> int:
    """Training order that does not depend on how the rows were partitioned."""
    return zlib.crc32(np.array(stats).tobytes())


def with_declared(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", declared_in(docs).alias("declared"))


def declared_in(docs: DataFrame) -> Column:
    """The number of characters that the metadata names, null if there is none."""
    return F.col("n_chars").try_cast("bigint") if "n_chars" in docs.columns else F.lit(None).cast("bigint")


def scores(docs: DataFrame, model: FactorisationMachine | None) -> DataFrame:
    """(doc_id, score) of every whole text: 0 to 1, higher where quality 1 is likelier.

    Null texts count as empty and get a score like any other; without a model it is 1, so
    that nothing is rejected. doc_id, source and lang are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                batch = whole.slice(at, 128)
                fm = shared.value
                if fm is None:
                    found = np.ones(batch.num_rows)
                else:
                    found = fm.score(
                        [features(t, n) for t, n in zip(column(batch, "text"), column(batch, "declared"))]
                    )
                yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(found)})

    return with_declared(docs).mapInArrow(run, "doc_id bigint, score double")


def keep_good(docs: DataFrame, model: FactorisationMachine | None, least: float = 0.3) -> DataFrame:
    """The documents with a score of at least `least`; columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names, extra = docs.columns, "declared"
    while extra in names:
        extra += "_"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                batch = whole.slice(at, 128)
                if shared.value is not None:
                    found = shared.value.score(
                        [features(t, n) for t, n in zip(column(batch, "text"), column(batch, extra))]
                    )
                    batch = batch.filter(pa.array(found >= least))
                yield batch.select(names)

    return docs.withColumn(extra, declared_in(docs)).mapInArrow(run, docs.schema)
