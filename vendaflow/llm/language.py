"""Language identification with a blended-spectrum string kernel."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vendaflow.llm.common import column, fit_sample, saved, text_or_empty

MAX_N = 3
UNDETERMINED = "und"
ROWS = 256  # texts scored by one matrix product


def grams(text: str) -> np.ndarray:
    """Distinct 1-, 2- and 3-grams of the lower-cased text as integers, ascending.

    A character takes 21 bits, so that the integers stand for the n-grams themselves.
    Everything that is no letter counts as a space, and spaces in a row as one.
    """
    lowered = f" {text.lower()} "
    codes = np.frombuffer(lowered.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    letters = _is_letter(codes, lowered)
    codes = np.where(letters, codes, np.uint64(32))
    codes = codes[letters | np.concatenate(([True], letters[:-1]))]
    found = [codes]
    for _ in range(MAX_N - 1):
        last = found[-1]
        if len(last) < 2:
            break
        found.append((last[:-1] << np.uint64(21)) | codes[len(codes) - len(last) + 1 :])
    return np.unique(np.concatenate(found))


_ASCII_LETTER = np.array([chr(i).isalpha() for i in range(0x250)])


def _is_letter(codes: np.ndarray, text: str) -> np.ndarray:
    small = codes < 0x250
    known = _ASCII_LETTER[np.where(small, codes, 0).astype(np.int64)] & small
    if small.all():
        return known
    other = np.fromiter((text[i].isalpha() for i in np.flatnonzero(~small)), dtype=bool)
    known[~small] = other
    return known


def presence(found: list[np.ndarray], known: np.ndarray) -> np.ndarray:
    """One row per text: 1 for each of the `known` n-grams it has."""
    rows = np.zeros((len(found), len(known)), dtype=np.float32)
    for row, g in zip(rows, found):
        at = np.searchsorted(known, g)
        at[at == len(known)] = 0
        row[at[known[at] == g]] = 1
    return rows


def sizes(found: list[np.ndarray]) -> np.ndarray:
    return np.sqrt(np.array([max(1, len(g)) for g in found], dtype=np.float32))


@dataclass
class LanguageModel:
    """Kernel ridge regression, one against the rest, over Nyström features."""

    languages: list[str]
    known: np.ndarray  # n-grams of the landmarks
    landmarks: np.ndarray  # presence rows of the landmarks, scaled
    weights: np.ndarray  # landmarks x languages, the whitening included
    bias: np.ndarray

    def scores(self, found: list[np.ndarray]) -> np.ndarray:
        kernel = (presence(found, self.known) @ self.landmarks.T) / sizes(found)[:, None]
        return kernel @ self.weights + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Languages and scores from 0 to 1; `und` and 0 without a letter."""
        texts = [text_or_empty(t) for t in texts]
        lettered = [any(map(str.isalpha, t)) for t in texts]
        names = [UNDETERMINED] * len(texts)
        best = np.zeros(len(texts))
        chosen = [i for i, yes in enumerate(lettered) if yes]
        if chosen and self.languages:
            scores = self.scores([grams(texts[i]) for i in chosen])
            top = scores.argmax(axis=1)
            for i, k, s in zip(chosen, top, scores.max(axis=1)):
                names[i] = self.languages[k]
                best[i] = min(1.0, max(0.0, float(s)))
        return names, best


def usable_sample(rows: DataFrame, per_language: int, longest: int, seed: int) -> DataFrame:
    """(text, lang, long, _rank), saved: `per_language` texts of a language, the short ones first."""
    usable = rows.select("text", "lang", (F.length("text") > longest).alias("long")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    short = saved(
        fit_sample(usable.filter("NOT long").drop("long"), "lang", per_language, seed), "fit-short"
    )
    enough = short.groupBy("lang").count().filter(F.col("count") >= per_language)
    long = usable.filter("long").drop("long").join(F.broadcast(enough), "lang", "left_anti")
    both = short.withColumn("long", F.lit(False)).unionByName(
        fit_sample(long, "lang", per_language, seed).withColumn("long", F.lit(True))
    )
    own = Window.partitionBy("lang").orderBy("long", F.xxhash64(F.lit(seed + 1), "text"), "text")
    ranked = both.withColumn("_rank", F.row_number().over(own))
    return saved(ranked.filter(F.col("_rank") <= per_language), "fit-sample")


def sampled_grams(sample: DataFrame) -> DataFrame:
    """(lang, _rank, grams): the n-grams are found in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                found = grams(one.column("text")[0].as_py()).astype(np.int64)
                yield pa.record_batch(
                    {
                        "lang": one.column("lang"),
                        "_rank": one.column("_rank"),
                        "grams": pa.array([found], pa.list_(pa.int64())),
                    }
                )

    return sample.select("text", "lang", "_rank").mapInArrow(
        run, "lang string, _rank int, grams array<bigint>"
    )


def sampled_kernel(sample: DataFrame, known: np.ndarray, scaled: np.ndarray) -> DataFrame:
    """(lang, _rank, kernel): each text's kernel values with the landmarks, found in the tasks."""
    shared = sample.sparkSession.sparkContext.broadcast((known, scaled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, scaled = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                found = [grams(t) for t in column(batch, "text")]
                kernel = (presence(found, known) @ scaled.T) / sizes(found)[:, None]
                yield pa.record_batch(
                    {
                        "lang": batch.column("lang"),
                        "_rank": batch.column("_rank"),
                        "kernel": pa.array(list(kernel), pa.list_(pa.float32())),
                    }
                )

    return sample.select("text", "lang", "_rank").mapInArrow(
        run, "lang string, _rank int, kernel array<float>"
    )


def fit(
    rows: DataFrame, per_language: int = 400, landmarks: int = 160, ridge: float = 1e-2,
    longest: int = 20_000, seed: int = 7,
) -> LanguageModel:
    """Learn from (text, lang) rows; null texts and languages are left out.

    A bounded sample is learned from: `per_language` texts of each language, of which
    `landmarks` in all, but one of each language at least, are landmarks. Texts of more than
    `longest` characters count only in a language that has too few others. The driver holds
    the n-grams of the landmarks and sums over the sample, whose rows are read in blocks.
    Without usable rows the model knows no language and predicts `und`.
    """
    sample = usable_sample(rows, per_language, longest, seed)
    counts = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        nothing = np.zeros((0, 0), dtype=np.float32)
        return LanguageModel([], np.zeros(0, np.uint64), nothing, nothing, np.zeros(0))
    each = -(-landmarks // len(languages))
    marks = sampled_grams(sample.filter(F.col("_rank") <= each)).orderBy("lang", "_rank")
    marks = [np.array(r["grams"], np.int64).astype(np.uint64) for r in marks.toLocalIterator()]
    known = np.unique(np.concatenate(marks))
    scaled = presence(marks, known)
    scaled /= sizes(marks)[:, None]
    values, vectors = np.linalg.eigh((scaled @ scaled.T).astype(np.float64))
    kept = values > 1e-6 * values.max()
    whiten = vectors[:, kept] / np.sqrt(values[kept])
    # Each language weighs the same, however many texts it has.
    total = sum(counts.values())
    gram = ridge * np.eye(whiten.shape[1] + 1)
    answers = np.zeros((len(gram), len(languages)))
    at = {name: i for i, name in enumerate(languages)}
    kernel = sampled_kernel(sample, known, scaled).orderBy("lang", "_rank").toLocalIterator()
    while block := list(itertools.islice(kernel, ROWS)):
        features = np.array([r["kernel"] for r in block]) @ whiten
        features = np.column_stack((features, np.ones(len(block))))
        weight = np.array([total / (len(languages) * counts[r["lang"]]) for r in block])
        gram += features.T @ (features * weight[:, None])
        np.add.at(answers.T, [at[r["lang"]] for r in block], features * weight[:, None])
    solved = np.linalg.solve(gram, answers)
    weights = (whiten @ solved[:-1]).astype(np.float32)
    return LanguageModel(languages, known, scaled, weights, solved[-1].astype(np.float32))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text; nothing but the text is looked at.

    Null, empty and letterless texts are `und` with score 0. The score is the best
    regression value, held between 0 and 1. The model's size is set by its landmarks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                names, best = shared.value.predict(list(column(batch, "text")))
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id"),
                        "lang_pred": pa.array(names, pa.string()),
                        "score": pa.array(best, pa.float64()),
                    }
                )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, lang_pred string, score double"
    )
