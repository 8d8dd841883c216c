"""Small inputs for the tests of this folder."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Extra columns named as columns are named inside the operators.
CLASHING = "declared string, doc bigint, tag int, rows string, others string, node bigint, fp bigint"


def frame(spark: SparkSession, docs, clashing: bool = False) -> DataFrame:
    rows = [(d, t, "en", "src", None if t is None else len(t)) for d, t in docs]
    if not clashing:
        return spark.createDataFrame(rows, SCHEMA)
    more = ("x", 1, 2, "y", "z", 3, 4)
    return spark.createDataFrame([r + more for r in rows], f"{SCHEMA}, {CLASHING}")


def passages(seed: int, n: int) -> list[tuple[int, str | None]]:
    """Texts of few words put together from shared passages, and odd ones."""
    pick = random.Random(seed)
    words = ["a", "bb", "c", "dé", "日本"]
    base = [[pick.choice(words) for _ in range(60)] for _ in range(3)]
    docs: list[tuple[int, str | None]] = []
    for i in range(n):
        text = []
        for _ in range(pick.randint(0, 4)):
            at = pick.randint(0, 50)
            text += pick.choice(base)[at : at + pick.randint(1, 30)]
            text += [pick.choice([*words, "X"]) for _ in range(pick.randint(0, 10))]
        docs.append((i, pick.choice([" ", "  ", "\n"]).join(text)))
    docs += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "a" * 500), (1004, docs[0][1])]
    return docs
