"""The registered queries over the smallest tables, against plain versions or SQL."""

from __future__ import annotations

import hashlib

import duckdb
import pytest
import public_tokenizers
import sentencepiece
from brute import near_vectors, simhash_groups, substring_dedup, suffix_dedup, warc_rows
from compare import difference
from test_whitening import plain as whitened_plain

import corpus_pipeline
from vendaflow.llm import benchmark
from vendaflow.llm.queries import ORACLE_SQL, QUERIES, VOCABULARY
from vendaflow.llm.substrings import WORD

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    return [(r.doc_id, r.text) for r in rows]


def found(spark, name):
    return set(map(tuple, QUERIES[name](spark, SF).collect()))


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    assert difference(QUERIES[name](spark, SF), con, ORACLE_SQL[name]) is None


def test_op1(spark, docs):
    assert found(spark, "op1_suffix_dedup") == set(suffix_dedup(docs, 200))


def test_op4(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(VOCABULARY))
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    wanted = set()
    for d, text in docs:
        ids = library.encode(text or "")
        wanted.add((d, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    assert found(spark, "op4_sentencepiece") == wanted


def test_op5(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert found(spark, "op5_warc") == set(warc_rows(pages))


def test_op6(spark, docs):
    assert found(spark, "op6_simhash") == simhash_groups(docs)


def test_op9(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id")
    rows = [(r.vec_id, list(r.embedding), r.label) for r in table.collect()]
    assert found(spark, "op9_embedding_dedup") == near_vectors(rows, 0.98)


def test_op10(spark, docs):
    assert found(spark, "op10_substring_dedup") == set(substring_dedup(docs, 20))


@pytest.mark.parametrize("name", ["op3_language_id", "op8_quality"])
def test_models_score_every_document(spark, docs, name):
    rows = QUERIES[name](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == [d for d, _ in docs]
    assert {r.held_out for r in rows} == {True, False} and all(0 <= r.score <= 1 for r in rows)


def plain_stages(rows, items, window=20):
    """What the stages after the classifier leave of its (doc_id, text) rows."""
    groups = simhash_groups(rows)
    kept = [(d, t) for d, t in rows if (d, d) in {(i, c) for i, _, c in groups}]
    first, cut = {}, []
    for d, text in kept:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            first.setdefault(tuple(words[i : i + window]), (d, i))
    for d, text in kept:
        words, gone = (text or "").encode().split(), set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] != (d, i):
                gone.update(range(i, i + window))
        at = [m.start() for m in WORD.finditer(text or "")] + [len(text or "")]
        # A removed word goes with the space behind it.
        parts = [(text or "")[: at[0]]] + [text[at[i] : at[i + 1]] for i in range(len(words)) if i not in gone]
        cut.append((d, "".join(parts)))
    shingles = [benchmark.words_of(t) for t in items]
    out = []
    for d, text in cut:
        words = benchmark.words_of(text)
        held = False
        for item in shingles:
            n = min(5, len(item))
            if n:
                own = set(zip(*[item[k:] for k in range(n)]))
                held |= len(own & set(zip(*[words[k:] for k in range(n)]))) * 5 >= len(own) * 4
        if not held:
            out.append((d, text))
    return out


def test_pipeline(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.quality_classifier(spark, source, SF).orderBy("doc_id").collect()
    assert 0 < len(good) < source.count()
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    wanted = plain_stages([(r.doc_id, r.text) for r in good], items)
    rows = corpus_pipeline.run(spark, SF).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text) for r in rows] == wanted
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(VOCABULARY))
    for r in rows:
        assert r.ids == library.encode(r.text) and r.decoded == library.decode(r.ids)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).schema.names == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_no_documents_at_all(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_op13(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    n, far, white, explained = whitened_plain([(r.vec_id, r.embedding) for r in table], 8)
    wanted = {(r.vec_id, c + 1): (far[i], white[i][c]) for i, r in enumerate(table) for c in range(8)}
    rows = QUERIES["op13_embedding_whitening"](spark, SF).collect()
    assert len(rows) == len(wanted)
    for r in rows:
        deviation, value = wanted[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(abs(value), rel=1e-6, abs=1e-8)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9
