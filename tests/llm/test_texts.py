from __future__ import annotations

import random
from fractions import Fraction

import pytest
import public_tokenizers
from data_llm import SCHEMA, frame
from pyspark.sql import functions as F

from vendaflow.llm import benchmark, language, pieces, quality
from vendaflow.llm.common import fit_sample
from vendaflow.llm.queries import VOCABULARY, quality_model, remainder

SF = "/root/testdata/sf0.01"
ODD = [
    "", " ", "  ", "a  b\tc\n", " x", "x▁y é𝄞\x00z\r", "\n\n x \n", "▁▁", "日本語 テスト" * 50, "aaaa" * 1000,
    "a" * 50 + " " * 37 + "b", "🎉" * 5, "x\n", "á ﬁ ＡＢ", "word " * 20000,
]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.MergeVocabulary(public_tokenizers.path(VOCABULARY))


def test_encoding_is_the_library_s(vocabulary):
    pick = random.Random(1)
    texts = ODD + [
        "".join(pick.choice("ab \n▁éの\x00🎉,.1 the") for _ in range(pick.randint(0, 60))) for _ in range(2000)
    ]
    for text in texts:
        ids = vocabulary.library.encode(text)
        assert vocabulary.encode(text) == (",".join(map(str, ids)), len(ids), vocabulary.library.decode(ids))
    vocabulary.check()


def test_heap_and_scan_agree(vocabulary):
    for text in ("internationalisation", "▁aaaaaaaaaaaaaaaaaaaaaaaaaaa", "▁▁▁▁▁x", "Straßenbahnhaltestelle"):
        assert vocabulary.scan(text) == vocabulary.agenda(text)


def test_a_difference_is_an_error(vocabulary):
    vocabulary.unchecked.append(("▁hello", [1, 2]))
    with pytest.raises(ValueError, match="differs"):
        vocabulary.check()


def test_encoded_documents(spark):
    library = pieces.vocabulary(public_tokenizers.path(VOCABULARY)).library
    docs = [*enumerate(ODD), (90, None), (90, None), (None, "the end")]
    df = frame(spark, docs, clashing=True)
    found = pieces.encode(df, public_tokenizers.path(VOCABULARY)).collect()
    assert len(found) == len(docs)
    for r in found:
        assert r.ids == library.encode(r.text or "") and r.n_tokens == len(r.ids)
        assert r.decoded == library.decode(r.ids) and r.declared == "x"
    assert pieces.digests(frame(spark, []), public_tokenizers.path(VOCABULARY)).count() == 0


def test_a_text_that_has_the_added_columns(spark):
    df = spark.createDataFrame([(1, "a b", "mine", 7)], "doc_id bigint, text string, ids string, n_tokens int")
    r = pieces.encode(df, public_tokenizers.path(VOCABULARY)).first()
    assert r.n_tokens == 2 and len(r.ids) == 2


def test_decoding_is_compared_with_the_library(monkeypatch):
    path = public_tokenizers.path(VOCABULARY)
    words = pieces.MergeVocabulary(path)
    for text in ODD:
        words.encode(text)
    words.check()
    monkeypatch.setattr(words, "decode", lambda ids: pieces.MergeVocabulary.decode(words, ids) + "x")
    words.encode("neverseen")
    with pytest.raises(ValueError, match="decoding"):
        words.check()


def test_contained_items(spark):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa"
    items = [(1, item), (2, "two words"), (3, None), (4, " .,! "), (None, item), (1, "Another text for item one")]
    docs = [
        (10, "x " * 3000 + item.upper().replace(" ", ", ") + " y" * 3000),
        (11, "alpha beta gamma delta epsilon zeta eta theta iota other"),  # 5 of 6 shingles
        (12, "alpha beta gamma delta epsilon zeta eta theta other kappa"),  # 4 of 6
        (13, "here are TWO words"), (13, "here are TWO words"), (14, None), (15, ""), (None, item),
    ]
    df = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id int, text string, doc_id int")
    found = benchmark.contained(frame(spark, docs, clashing=True), df).collect()
    wanted = {(10, 1, 6, 6), (11, 1, 5, 6), (13, 2, 1, 1), (None, 1, 6, 6)}
    assert {(r.doc_id, r.item_id, r.n_found, r.n_shingles) for r in found} == wanted
    assert len(found) == len(wanted)
    clean = benchmark.without_items(frame(spark, docs, clashing=True), df)
    assert sorted(str(r.doc_id) for r in clean.collect()) == ["12", "14", "15", "None"]
    nothing = df.limit(0)
    assert benchmark.contained(frame(spark, docs), nothing).count() == 0
    assert benchmark.contained(frame(spark, []), df).count() == 0


def test_items_of_rows_that_share_an_id(spark):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa"
    df = spark.createDataFrame([(1, item)], "item_id int, text string")
    docs = frame(spark, [(1, item), (1, "clean"), (None, item), (None, "clean"), (2, None)], clashing=True)
    clean = benchmark.without_items(docs, df, spare_nameless=False)
    assert clean.columns == docs.columns
    assert {(r.doc_id, r.text) for r in clean.collect()} == {(1, "clean"), (None, "clean"), (2, None)}
    kept = {(r.doc_id, r.text) for r in benchmark.without_items(docs, df).collect()}
    assert kept == {(1, "clean"), (None, item), (None, "clean"), (2, None)}


def test_items_in_several_parts(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = {tuple(r) for r in benchmark.contained(docs, items).collect()}
    monkeypatch.setattr(benchmark, "PART_BYTES", 4000)
    assert {tuple(r) for r in benchmark.contained(docs, items).collect()} == whole != set()


def test_sketch_never_misses():
    """Any set of shingles that is large enough holds one of the sketch."""
    pick = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    index = benchmark.ItemIndex.build([(0, " ".join(words))], Fraction(4, 5))
    for _ in range(200):
        text = list(words)
        for _ in range(pick.randint(0, 3)):
            text[pick.randrange(40)] = "other"
        runs = set(zip(*[text[k:] for k in range(5)]))
        hits = len(runs & index.shingles[0][1])
        assert bool(index.search(" ".join(text))) == (hits * 5 >= 36 * 4)


def test_languages_of_documents_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs.filter(remainder(3) != 1), landmarks=80)
    found = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.filter(remainder(3) == 1).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held > 0.95
    low, high = found.agg(F.min("score"), F.max("score")).first()
    assert 0 <= low and high <= 1


def test_copies_do_not_thin_a_language(spark):
    """All texts of a language that has few, 400 of one that has many, whatever their copies."""
    few = spark.range(60000).selectExpr("concat('few ', id % 10) AS text", "'few' AS lang")
    many = spark.range(31000).selectExpr("concat('many ', greatest(id, 30000)) AS text", "'many' AS lang")
    rows = few.unionByName(many)
    found = fit_sample(rows, "lang", 400, 7)
    assert {r.lang: r["count"] for r in found.groupBy("lang").count().collect()} == {"few": 10, "many": 400}
    assert found.distinct().count() == 410
    one = fit_sample(rows, "lang", 1, 7).collect()
    assert sorted(r.lang for r in one) == ["few", "many"]
    assert sorted(one) == sorted(fit_sample(rows.repartition(7), "lang", 1, 7).collect())


def test_a_language_of_long_texts_is_learned(spark):
    """Long texts make up for short ones that a language lacks, and only then."""
    rows = [(1, "the and of to " * 2000, "en"), (2, "the of", "en"), (3, "der die das und " * 2000, "de")]
    docs = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    model = language.fit(docs)
    assert model.languages == ["de", "en"]
    found = language.identify(docs, model).collect()
    assert {(r.doc_id, r.lang_pred) for r in found} == {(1, "en"), (2, "en"), (3, "de")}
    taken = language.usable_sample(docs, 1, 20_000, 7).collect()
    assert {(r.lang, r.long) for r in taken} == {("en", False), ("de", True)} and len(taken) == 2


def test_language_of_odd_texts(spark):
    docs = [(1, "der die das und"), (2, "the and of to"), (3, None)] * 3
    rows = [(d, t, {1: "de", 2: "en"}.get(d), None, None) for d, t in docs]
    model = language.fit(spark.createDataFrame(rows, SCHEMA))
    odd = [(1, None), (2, ""), (3, "123 !?"), (4, "und die"), (4, "of the"), (None, "日本"), (7, "the " * 30000)]
    found = [(r.doc_id, r.lang_pred) for r in language.identify(frame(spark, odd, clashing=True), model).collect()]
    assert found[:5] == [(1, "und"), (2, "und"), (3, "und"), (4, "de"), (4, "en")]
    assert found[6] == (7, "en") and found[5][1] in ("de", "en")
    none = language.fit(frame(spark, []))
    assert [r.lang_pred for r in language.identify(frame(spark, odd), none).collect()] == ["und"] * 7
    assert language.identify(frame(spark, []), model).count() == 0


def test_quality_of_documents_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_model(spark, SF, docs)
    found = quality.scores(docs, model).join(labels, "doc_id").filter(remainder(5) == 0)
    right = found.agg(F.avg(((F.col("score") >= 0.3) == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right > 0.95


def test_quality_of_odd_texts(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    odd = frame(spark, [(1, None), (2, ""), (2, ""), (None, "x"), (4, "word " * 100000)], clashing=True)
    found = quality.scores(odd, model).collect()
    assert [r.doc_id for r in found] == [1, 2, 2, None, 4] and all(0 <= r.score <= 1 for r in found)
    assert quality.keep_good(odd, model).columns == odd.columns
    assert quality.keep_good(odd, model, least=0).count() == 5
    assert quality.keep_good(odd, model, least=2).count() == 0
    text = spark.createDataFrame([(1, "a", "many")], "doc_id int, text string, n_chars string")
    assert quality.scores(text, model).count() == 1
    none = quality.fit(docs, labels.limit(0))
    assert none is None and [r.score for r in quality.scores(odd, none).collect()] == [1.0] * 5
    assert quality.scores(frame(spark, []), model).count() == 0


def test_pair_terms_are_those_of_all_pairs():
    import numpy as np

    pick = np.random.default_rng(1)
    fm = quality.FactorisationMachine(np.zeros((0, 0)), 0.3, pick.normal(size=20), pick.normal(size=(20, 3)))
    slots, values = pick.integers(0, 20, 9), pick.normal(size=9)
    raw = fm.forward(slots, values, np.array([0, 4]))[0]
    for score, own in zip(raw, (slice(0, 4), slice(4, 9))):
        s, x = slots[own], values[own]
        pairs = sum(
            fm.v[s[i]] @ fm.v[s[j]] * x[i] * x[j] for i in range(len(s)) for j in range(i)
        )
        assert abs(score - (0.3 + fm.w[s] @ x + pairs)) < 1e-9


