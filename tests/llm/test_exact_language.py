"""Exact dedup, language identification and the pipeline."""

import hashlib
import math
import re
import zlib

import pytest

import corpus_pipeline
from insight.llm import exact, language, queries

FOLDER = "/root/testdata/sf0.001"
SMALL = [
    (4, "a  b"),
    (3, "a\t\nb"),
    (9, None),
    (8, ""),
    (7, " "),
    (6, "a b"),
    (6, "a b"),
    (None, "a b"),
    (None, "alone"),
    (1, "x" * 40 + " y"),
    (2, "x" * 40 + "  y"),
    (5, "x" * 41),
    (10, "é" * 33),
    (11, "é" * 33),
    (12, "ab" * 40),
    (13, "ba" * 40),
]


@pytest.mark.parametrize("block, buckets", [(4, 2**62), (4, 1), (3, 3), (4096, 2**62), (1, 2)])
def test_exact_names_never_collide(spark, block, buckets):
    df = spark.createDataFrame([(d, t, 1, "n") for d, t in SMALL], "doc_id long, text string, bucket int, names string")
    got = exact.dedup_exact(df, block=block, buckets=buckets).collect()
    bodies = [re.sub(r"[\x20\x09-\x0d]+", " ", t or "") for _, t in SMALL]
    want = []
    for (doc, _), body in zip(SMALL, bodies, strict=True):
        same = [d for (d, _), b in zip(SMALL, bodies, strict=True) if b == body]
        keep = min((d for d in same if d is not None), default=None)
        sha = hashlib.sha256(body.encode()).hexdigest()
        want.append((doc, keep, len(same), doc == keep, sha))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_exact_without_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert exact.dedup_exact(df).count() == 0


# ---------------------------------------------------------------- language

TAUGHT = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "fr"), (4, "le chat", None)]
SCHEMA = "doc_id long, text string, lang string"


def test_words_first_then_shorter_grams(spark):
    model = language.fit_languages(spark.createDataFrame(TAUGHT, SCHEMA))
    assert model.languages == ("de", "en")
    assert language._score_word(model, "the") == model.words["the"]
    known = [model.grams[g] for g in ("_the", "then") if g in model.grams]
    assert len(known) == 1
    assert language._score_word(model, "then") == pytest.approx(known[0])
    assert language._score_word(model, "q") == pytest.approx(model.grams["_"])
    assert language._score_word(model, "qq") == pytest.approx(model.grams["_"])


def test_odd_texts(spark):
    model = language.fit_languages(spark.createDataFrame(TAUGHT, SCHEMA))
    rows = [(1, None), (2, ""), (3, "12 !? _ ²"), (4, "the"), (None, "UND der"), (6, "the " * 50_000), (4, "the")]
    df = spark.createDataFrame([(d, t, "x", 0.5) for d, t in rows], "doc_id long, text string, lang_pred string, score double")
    got = {(r.doc_id): (r.lang_pred, r.score) for r in language.predict_language(df, model).collect()}
    assert [got[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert got[4][0] == got[6][0] == "en"
    assert got[None][0] == "de"
    assert all(0 <= s <= 1 for _, s in got.values())
    assert language.predict_language(df, model).count() == len(rows)


def test_a_model_that_was_taught_nothing(spark):
    model = language.fit_languages(spark.createDataFrame(TAUGHT[2:], SCHEMA))
    got = language.predict_language(spark.createDataFrame(TAUGHT, SCHEMA), model).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}


def test_the_sample_is_bounded(spark):
    rows = [(i, f"word{i % 7} common", "ab"[i % 2]) for i in range(3000)]
    model = language.fit_languages(spark.createDataFrame(rows, SCHEMA), max_docs=300, max_words=2)
    assert len(model.words) <= 4
    assert "common" in model.words


def test_every_word_and_gram_of_the_sample_is_known(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [f"{a}{b}{c}{d}" for a in letters for b in letters for c in letters for d in "xyz"][:25_000]
    rows = [(i, " ".join(words[i::50]), "en") for i in range(50)] + [(50, "der Hund", "de")]
    model = language.fit_languages(spark.createDataFrame(rows, SCHEMA))
    assert len(model.words) == len(words) + 2
    assert all(w in model.words for w in [*words, "der", "hund"])
    padded = [f"_{w}_" for w in [*words, "der", "hund"]]
    assert len(model.grams) == len({p[i : i + k] for p in padded for k in (1, 2, 3, 4) for i in range(len(p) - k + 1)})


def test_a_kept_word_has_its_count_in_every_language(spark):
    rows = [(1, "sun sun sun sea sea", "en"), (2, "sea sea sea sun sun", "it")]
    model = language.fit_languages(spark.createDataFrame(rows, SCHEMA), max_words=1, max_grams=1)
    assert model.words["sun"] == pytest.approx((math.log(3.5 / 6), math.log(2.5 / 6)))
    assert model.words["sea"] == pytest.approx((math.log(2.5 / 6), math.log(3.5 / 6)))


def test_the_sample_has_all_of_a_small_language(spark):
    rows = [(i, f"common w{chr(97 + i % 26)}x", "en") for i in range(3000)]
    rows += [(5000 + i, f"rare{chr(97 + i)}", "is") for i in range(20)]
    model = language.fit_languages(spark.createDataFrame(rows, SCHEMA), max_docs=300)
    assert all(f"rare{chr(97 + i)}" in model.words for i in range(20))
    assert 200 < model.words.totals[0][0] / 2 < 360
    assert [language._share(x, 30) for x in ((5, 40, 50), (10, 20), (40,))] == [12.5, math.inf, 30]


def test_accuracy_on_held_out_documents(spark):
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = queries.op9_language(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held)
    assert right >= 0.97 * len(held)


# ---------------------------------------------------------------- pipeline


def test_stages_keep_columns_and_clean_documents(spark):
    before = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs, texts = before, {r.doc_id: r.text for r in before.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
        rows = docs.collect()
        docs = spark.createDataFrame(rows, before.schema)
        assert len({r.doc_id for r in rows}) == len(rows)
        if name in ("language_id", "line_dedup"):
            assert {r.doc_id for r in rows} == {d for d, t in texts.items() if re.search(r"[^\W\d_]", t)}
        for r in rows:
            assert r.n_chars == len(r.text)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in rows}


def test_pipeline_of_odd_rows(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(120))
    rows = [
        (1, text, "en", "s", len(text)),
        (2, text, "en", None, len(text)),
        (3, "and " + text.replace("word7 ", "other "), None, "s", 7),
        (4, None, "en", "s", None),
        (5, "", None, None, 0),
        (6, "12 34", "en", "s", 5),
        (7, "quite another text", "en", "s", 18),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == [1, 7]
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
