"""Fill-in-the-middle against a unit-by-unit loop, and back."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from insight.llm import infill, queries

FOLDER = "/root/testdata/sf0.001"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "a <P> b"),
    (6, "x<S>"),
    (7, "<M>"),
    (8, "< P> <S <<<< >>> M>"),
    (9, " é  ü 日本 𝒳𝒴 end\n"),
    (10, "w " * 60_000),
    (11, "y" * 300_000 + " z"),
    (12, "a\x00b\x1c c\x85d"),
    (12, "a\x00b\x1c c\x85d"),
    (None, "no key here"),
    (-5, "a negative key of <P"),
]


def brute(doc, text):
    """One unit after the other, as the contract says it."""
    text = text or ""
    units, at = [], 0
    while at < len(text):
        m = UNIT.match(text, at)
        units.append(m.group())
        at = m.end()
    n = len(units)
    h = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return doc, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    x, y, z = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return doc, n, "spm", len(x), len(y), f"<S>{z}<P>{x}<M>{y}"
    return doc, n, "psm", len(x), len(y), f"<P>{x}<S>{z}<M>{y}"


def test_odd_texts_and_back(spark):
    rows = [(doc + 100 * i if doc else doc, text) for i in range(20) for doc, text in ODD]
    df = spark.createDataFrame(
        [(d, t, "x", 1, "y") for d, t in rows],
        "doc_id long, text string, output string, n int, form string",
    )
    made = infill.fill_in_middle(df)
    got = made.withColumn("back", infill.restore(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(r[:6]) for r in got), key=repr) == sorted(
        (brute(*r) for r in rows), key=repr
    )
    assert sorted((r.doc_id or 0, r.back) for r in got) == sorted((d or 0, t or "") for d, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \n\t\x0b\x1cab<PSM>é𝒳", max_size=60))
def test_the_match_ends_where_units_end(text):
    ends = infill.unit_ends(text)
    assert ends == [m.end() for m in UNIT.finditer(text)]
    assert not text or ends[-1] == len(text)


def test_other_sentinels_and_rates(spark):
    df = spark.createDataFrame([(i, f"to be {i} or not") for i in range(200)], "k long, t string")
    marks = ("<|p|>", "<|s|>", "<|m|>")
    made = infill.fill_in_middle(df, "t", "k", rate=100, spm_rate=0, sentinels=marks)
    back = made.select("doc_id", "form", infill.restore(F.col("output"), F.col("form"), marks).alias("t"))
    assert sorted((r.doc_id, r.form, r.t) for r in back.collect()) == [
        (i, "psm", f"to be {i} or not") for i in range(200)
    ]
    assert {r.form for r in infill.fill_in_middle(df, "t", "k", rate=0).collect()} == {"plain"}


@pytest.mark.parametrize("marks", [("a", "a", "b"), ("", "b", "c"), ("aba", "c", "d"), ("ab", "ba", "c"), ("abc", "b", "d")])
def test_sentinels_that_cannot_be_found_again(spark, marks):
    df = spark.createDataFrame([], "doc_id long, text string")
    with pytest.raises(ValueError):
        infill.fill_in_middle(df, sentinels=marks)


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert infill.fill_in_middle(df).count() == 0


def test_the_query_restores_every_document(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op11_infill(spark, FOLDER).collect()}
    assert len(got) == len(docs)
    for doc, text in docs:
        want = brute(doc, text)
        r = got[doc]
        assert tuple(r[1:5]) == want[1:5]
        assert r.output_sha256 == hashlib.sha256(want[5].encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_the_text_is_sent_to_python_once(spark, plan_of):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    made = infill.fill_in_middle(df)
    plan = plan_of(made.select(infill.restore(F.col("output"), F.col("form"))))
    assert len(re.findall(r"ArrowEvalPython \(\d+\)$", plan, re.M)) == 1
