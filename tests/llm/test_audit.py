"""Divergence of sources against plain dictionaries, and skybands against their definition."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from insight.llm import audit, queries

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "text string, lang string, source string, term string, n int, part string"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=3, first=200):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").translate(LOWER))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        names = sorted(s for x, s in groups if x == lang)

        def smooth(c, kept=kept):
            size = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (size + len(kept)) for t in kept}

        of = {s: smooth(counts[lang, s]) for s in names}
        whole = smooth(sum((counts[lang, s] for s in names), Counter()))
        for s in names:
            pair = [(sum((of[s][t] - of[o][t]) ** 2 // of[o][t] for t in kept), o) for o in names if o != s]
            term = [
                ((of[s][t] - whole[t]) ** 2 // whole[t], t)
                for t in kept
                if counts[lang, s][t] and of[s][t] > whole[t]
            ]
            for part, found, most in (("pair", pair, None), ("term", term, first)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, r) for r, (v, i) in enumerate(found[:most], 1)]
    return sorted(out)


def odd_rows(seed=1, n=300):
    draw = random.Random(seed)
    words = ["Über", "über", "STRASSE", "straße", "İ", "a", "b", "zz", "日本", "x1y", "it's", " ", "A\x00b", "K"]
    rows = [
        (" ".join(draw.choices(words, range(1, len(words) + 1), k=draw.randrange(12))), draw.choice(["en", "de", None]),
         draw.choice(["one", "two", "three", "", None, "é", "z"]))
        for _ in range(n)
    ]
    rows += [rows[0]] * 3 + [(None, "en", "silent"), ("", "xx", "only"), ("unique", "xx", "other"), (None, None, None)]
    rows += [("tie one two", "t", s) for s in "ab" for _ in range(3)]
    return rows


def test_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "clash", 1, "p") for r in rows], SCHEMA)
    got = audit.divergence_audit(df).collect()
    assert sorted(map(tuple, got)) == brute(rows)


@pytest.mark.parametrize("together, salts, tile, first, merges", [(2, 3, 2, 4, (3, 2, 1)), (1, 1, 1, 1, (1,)), (3, 2, 5, 2, ())])
def test_blocks_and_merges_change_nothing(spark, together, salts, tile, first, merges):
    rows = odd_rows(2)
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    got = audit.divergence_audit(df, together=together, salts=salts, tile=tile, first=first, merges=merges)
    assert sorted(map(tuple, got.collect())) == brute(rows, first=first)


def test_no_rows_and_no_terms(spark):
    df = spark.createDataFrame([], "text string, lang string, source string")
    assert audit.divergence_audit(df).count() == 0
    df = spark.createDataFrame([("1 2", "en", "a"), (None, "en", "b")], "text string, lang string, source string")
    assert sorted(map(tuple, audit.divergence_audit(df).collect())) == [
        ("en", "a", "pair", "b", 0, 1),
        ("en", "b", "pair", "a", 0, 1),
    ]


def test_blocks_of_a_text_end_with_a_term(monkeypatch):
    text = "Ab cd, éfg " * 50 + "x" * 100
    whole = [t.encode() for t in TERM.findall(text.translate(LOWER))]
    for block in (1, 2, 3, 7, 64, 10_000):
        monkeypatch.setattr(audit, "_BLOCK", block)
        assert [t for part in audit.terms_of(text) for t in part] == whole


def test_skyband_is_what_fewer_than_k_dominate():
    draw = random.Random(3)
    rows = sorted(
        (key, f"{i:04}", draw.randrange(8), draw.randrange(8, 16)) for key in "ab" for i in range(400)
    )
    batch = pa.RecordBatch.from_pydict(
        {c: [r[i] for r in rows] for i, c in enumerate(("key", "term", "n", "total"))}
    )
    parts = [batch.slice(0, 130), batch.slice(130, 1), batch.slice(131)]
    for k in (1, 3, 20):
        got = [tuple(r.values()) for b in audit.skyband(1, k, block=16)(parts) for r in b.to_pylist()]
        want = [
            x for x in rows
            if sum(y[0] == x[0] and y[1] < x[1] and y[2] >= x[2] and y[3] <= x[3] for y in rows) < k
        ]
        assert got == want
        assert len(got) < len(rows)


def test_large_counts_are_exact(spark):
    big = 9 * 10**13 - 1
    df = spark.createDataFrame([(big, big + 7, 5), (0, 1, 1), (12345678901234, 3 * 10**13, 99)], "n long, t long, k long")
    got = df.select("n", "t", "k", audit.smoothed(df.n, df.t, df.k).alias("p")).collect()
    assert all(r.p == 1 + 10**9 * (r.n + 1) // (r.t + r.k) for r in got)


def test_the_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("text", "lang", "source").collect()
    assert sorted(map(tuple, queries.op12_audit(spark, FOLDER).collect())) == brute(docs)
