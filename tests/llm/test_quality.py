"""Quality rules against plain Python, and what the score tells apart."""

import math
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from insight.llm import quality, queries

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    """The plain rules, position by position."""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = {}
    for w in windows:
        times[w] = times.get(w, 0) + 1
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    earlier, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in earlier
            earlier.add(line)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def grams(text, buckets):
    words = WORD.findall(text)
    first = [xxhash.xxh64_intdigest(w, 42) for w in words]
    pairs = [xxhash.xxh64_intdigest(w, h) for h, w in zip(first, words[1:])]
    signed = [h - (1 << 64) if h >> 63 else h for h in first + pairs]
    return [h % buckets for h in signed]


def brute(docs, labels, buckets=1 << 16, threshold=-100_000):
    """``docs``: (key, text); ``labels``: (key, quality)."""
    said = {}
    for key, value in labels:
        if value is not None:
            said[key] = min(value, said.get(key, 1))
    raw, target = [0] * buckets, [0] * buckets
    for key, text in docs:
        for b in grams(text or "", buckets):
            raw[b] += 1
            target[b] += key is not None and said.get(key) == 1
    ratio = [0] * buckets
    trusted, whole = sum(target), sum(raw)
    if trusted:
        ratio = [
            round(10**6 * math.log((t + 4) / (r * trusted / whole + 4))) for t, r in zip(target, raw)
        ]
    out = []
    for key, text in docs:
        rules = base(text or "")
        found = grams(text or "", buckets)
        total = sum(ratio[b] for b in found)
        out.append((key, *rules, not rules[-1] and total >= threshold * len(found),
                    round(total / len(found) / 1e6, 9) if found else None))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((*r[:8], None if r.score is None else round(r.score, 9)) for r in df.collect()), key=repr)


GOOD = " ".join(f"w{i % 37} v{i % 11}" for i in range(60))
ODD = [
    (1, None), (2, ""), (3, " \n "), (4, "one"), (5, "a b c"), (6, "a b a b a b a b"),
    (7, "a a a a a"), (8, "x\ny\nx\n\n \n x\nx"), (9, "#*$%&|<> é<é 日本|  "),
    (10, GOOD), (11, GOOD), (11, GOOD), (None, GOOD), (12, GOOD.replace(" ", "!! ")),
    (13, "rep " * 30_000), (14, "y" * 200_000 + " y"), (15, "\x00a \x1c b\x85c"),
    (16, " ".join(f"u{i}" for i in range(49))), (17, " ".join(f"u{i}" for i in range(50))),
    (19, f"{GOOD} {GOOD}"),
    (18, "aa b a ab " * 5 + " ".join(f"t{i}" for i in range(60))),
]
LABELS = [(10, 1), (11, 1), (11, 1), (12, 0), (13, 1), (13, 0), (None, 1), (99, 1), (18, None), (2, 1)]


@pytest.mark.parametrize("buckets", [1 << 16, 64, 1])
def test_odd_texts(spark, buckets):
    docs = spark.createDataFrame([(d, t, [1], "x") for d, t in ODD], "doc_id long, text string, words array<int>, body string")
    labels = spark.createDataFrame([(d, q, "t") for d, q in LABELS], "doc_id long, quality int, text string")
    got = quality.quality_rules(docs, labels, buckets=buckets)
    assert rows_of(got) == brute(ODD, LABELS, buckets)


def test_nobody_trusted(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    labels = spark.createDataFrame([(12, 0)], "doc_id long, quality int")
    got = quality.quality_rules(docs, labels).collect()
    assert all(r.kept != r.base_failed for r in got)
    assert len(got) == len(ODD)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.quality_rules(docs, labels).count() == 0


def test_the_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality").collect()]
    assert rows_of(queries.op13_quality(spark, FOLDER)) == brute(docs, labels)


def test_documents_without_label_are_told_apart(spark):
    """Hide the labels of every third document; the rest find junk and keep clean text."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    hidden = F.col("doc_id") % 3 == 0
    judged = quality.quality_rules(docs, labels.where(~hidden)).where("n_words >= 50 AND NOT base_failed")
    told = judged.join(labels.where(hidden), "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")))
    kept = dict(map(tuple, told.collect()))
    assert kept[1] >= 0.95
    assert kept.get(0, 0.0) <= 0.1


def test_no_python_in_the_plan(spark, plan_of):
    plan = plan_of(queries.op13_quality(spark, FOLDER))
    assert not re.search("Python|Arrow|Pandas|from_json", plan)
