"""Quality rules: plain rules on words and lines, then a log-likelihood ratio of hashed n-grams.

Words and pairs of neighbouring words fall into buckets by a hash. Two multinomials over the
buckets, one of the trusted documents and one of the whole corpus, give each bucket a log ratio.
Both are smoothed at the size of the trusted part, so buckets of which it could not have shown
anything count as equal, and scores mean the same for small and large corpora. A document's score is the mean over its n-grams, and a fixed threshold decides. Ratios are whole
numbers of millionths, so a score does not depend on the order of its sum. All of it is DataFrame
functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.llm.shared import columns, written

_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOLS = "[#*$%&|<>]"
#: Up to so many repeated hashes of a text, each window is looked up among them.
_FEW = 32
#: Log ratios are kept as whole multiples of one in so many.
UNIT = 1_000_000


def words_of(text: Column) -> Column:
    """Runs of other characters than ASCII white space, in order."""
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def buckets_of(words: Column, buckets: int) -> Column:
    """The bucket of each word, and then of each pair of neighbours."""
    places = F.lit(buckets)
    single = F.transform(words, lambda w: F.pmod(F.xxhash64(w), places).cast("int"))
    seconds = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    pairs = F.transform(
        seconds,
        lambda w, i: F.pmod(F.xxhash64(F.get(words, i), w), places).cast("int"),
    )
    return F.concat(single, pairs)


def log_ratios(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    quality: str = "quality",
    *,
    buckets: int = 1 << 16,
    pseudo: float = 4.0,
) -> list[int]:
    """For each bucket, its log ratio between trusted documents and all, in ``UNIT``-ths.

    A document is trusted if all its labels say 1. Counts are over all documents; those of the
    corpus are scaled to the total of the trusted, and ``pseudo`` is added to each of both. One number for each bucket comes to the driver, so the list's size is a parameter's. Without
    any trusted n-gram all ratios are 0.
    """
    rows = columns(docs, key=key, text=text).where("text IS NOT NULL")
    trusted = (
        columns(labels, key=key, quality=quality)
        .groupBy("key")
        .agg((F.min("quality") == 1).alias("trusted"))
        .where("trusted")
    )
    # The join does not depend on the number of labels: both sides are sent by key.
    told = rows.join(trusted.hint("merge"), "key", "left").select(
        words_of(F.col("text")).alias("words"), F.coalesce("trusted", F.lit(False)).alias("trusted")
    )
    counts = (
        told.select(F.explode(buckets_of(F.col("words"), buckets)).alias("bucket"), "trusted")
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count_if("trusted").alias("target"))
    )
    counts = written(counts)
    raw, target = counts.agg(F.sum("raw"), F.sum("target")).first()
    ratios = [0] * buckets
    if not target:
        return ratios
    scaled = F.col("raw") * F.lit(float(target)) / F.lit(float(raw))
    ratio = F.round(F.log((F.col("target") + pseudo) / (scaled + pseudo)) * UNIT).cast("long")
    for bucket, value in counts.select("bucket", ratio).collect():
        ratios[bucket] = value
    return ratios


def _rules(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``body``, no null) with ``words`` and the counts of the plain rules.

    Each step names what the next ones use several times, so that Spark computes it once.
    """
    words, windows = F.col("words"), F.col("windows")
    n = F.size(words)
    none = F.array().cast("array<int>")
    begins = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(none)
    hashes, twins = F.col("hashes"), F.col("twins")
    hashed = F.transform(
        begins, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    )
    ordered = F.col("ordered")
    # Equal windows have equal hashes, so only the windows of a hash that occurs twice are compared.
    candidates = (
        F.when(F.size(twins) == 0, none)
        .when(F.size(twins) <= _FEW, F.filter(begins, lambda i: F.array_contains(twins, F.get(hashes, i))))
        .otherwise(begins)
    )
    window = lambda i: F.struct(
        F.get(words, i).alias("a"), F.get(words, i + 1).alias("b"), F.get(words, i + 2).alias("c"), i.alias("at")
    )

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

    twice = F.filter(
        windows,
        lambda x, i: same(x, F.get(windows, i - 1)) | same(x, F.get(windows, i + 1)),
    )
    starts = F.col("starts")
    # A window covers three words, less those that the one before has covered.
    fresh = F.transform(starts, lambda s, i: F.least(F.lit(3), s - F.get(starts, i - 1)))
    lines = F.filter(F.split("body", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return (
        rows.withColumn("words", words_of(F.col("body")))
        .withColumn("hashes", hashed)
        .withColumn("ordered", F.sort_array(hashes))
        .withColumn(
            "twins",
            F.array_distinct(F.filter(ordered, lambda h, i: (i > 0) & (h == F.get(ordered, i - 1)))),
        )
        .drop("ordered")
        .withColumn("begins", candidates)
        .drop("hashes", "twins")
        .withColumn("windows", F.sort_array(F.transform("begins", window)))
        .drop("begins")
        .withColumn("starts", F.sort_array(F.transform(twice, lambda x: x["at"])))
        .drop("windows")
        .withColumn("lines", lines)
        .withColumns(
            {
                "n_words": n.cast("long"),
                "word_chars": F.length(F.array_join("words", "")).cast("long"),
                "n_symbols": F.regexp_count("body", F.lit(_SYMBOLS)).cast("long"),
                "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
                "n_repeat_words": F.aggregate(fresh, F.lit(0), lambda a, x: a + x).cast("long"),
            }
        )
        .drop("lines", "starts")
    )


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    quality: str = "quality",
    *,
    buckets: int = 1 << 16,
    pseudo: float = 4.0,
    threshold: float = -0.1,
    least_words: int = 50,
    repeat_percent: int = 50,
) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    score`` of every row.

    A document fails the rules with fewer than ``least_words`` words, or if more than
    ``repeat_percent`` percent of them are in three-word windows that the text has twice. Of the
    others, those stay whose score, the mean log ratio of their n-grams in nats, is at least
    ``threshold``. ``labels`` holds ``key`` and ``quality``; a document with several labels is
    trusted if all are 1. If no document is trusted, the rules alone decide. A null text has no
    words; without words there is no score. Rows without key are judged as all others and are
    never trusted. Repeated rows are judged each, and count each.
    """
    ratios = log_ratios(docs, labels, text, key, quality, buckets=buckets, pseudo=pseudo)
    table = F.from_json(F.lit(str(ratios)), "array<bigint>")
    rows = columns(docs, doc_id=key, text=text).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("body")
    )

    def summed(ratio: Column) -> Column:
        found = buckets_of(F.col("words"), buckets)
        return F.aggregate(found, F.lit(0).cast("long"), lambda a, b: a + F.get(ratio, b))

    # Bound to a variable, the table is made once a row at most where Spark does not fold it.
    total = F.get(F.transform(F.array(table), summed), 0)
    grams = 2 * F.col("n_words") - 1
    failed = (F.col("n_words") < least_words) | (
        100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words")
    )
    judged = F.struct(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("total") >= F.lit(round(threshold * UNIT)) * grams)).alias("kept"),
        (F.col("total") / (grams * UNIT)).alias("score"),
    )
    # As the one row of a generator, the result is made once: a condition on it stays above, where
    # Spark would else write every step that leads to it into the condition, and into its loops.
    return (
        _rules(rows)
        .withColumn("total", F.when(F.col("n_words") > 0, total))
        .select("doc_id", F.explode(F.array(judged)).alias("judged"))
        .select("doc_id", "judged.*")
    )
