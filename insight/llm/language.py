"""Language identification: known words first, then shorter and shorter character n-grams.

A word seen in training scores each language by its log frequency there. An unseen word falls
back to its character n-grams of the longest order of which any is known. The text's score is
the sum over its words.
"""

from __future__ import annotations

import math
import re
import uuid
from array import array
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass
from functools import reduce
from operator import mul

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from insight.llm.shared import columns, kept_in_stage, text_slices

UNKNOWN = "und"
_WORDS = re.compile(r"[^\W\d_]+")
#: Scored words that one Python worker remembers.
_REMEMBERED = 50_000
#: Places of keys by their hash; a sample is those before a place.
_PLACES = 1 << 40


def _hash(unit: str) -> int:
    """As Spark's ``xxhash64`` of the string, unsigned."""
    return xxhash.xxh64_intdigest(unit.encode(), 42)


@dataclass(frozen=True)
class Frequencies:
    """One log frequency for each language, by unit.

    Held in arrays: the units' hashes in order, where each begins, and the languages that have it
    with its log frequency there. ``absent``, for all other languages, and ``totals`` are by
    language; by length of unit, or at 0.
    """

    hashes: array
    begins: array
    langs: array
    logs: array
    absent: dict[int, tuple[float, ...]]
    totals: dict[int, tuple[int, ...]]

    def __len__(self) -> int:
        return len(self.hashes)

    def get(self, unit: str) -> tuple[float, ...] | None:
        h = _hash(unit)
        at = bisect_left(self.hashes, h)
        if at == len(self.hashes) or self.hashes[at] != h:
            return None
        found = list(self.absent[0 if 0 in self.absent else len(unit)])
        for i in range(self.begins[at], self.begins[at + 1]):
            found[self.langs[i]] = self.logs[i]
        return tuple(found)

    def __contains__(self, unit: str) -> bool:
        return self.get(unit) is not None

    def __getitem__(self, unit: str) -> tuple[float, ...]:
        if (found := self.get(unit)) is None:
            raise KeyError(unit)
        return found


@dataclass(frozen=True)
class LanguageModel:
    """``words`` and ``grams`` hold one log frequency for each of ``languages``."""

    languages: tuple[str, ...]
    words: Frequencies
    grams: Frequencies
    orders: tuple[int, ...]


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    return _WORDS.findall(text.lower())


def _word_counts(batches):
    for batch in text_slices(batches, 1):
        counts: Counter = Counter()
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for word, n in Counter(words_of(text)).items():
                counts[lang, word] += n
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([k[0] for k in counts], pa.string()),
                "word": pa.array([k[1] for k in counts], pa.string()),
                "n": pa.array(counts.values(), pa.int64()),
            }
        )


def _kept(counts: DataFrame, unit: str, keep: int | None) -> DataFrame:
    """All counts, or those that any language has of the ``keep`` most frequent of each."""
    if keep is None:
        return counts
    by = Window.partitionBy("lang").orderBy(F.desc("n"), unit)
    top = counts.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= keep)
    return counts.join(top.select(unit).distinct(), unit, "left_semi")


def _frequencies(
    counts: DataFrame, unit: str, languages: tuple[str, ...], totals: dict[int, tuple[int, ...]]
) -> Frequencies:
    length = F.lit(0) if 0 in totals else F.length(unit)
    rows = counts.select(F.xxhash64(unit).alias("hash"), length.alias("length"), "lang", "n").toArrow()
    hashes = rows["hash"].to_numpy().view("uint64")
    order = np.argsort(hashes, kind="stable")
    units, begins = np.unique(hashes[order], return_index=True)
    langs = pc.index_in(rows["lang"], pa.array(languages, pa.string())).to_numpy().astype("int64")
    of_length = np.zeros((max(totals) + 1, len(languages)))
    for size, total in totals.items():
        of_length[size] = total
    logs = np.log((rows["n"].to_numpy() + 0.5) / (of_length[rows["length"].to_numpy(), langs] + 1.0))
    return Frequencies(
        array("Q", units.tobytes()),
        array("q", np.append(begins, len(order)).astype("int64").tobytes()),
        array("i", langs[order].astype("int32").tobytes()),
        array("d", logs[order].tobytes()),
        {size: tuple(math.log(0.5 / (t + 1.0)) for t in total) for size, total in totals.items()},
        totals,
    )


def _share(sizes, most: int) -> float:
    """The largest number such that, of each size, so many at most are ``most`` together."""
    left = float(most)
    for i, n in enumerate(sorted(sizes)):
        if n * (len(sizes) - i) > left:
            return left / (len(sizes) - i)
        left -= n
    return math.inf


def fit_languages(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    *,
    max_docs: int = 20_000,
    max_words: int | None = None,
    max_grams: int | None = None,
    orders: tuple[int, ...] = (4, 3, 2, 1),
) -> LanguageModel:
    """Word and n-gram log frequencies by language.

    Fits on the labelled rows with a text; of more than ``max_docs``, a sample of about that
    many, chosen by a hash of ``key``: all rows of languages below an equal share, and of the
    others what is left, in equal parts. The model keeps every word and n-gram of these, or, if
    asked, those that are among the ``max_words`` words or, of each order, ``max_grams`` n-grams
    most frequent in any language, with their counts in all. Units are known by 64-bit hashes.
    Rows without label or text teach nothing; without any labelled row the model knows no
    language.
    """
    known = columns(docs, key=key, text=text, lang=lang).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    sizes = dict(known.groupBy("lang").count().collect())
    each = _share(sizes.values(), max_docs)
    limits = docs.sparkSession.createDataFrame(
        [(name, int(min(1.0, each / n) * _PLACES)) for name, n in sizes.items()],
        "lang string, most long",
    )
    place = F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(_PLACES))
    sample = known.join(F.broadcast(limits), "lang").where(place < F.col("most"))
    counts = (
        sample.select("lang", "text")
        .mapInArrow(_word_counts, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
        .persist()
    )
    padded = F.concat(F.lit("_"), "word", F.lit("_"))
    grams = [
        counts.where(F.length(padded) >= order)
        .select("lang", "n", padded.alias("p"))
        .select(
            "lang",
            "n",
            F.explode(F.expr(f"sequence(1, length(p) - {order - 1})")).alias("at"),
            "p",
        )
        .groupBy("lang", F.expr(f"substring(p, at, {order})").alias("gram"))
        .agg(F.sum("n").alias("n"))
        for order in orders
    ]
    # A word has as many n-grams of an order as places for one.
    places = [F.sum(F.col("n") * F.greatest(F.length(padded) - order + 1, F.lit(0))) for order in orders]
    sums = sorted(counts.groupBy("lang").agg(F.sum("n"), *places).collect())
    languages = tuple(row[0] for row in sums)
    totals = {
        order: tuple(row[i] for row in sums) for i, order in enumerate((0, *orders), start=1)
    }
    words = _frequencies(_kept(counts, "word", max_words), "word", languages, {0: totals.pop(0)})
    all_grams = reduce(DataFrame.unionByName, [_kept(g, "gram", max_grams) for g in grams])
    gram_table = _frequencies(all_grams, "gram", languages, totals)
    counts.unpersist()
    return LanguageModel(languages, words, gram_table, orders)


def _score_word(model: LanguageModel, word: str, gram_of=None) -> tuple[float, ...]:
    if found := model.words.get(word):
        return found
    gram_of = gram_of or model.grams.get
    padded = f"_{word}_"
    for order in model.orders:
        found = (gram_of(padded[i : i + order]) for i in range(len(padded) - order + 1))
        if known := [x for x in found if x]:
            return tuple(sum(x) / len(known) for x in zip(*known, strict=True))
    return (0.0,) * len(model.languages)


class _Scorer(dict):
    """Scores of words, and of n-grams, remembered up to a bound."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.grams: dict = {}

    def gram(self, unit: str) -> tuple[float, ...] | None:
        try:
            return self.grams[unit]
        except KeyError:
            if len(self.grams) >= _REMEMBERED:
                self.grams.clear()
            self.grams[unit] = found = self.model.grams.get(unit)
            return found

    def __missing__(self, word: str) -> tuple[float, ...]:
        if len(self) >= _REMEMBERED:
            self.clear()
        self[word] = score = _score_word(self.model, word, self.gram)
        return score


def judge(text: str | None, model: LanguageModel, scores: dict | None = None) -> tuple[str, float]:
    """The language of one text and its posterior among the languages, from the mean word."""
    scores = _Scorer(model) if scores is None else scores
    words = Counter(words_of(text)) if text else None
    if not words or not model.languages or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0
    times = list(words.values())
    totals = [sum(map(mul, times, x)) for x in zip(*map(scores.__getitem__, words), strict=True)]
    best = max(range(len(totals)), key=lambda i: (totals[i], -i))
    mean = sum(words.values())
    rest = sum(math.exp((t - totals[best]) / mean) for t in totals)
    return model.languages[best], 1.0 / rest


def predict_language(
    docs: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep``, ``lang_pred`` and ``score`` for every row, from its whole text alone.

    Null texts and texts without a letter are ``und`` with score 0, as is every text if the
    model knows no language. Ties go to the language first in the alphabet. Repeated rows are
    judged each. The score is between 0 and 1: the languages' likelihoods of the mean word,
    as shares of their sum.
    """
    chosen = columns(docs, **{c: c for c in keep}, **{"_text": text})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = f"scores {uuid.uuid4().hex}"

    @F.arrow_udf("lang_pred string, score double")
    def judged(texts: pa.Array) -> pa.Array:
        scores = kept_in_stage(name, lambda: _Scorer(shared.value))
        found = [judge(t.as_py(), scores.model, scores) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            names=["lang_pred", "score"],
        )

    # Only the text goes to Python, and only the verdict comes back.
    return chosen.withColumn("_judged", judged("_text")).select(*keep, "_judged.*")
