"""From raw documents to packed sequences: the stages, and the whole.

Each stage takes the documents that the one before kept, and all but the last return their
columns: ``doc_id, text, lang, source, n_chars``, the last counting the text's characters anew.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from insight.llm import language, lines, near, packing, substrings
from insight.llm.shared import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
_OTHERS = ("lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents, with ``n_chars`` of a changed text."""
    count = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return df.withColumn("n_chars", count).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language that the labelled documents teach: those without text or
    without a letter. Rows without label are judged as all others."""
    model = language.fit_languages(docs)
    judged = language.predict_language(docs, model, keep=COLUMNS)
    return judged.where(F.col("lang_pred") != language.UNKNOWN).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines whose template recurs, but for the first document's; keeps every document."""
    return _documents(lines.drop_recurring_lines(docs, keep=_OTHERS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of near-duplicates at 0.8: the smallest ``doc_id``.

    Documents without words, of which line dedup leaves some, are no duplicates and stay.
    """
    found = near.near_duplicates(docs, percent=80, halves=18)
    gone = written(found.where(~F.col("kept")).select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops passages of 50 words that a document with a smaller ``doc_id`` has."""
    return _documents(substrings.remove_repeated_passages(docs, keep=_OTHERS))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: A fitted model, components, and packing have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
