"""Exact deduplication by deterministic block naming.

A text is cut into blocks of a fixed size. Each distinct block gets an integer name: the bucket
of its hash and its rank among the bucket's sorted blocks, so different blocks have different
names whatever the hash does. Adjacent names are then named in pairs, level by level, until one
name is left for each text. Two texts are equal if and only if length and name are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from insight.llm.shared import columns, written

_ROW = ("doc_id", "digest")


def one_space(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as the empty string."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _named(values: DataFrame, buckets: int) -> DataFrame:
    """``values`` with ``bucket`` and ``rank`` in place of ``value`` (binary).

    Buckets are compared by their smallest and largest value, which are found within each task
    before the shuffle; only where these differ are values sorted, and ranked from 1. All other
    buckets hold one value, whose rank is 1, so nothing is joined for them.
    """
    bucketed = values.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)))
    shared = written(
        bucketed.groupBy("bucket")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
        .where(F.col("low") < F.col("high"))
        .select("bucket")
    )
    order = Window.partitionBy("bucket").orderBy("value")
    ranked = written(
        bucketed.join(shared, "bucket", "left_semi")
        .select("bucket", "value")
        .distinct()
        .withColumn("rank", F.row_number().over(order))
    )
    return (
        bucketed.join(ranked, ["bucket", "value"], "left")
        .withColumn("rank", F.coalesce("rank", F.lit(1)))
        .drop("value")
    )


def _pairs(names: DataFrame) -> DataFrame:
    """``value``: two adjacent names as one binary; the last of an odd number stands alone."""
    width = F.expr("(size(names) + 1) div 2")
    part = lambda name: F.concat(
        F.lpad(F.hex(name["bucket"]), 16, "0"), F.lpad(F.hex(name["rank"]), 8, "0")
    )
    pair = lambda i: F.concat(
        part(F.get("names", 2 * i)), F.coalesce(part(F.get("names", 2 * i + 1)), F.lit(""))
    )
    values = F.transform(F.sequence(F.lit(0), (width - 1).cast("int")), lambda i: pair(i))
    return names.select(*_ROW, F.posexplode(values).alias("at", "value")).withColumn(
        "value", F.encode("value", "UTF-8")
    )


def _gathered(named: DataFrame) -> DataFrame:
    """One row per text with its names in order: integers only, two for each block."""
    return (
        named.groupBy(*_ROW)
        .agg(F.sort_array(F.collect_set(F.struct("at", "bucket", "rank"))).alias("names"))
        .withColumn("names", F.transform("names", lambda x: F.struct(x["bucket"], x["rank"])))
    )


def name_texts(texts: DataFrame, *, block: int = 4096, buckets: int = 2**62) -> DataFrame:
    """``doc_id, digest, bucket, rank`` for each distinct ``doc_id, digest`` of ``texts``, which
    also has ``body`` (binary): its name among the texts of its length.

    Levels run until the longest text has one name; each works on the texts that have more.
    """
    longest = texts.agg(F.max(F.length("body"))).first()[0] or 0
    width = max(1, -(-longest // block))
    starts = F.expr(f"sequence(0, greatest(int((length(body) - 1) div {block}), 0))")
    blocks = texts.select(*_ROW, "body", F.explode(starts).alias("at")).select(
        *_ROW, "at", F.expr(f"substring(body, at * {block} + 1, {block})").alias("value")
    )
    names = written(_gathered(_named(blocks, buckets)))
    done = []
    while True:
        done.append(
            names.where(F.size("names") == 1).select(*_ROW, F.col("names")[0].alias("name"))
        )
        if width == 1:
            break
        width = (width + 1) // 2
        several = names.where(F.size("names") > 1)
        names = written(_gathered(_named(_pairs(several), buckets)))
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result.select(*_ROW, "name.bucket", "name.rank")


def dedup_exact(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    *,
    block: int = 4096,
    buckets: int = 2**62,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row.

    Texts are equal if they are after each run of ASCII white space is one space; null counts as
    empty. ``keep_id`` is the smallest key of the equal texts, null if none has a key, and
    ``kept`` says whether it is the row's own: repeated rows with the smallest key are all kept.
    """
    rows = columns(docs, doc_id=key, text=text).select("doc_id", one_space(F.col("text")).alias("t"))
    texts = rows.select(
        "doc_id",
        F.unhex(F.sha2("t", 256)).alias("digest"),
        F.encode("t", "UTF-8").alias("body"),
    )
    names = name_texts(texts, block=block, buckets=buckets)
    sizes = texts.select(*_ROW, F.length("body").alias("bytes"))
    same = (sizes["doc_id"].eqNullSafe(names["doc_id"])) & (sizes["digest"] == names["digest"])
    named = written(
        sizes.join(names, same).select(sizes["doc_id"], sizes["digest"], "bytes", "bucket", "rank")
    )
    group = ("bytes", "bucket", "rank")
    groups = written(
        named.groupBy(*group)
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where(F.col("group_size") > 1)
    )
    found = named.join(groups, list(group), "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
