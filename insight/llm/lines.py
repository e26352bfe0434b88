"""Line deduplication by a tree of line templates.

A line's tokens, with runs of digits as one mark, lead down a tree of fixed depth: the number of
tokens, then its first tokens. Below a leaf, the tokens that recur at their position stay and the
others become wildcards, if enough stay; the result is the line's template. Lines whose template
is in several documents are dropped, but for those of the template's first document.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from insight.llm.shared import columns, text_slices, written

_DIGITS = re.compile(rb"[0-9]+")
_LINE = ("high", "low")


def masked_lines(text: str) -> list[list[bytes]]:
    """The tokens of each line, apart by ASCII white space, with digits as one mark."""
    return [line.split() for line in _DIGITS.sub(b"0", text.encode()).split(b"\n")]


def _name(tokens: list[bytes]) -> tuple[int, int]:
    digest = xxhash.xxh3_128_intdigest(b" ".join(tokens))
    return (digest >> 64) - (1 << 63), (digest & ((1 << 64) - 1)) - (1 << 63)


def _leaf(tokens: list[bytes], depth: int) -> int:
    start = b"%d %s" % (len(tokens), b" ".join(tokens[:depth]))
    return xxhash.xxh3_64_intdigest(start) - (1 << 63)


def _parsed(rows: DataFrame, depth: int) -> DataFrame:
    """``doc_id, high, low, leaf``: each document's distinct lines that have tokens."""

    def parse(batches):
        for batch in text_slices(batches, 1):
            ids, found = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                lines = {
                    (*_name(tokens), _leaf(tokens, depth))
                    for tokens in masked_lines(text.as_py())
                    if tokens
                }
                ids += [doc] * len(lines)
                found += lines
            values = np.array(found, "int64").reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(values[:, i]) for i in range(3))],
                names=["doc_id", "high", "low", "leaf"],
            )

    return rows.mapInArrow(parse, "doc_id long, high long, low long, leaf long")


def _tokens_of(rows: DataFrame, depth: int) -> DataFrame:
    """``high, low, leaf, tokens`` of the lines that ``rows`` names in ``wanted``."""

    def fetch(batches):
        for batch in text_slices(batches, 0):
            out: list[tuple] = []
            for text, wanted in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                names = {(w["high"], w["low"]) for w in wanted}
                for tokens in masked_lines(text.as_py()):
                    if tokens and (name := _name(tokens)) in names:
                        names.discard(name)
                        hashes = [xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in tokens]
                        out.append((*name, _leaf(tokens, depth), hashes))
            high, low, leaf, tokens = zip(*out, strict=True) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(c, pa.int64()) for c in (high, low, leaf)),
                    pa.array(tokens, pa.list_(pa.int64())),
                ],
                names=["high", "low", "leaf", "tokens"],
            )

    return rows.mapInArrow(fetch, "high long, low long, leaf long, tokens array<long>")


def smallest(rows: DataFrame, group: list[str], least: int) -> DataFrame:
    """``group, doc_id, nth``: of each group, its ``least`` smallest distinct documents.

    Such sets can be united: a group's is the smallest of its members' sets. A group is in
    ``least`` documents or more if its set is full, and a smaller set is whole. Each task sends on
    its own smallest documents only, so a group that is in all documents is small, too.
    """
    in_order = Window.partitionBy(*group).orderBy("doc_id")
    return (
        rows.select(*group, "doc_id")
        .withColumn("nth", F.dense_rank().over(in_order))
        .where(F.col("nth") <= least)
        .dropDuplicates([*group, "doc_id"])
    )


def recurring_lines(
    rows: DataFrame, parsed: DataFrame, *, depth: int, least: int, constant: float
) -> DataFrame:
    """``high, low, first``: lines whose template is in at least ``least`` documents, and the
    smallest of these. ``rows``: ``doc_id, text``; ``parsed``: their lines."""
    held = written(smallest(parsed, [*_LINE, "leaf"], least))
    lines = written(
        held.groupBy(*_LINE, "leaf").agg(F.max("nth").alias("docs"), F.min("doc_id").alias("first"))
    )
    # Only below leaves with several lines in enough documents can a wildcard matter.
    leaves = (
        lines.groupBy("leaf")
        .agg(F.count("*").alias("kinds"), F.sum("docs").alias("docs"))
        .where((F.col("kinds") > 1) & (F.col("docs") >= least))
        .select("leaf")
    )
    shared = written(lines.join(leaves, "leaf", "left_semi"))
    wanted = shared.groupBy(F.col("first").alias("doc_id")).agg(
        F.collect_list(F.struct(*_LINE)).alias("wanted")
    )
    # How texts are joined does not depend on the size of the other side: they are sent by key.
    tokens = written(
        _tokens_of(rows.join(wanted.hint("merge"), "doc_id").select("text", "wanted"), depth)
        .dropDuplicates(list(_LINE))
    )
    placed = tokens.select(
        *_LINE, "leaf", F.size("tokens").alias("size"), F.posexplode("tokens").alias("at", "token")
    )
    place = ["leaf", "at", "token"]
    members = held.join(shared.select(*_LINE), list(_LINE), "left_semi").drop("nth", "leaf")
    stable = (
        smallest(placed.join(members, list(_LINE)), place, least)
        .where(F.col("nth") == least)
        .select(*place)
    )
    # One list for each line: the tokens that stay. The rest of the template are wildcards.
    templates = written(
        placed.join(stable, place)
        .groupBy(*_LINE, "leaf", "size")
        .agg(F.sort_array(F.collect_list(F.struct("at", "token"))).alias("stays"))
        .where(F.size("stays") >= constant * F.col("size"))
        .select(
            *_LINE,
            F.xxhash64("leaf", "stays").alias("template"),
            F.sha1(F.to_json("stays")).alias("template2"),
        )
    )
    template = ["template", "template2"]
    known = (
        smallest(templates.join(members, list(_LINE)), template, least)
        .groupBy(*template)
        .agg(F.max("nth").alias("docs"), F.min("doc_id").alias("first"))
        .where(F.col("docs") >= least)
        .drop("docs")
    )
    return (
        lines.where(F.col("docs") >= least)
        .select(*_LINE, "first")
        .unionByName(templates.join(known, template).select(*_LINE, "first"))
        .groupBy(*_LINE)
        .agg(F.min("first").alias("first"))
    )


def drop_recurring_lines(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    keep: tuple[str, ...] = (),
    *,
    depth: int = 3,
    least: int = 3,
    constant: float = 0.7,
) -> DataFrame:
    """``doc_id``, ``keep``, ``text`` without the recurring lines, ``n_lines`` and ``n_removed``.

    A line recurs if its template is in at least ``least`` documents; the one with the smallest
    key keeps it. A template's tokens at their place in at least ``least`` documents stay, and
    at least ``constant`` of all must. Lines without tokens are never dropped. A null text stays
    null, with no lines; an empty one is one empty line. Rows without key neither count nor
    change; rows with one key count as one document. Every row is in the result.
    """
    base = columns(docs, doc_id=key, text=text, **{f"_{c}": c for c in keep}).withColumn(
        "doc_id", F.col("doc_id").cast("long")
    )
    rows = base.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    parsed = written(_parsed(rows, depth))
    known = written(
        recurring_lines(rows, parsed, depth=depth, least=least, constant=constant)
    )
    drops = (
        parsed.join(known, list(_LINE))
        .where(F.col("doc_id") != F.col("first"))
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct(*_LINE)).alias("drops"))
    )
    joined = base.join(drops.hint("merge"), "doc_id", "left").select(*base.columns, "drops")
    kept = len(base.columns)

    def drop(batches):
        for batch in text_slices(batches, 1):
            texts, before, removed = [], [], []
            for value, names in zip(batch.column(1), batch.column(kept).to_pylist(), strict=True):
                value = value.as_py()
                lines = [] if value is None else value.split("\n")
                stay = lines
                if names and lines:
                    gone = {(n["high"], n["low"]) for n in names}
                    stay = [
                        line
                        for line, tokens in zip(lines, masked_lines(value), strict=True)
                        if not tokens or _name(tokens) not in gone
                    ]
                texts.append(None if value is None else "\n".join(stay))
                before.append(len(lines))
                removed.append(len(lines) - len(stay))
            arrays = [
                batch.column(0),
                pa.array(texts, pa.string()),
                *batch.columns[2:kept],
                pa.array(before, pa.int64()),
                pa.array(removed, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=names_out)

    names_out = [*base.columns, "n_lines", "n_removed"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema)
    out = joined.mapInArrow(drop, f"{fields}, n_lines long, n_removed long")
    return out.select(
        "doc_id", *(F.col(f"`_{c}`").alias(c) for c in keep), "text", "n_lines", "n_removed"
    )
