"""Near-duplicate documents by MinHash with tensored banding.

Two small collections of sub-keys, each of a few minhashes, make the keys of all tables: table
(i, j) has the pair of the first collection's i-th and the second's j-th sub-key. So m + m
sub-keys serve m * m tables. Candidates of the tables are verified on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from insight.llm.components import components
from insight.llm.shared import columns, text_slices, written

_MASK = (1 << 64) - 1
#: Words whose hashes one Python worker remembers.
_REMEMBERED = 150_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _constants(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, _MASK, n, dtype="uint64") | np.uint64(1)


def word_hashes(text: str, hashes: dict) -> np.ndarray:
    """64-bit hashes of the text's words in order; A-Z count as a-z."""
    words = text.encode().lower().split()
    return np.fromiter(map(hashes.__getitem__, words), "uint64", len(words))


def shingle_set(text: str | None, width: int, hashes: dict) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles. A text of fewer words is one shingle, one
    without words has none."""
    words = word_hashes(text or "", hashes)
    if not len(words):
        return words
    n = max(1, len(words) - width + 1)
    total = np.full(n, np.uint64(min(len(words), width)))
    for i, factor in enumerate(_constants(11, width)[: len(words)]):
        total = _mixed(total + words[i : i + n] * factor)
    return np.unique(total)


class TensoredBands:
    """Two collections of ``halves`` sub-keys of ``rows`` minhashes each."""

    def __init__(self, rows: int, halves: int):
        self.rows, self.halves = rows, halves
        n = 2 * halves * rows
        self.factors, self.shifts = _constants(12, n), _constants(13, n)

    def sub_keys(self, shingles: np.ndarray) -> np.ndarray:
        lows = np.full(len(self.factors), np.uint64(_MASK))
        for begin in range(0, len(shingles), 1024):  # bounded memory for long texts
            part = shingles[begin : begin + 1024]
            values = part[None, :] * self.factors[:, None] + self.shifts[:, None]
            np.minimum(lows, (values ^ (values >> np.uint64(31))).min(axis=1), out=lows)
        key = np.zeros(2 * self.halves, "uint64")
        for column in lows.reshape(-1, self.rows).T:
            key = _mixed(key + column)
        return key


def _signatures(rows: DataFrame, width: int, bands: TensoredBands) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]):
        hashes = _WordHashes()
        for batch in text_slices(batches, 1):
            sizes, high, low, keys = [], [], [], []
            for text in batch.column(1):
                shingles = shingle_set(text.as_py(), width, hashes)
                digest = xxhash.xxh3_128_intdigest(shingles.tobytes())
                sizes.append(len(shingles))
                high.append((digest >> 64) - (1 << 63))
                low.append((digest & _MASK) - (1 << 63))
                keys.append(bands.sub_keys(shingles).view("int64") if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(high, pa.int64()),
                    pa.array(low, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "high", "low", "keys"],
            )

    return rows.mapInArrow(sign, "doc_id long, n long, high long, low long, keys array<long>")


def _sets(rows: DataFrame, width: int) -> DataFrame:
    """``rep`` and ``shingles``, the full set as bytes."""

    def build(batches: Iterator[pa.RecordBatch]):
        hashes = _WordHashes()
        for batch in text_slices(batches, 1):
            sets = [shingle_set(t.as_py(), width, hashes).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.binary())], names=["rep", "shingles"]
            )

    return rows.mapInArrow(build, "rep long, shingles binary")


def _verified(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets ``left`` and ``right`` are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]):
        for batch in text_slices(batches, 2):
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), "uint64") for v in (x, y))
                both = len(x) + len(y) - len(np.union1d(x, y))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(
                pa.array(good, pa.bool_())
            )

    return pairs.select("a", "b", "left", "right").mapInArrow(verify, "a long, b long")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of every left with every right set, as a matrix.

    Frequent shingles are counted by products of 0/1 matrices, slice by slice; the others by
    their few pairs.
    """
    n, m = len(left), len(right)
    counts = np.zeros((n, m), "float32")
    if not n or not m:
        return counts
    _, code = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    who = np.repeat(np.arange(n + m), [len(s) for s in (*left, *right)])
    often = np.bincount(code)[code]
    order = np.argsort(code, kind="stable")
    order = order[often[order] > 1]
    frequent = order[often[order] > 32]
    names, column = np.unique(code[frequent], return_inverse=True)
    for begin in range(0, len(names), 2048):
        chosen = (column >= begin) & (column < begin + 2048)
        matrix = np.zeros((n + m, min(2048, len(names) - begin)), "float32")
        matrix[who[frequent[chosen]], column[chosen] - begin] = 1
        counts += matrix[:n] @ matrix[n:].T
    rare = order[often[order] <= 32]
    for step in range(1, 32):  # the step-th next holder of the same shingle
        if step >= len(rare):
            break
        same = np.flatnonzero(code[rare[step:]] == code[rare[:-step]])
        if not len(same):
            break
        a, b = who[rare[same]], who[rare[same + step]]
        cross = (a < n) & (b >= n)
        np.add.at(counts, (a[cross], b[cross] - n), 1)
    return counts


def _compare(percent: int):
    """Links between different components of a block of rows, or of two blocks; one for each
    pair of components."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        sides = [frame[frame["side"] == s] for s in (0, 1)]
        if not len(sides[1]):
            sides[1] = sides[0]
        sets = [[np.frombuffer(s, "uint64") for s in side["shingles"]] for side in sides]
        sizes = [np.array([len(s) for s in x], "float64") for x in sets]
        both = overlaps(*sets).astype("float64")
        union = sizes[0][:, None] + sizes[1][None, :] - both if both.size else both
        comps = [side["component"].to_numpy() for side in sides]
        x, y = np.nonzero((100 * both >= percent * union) & (both > 0))
        apart = comps[0][x] != comps[1][y] if len(x) else np.empty(0, bool)
        x, y = x[apart], y[apart]
        out = pd.DataFrame({"a": comps[0][x], "b": comps[1][y]}, dtype="int64")
        return out.drop_duplicates()

    return compare


def _between(
    opened: DataFrame, groups: DataFrame, sets: DataFrame, percent: int, block: int
) -> DataFrame:
    """Links ``a, b`` between components, from comparing all rows of a group in blocks.

    ``opened``: ``rep, component``; ``groups``: ``rep, key``. A task holds two blocks of about
    ``block`` rows; only links leave it, never pairs.
    """
    members = written(groups.join(opened, "rep").select("rep", "component", "key"))
    counted = (
        members.groupBy("key")
        .agg(
            F.count("*").alias("n"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        .where("low < high")
        .select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    placed = (
        members.join(counted, "key")
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select(
            "rep",
            "component",
            "key",
            F.least("mine", "other").alias("p"),
            F.greatest("mine", "other").alias("q"),
            (F.col("mine") > F.col("other")).cast("int").alias("side"),
        )
    )
    return placed.join(sets, "rep").groupBy("key", "p", "q").applyInPandas(
        _compare(percent), "a long, b long"
    )


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    *,
    percent: int = 85,
    width: int = 5,
    rows: int = 3,
    halves: int = 14,
    block: int = 2048,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    A document is the set of its distinct ``width``-word shingles, A-Z lowered, words apart by
    ASCII white space; two are linked if their sets have a Jaccard similarity of at least
    ``percent`` hundredths. ``component_id`` is the smallest key that a row reaches by links.
    The tables miss a pair at exactly 0.85 with a probability of about
    2 (1 - 0.85^rows)^halves = 3e-6 by default, more similar ones less; every link is confirmed
    on the full sets.

    Equal sets are one class from the start. In each bucket of a table, all classes are first
    compared with the smallest one. Where a bucket still holds several components, its classes
    are then compared in blocks with all that share a sub-key, so no link within a bucket is
    lost, however large it is.

    A null or empty text has no shingles, is linked with nothing and kept. A row without key is
    linked with nothing, has a null ``component_id`` and is kept. Repeated rows are linked, and
    all rows with the smallest key of a component are kept. No rows give none.
    """
    bands = TensoredBands(rows, halves)
    base = columns(docs, doc_id=key, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = written(_signatures(base, width, bands))
    usable = signed.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = written(
        usable.groupBy("high", "low", "n").agg(
            F.min(F.struct("doc_id", "keys")).alias("first"), F.max("doc_id").alias("last")
        )
    )
    reps = classes.select(
        F.col("first.doc_id").alias("rep"), "n", F.col("first.keys").alias("keys")
    )
    sub = reps.select("rep", "n", F.posexplode("keys").alias("at", "sub"))
    common = sub.groupBy("at", "sub").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    alive = sub.join(common, ["at", "sub"], "left_semi")
    halved = written(
        alive.groupBy("rep", "n").agg(
            F.collect_list(F.when(F.col("at") < halves, F.struct("at", "sub"))).alias("u"),
            F.collect_list(F.when(F.col("at") >= halves, F.struct("at", "sub"))).alias("v"),
        )
    )
    keys = written(
        halved.select("rep", "n", F.explode("u").alias("u"), "v")
        .select("rep", "n", "u", F.explode("v").alias("v"))
        .select("rep", "n", F.xxhash64("u.at", "u.sub", "v.at", "v.sub").alias("key"))
    )
    buckets = (
        keys.groupBy("key")
        .agg(F.min(F.struct("rep", "n")).alias("first"), F.count("*").alias("c"))
        .where("c > 1")
    )
    shared = written(keys.join(buckets, "key").select("key", "rep", "n", "first"))
    near = 100 * F.least("n", "first.n") >= percent * F.greatest("n", "first.n")
    pairs = (
        shared.where((F.col("rep") != F.col("first.rep")) & near)
        .select(F.col("first.rep").alias("a"), F.col("rep").alias("b"))
        .distinct()
    )
    # Sets are built again, and kept, for the classes that share a bucket with another only.
    wanted = shared.select("rep").distinct()
    sets = written(
        _sets(
            base.join(wanted, F.col("doc_id") == F.col("rep"))
            .select("rep", "text")
            .dropDuplicates(["rep"]),
            width,
        )
    )
    sided = lambda name, at: sets.select(F.col("rep").alias(at), F.col("shingles").alias(name))
    links = written(
        _verified(pairs.join(sided("left", "a"), "a").join(sided("right", "b"), "b"), percent)
    )
    first = components(links)

    in_first = shared.join(first, F.col("rep") == F.col("node"), "left").select(
        "rep", "key", F.coalesce("component", "rep").alias("component")
    )
    several = (
        in_first.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
    )
    opened = written(
        in_first.join(several, "key", "left_semi").select("rep", "component").distinct()
    )
    groups = halved.select("rep", F.explode("u").alias("u")).select(
        "rep", F.xxhash64("u.at", "u.sub").alias("key")
    )
    more = components(_between(opened, groups, sets, percent, block))  # of first components
    final = (
        first.select("node", "component")
        .unionByName(more.select("node", F.col("node").alias("component")))
        .groupBy("node")
        .agg(F.min("component").alias("via"))
        .join(more.withColumnRenamed("node", "via"), "via", "left")
        .select("node", F.coalesce("component", "via").alias("component"))
    )

    known = (
        classes.join(final, F.col("first.doc_id") == F.col("node"), "left")
        .withColumn("component", F.coalesce("component", "first.doc_id"))
        .where((F.col("component") != F.col("first.doc_id")) | (F.col("first.doc_id") < F.col("last")))
        .select("high", "low", "n", "component")
    )
    known = written(known)
    return signed.join(known, ["high", "low", "n"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias(
            "component_id"
        ),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"),
    )
