"""Exact top-k by inner product: Fagin's threshold algorithm over sorted lists per dimension.

Candidates are dealt to blocks, and each block keeps a sorted list per dimension. A query walks
down its lists, scores every row it meets, and stops when the sum of the list positions' values,
which no unseen row can exceed, is below its k-th score.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from insight.llm.shared import columns

_EXACT = 2**53


class SortedLists:
    """The rows of a block, sorted in each dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        largest = int(np.abs(vectors).max(initial=0))
        self.exact = vectors.shape[1] * largest
        self.integers = vectors
        self.vectors = vectors.astype("float64")
        self.order = np.argsort(vectors, axis=0, kind="stable").T
        self.values = np.sort(self.vectors, axis=0).T

    def top(self, query: np.ndarray, k: int, own: int | None, start: int = 32):
        """Row numbers of the k best, and their scores; ``own`` is an id that takes no part.

        Arithmetic is in floats while every sum is an integer that they hold, else in integers.
        """
        n, wide = len(self.ids), self.exact * int(np.abs(query).max(initial=0)) >= _EXACT
        rows = self.integers if wide else self.vectors
        query = query if wide else query.astype("float64")
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = self.ids == own
        found, scores = np.empty(0, "int64"), np.empty(0, rows.dtype)
        begin, depth = 0, min(n, start)
        while True:
            met = np.zeros(n, bool)
            met[self.order[down, begin:depth].ravel()] = True
            met[self.order[up, n - depth : n - begin].ravel()] = True
            if depth == n:
                met[:] = True
            fresh = np.flatnonzero(met & ~seen)
            seen[fresh] = True
            found = np.concatenate([found, fresh])
            scores = np.concatenate([scores, rows[fresh] @ query])
            if len(found) > k:
                best = np.lexsort((self.ids[found], -scores))[:k]
                found, scores = found[best], scores[best]
            if depth == n:
                break
            bound = (
                query[down] @ self.values[down, depth - 1] + query[up] @ self.values[up, n - depth]
            )
            if len(found) == k and bound < scores.min():
                break
            begin, depth = depth, min(n, depth * 2)
        best = np.lexsort((self.ids[found], -scores))
        return found[best], scores[best].astype("int64")


def _search(k: int):
    def search(frame: pd.DataFrame) -> pd.DataFrame:
        candidates, queries = frame[~frame["asks"]], frame[frame["asks"]]
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(candidates):
            lists = SortedLists(
                candidates["vec_id"].to_numpy(), np.stack(candidates["vector"].to_numpy())
            )
            for vec_id, vector in zip(queries["vec_id"], queries["vector"], strict=True):
                rows, scores = lists.top(np.asarray(vector), k, vec_id)
                out["query_id"].append(np.full(len(rows), vec_id))
                out["vec_id"].append(lists.ids[rows])
                out["score"].append(scores)
        return pd.DataFrame(
            {c: np.concatenate(v) if v else np.empty(0, "int64") for c, v in out.items()}
        )

    return search


def integer_vectors(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``vec_id`` and ``vector``, floor(scale * x) of each component x as a double.

    Leaves out rows with a null key, a null vector, or a null or non-finite component.
    """
    doubles = columns(df, vec_id=key, vector=vector).select(
        F.col("vec_id").cast("long"), F.col("vector").cast("array<double>")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return doubles.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite).select(
        "vec_id", F.transform("vector", lambda x: F.floor(x * float(scale))).alias("vector")
    )


def top_k(
    candidates: DataFrame,
    queries: DataFrame,
    k: int = 10,
    *,
    block: int = 4096,
    query_block: int = 1024,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of each query, exactly.

    Both inputs have ``vec_id`` and ``vector`` (array<long>). A query meets every candidate of
    its own length of vector but those with its own id. Equal scores go to the smaller id;
    repeated candidates count each, repeated queries once; fewer than k candidates give all. A
    task holds one block of candidates, its lists and one block of queries.
    """
    sized = [
        df.withColumn("size", F.size("vector")) for df in (candidates, queries.dropDuplicates(["vec_id"]))
    ]
    n, q = (max(1, df.count()) for df in sized)
    blocks, query_blocks = -(-n // block), -(-q // query_block)
    deal = lambda parts: F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    met = (
        sized[0]
        .select("vec_id", "vector", "size", deal(blocks).alias("b"), every(query_blocks).alias("q"))
        .withColumn("asks", F.lit(False))
        .unionByName(
            sized[1]
            .select("vec_id", "vector", "size", deal(query_blocks).alias("q"), every(blocks).alias("b"))
            .withColumn("asks", F.lit(True))
        )
    )
    partial = met.groupBy("size", "b", "q").applyInPandas(
        _search(k), "query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        partial.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
