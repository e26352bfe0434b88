"""Preparation: cleaning, train/test splits, standardisation, feature vectors."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from insight.functions import Range, all_of, hash_bucket, ident, named, present
from insight.operators.moments import MOMENTS, moment, with_moments

TRAIN, TEST = "train", "test"


def clean(
    df: DataFrame,
    columns: Sequence[str],
    rules: Iterable[Range] = (),
    require: Sequence[str] = (),
) -> DataFrame:
    """``columns`` of the rows in which each of them is present and every rule holds.

    Null and NaN both count as absent. ``require`` names columns that must be present but
    are not kept, such as the inputs of a derived column: a condition on the derived value
    does not reach the Parquet reader, one on its inputs does.
    """
    kept = [present(df.schema[c]) for c in dict.fromkeys([*columns, *require])]
    bounds = [rule.condition() for rule in rules]
    return df.where(all_of(kept + bounds)).select(*map(ident, columns))


def split_hash(
    df: DataFrame,
    keys: Sequence[str],
    train_pct: int = 80,
    algorithm: str = "md5",
    column: str = "split",
) -> DataFrame:
    """Mark each row ``train`` or ``test`` by a hash of its keys.

    A projection: no shuffle, no sort, and the same answer for any file layout, any
    partitioning and any recomputation after a lost executor. Rows with equal keys stay
    together, so choose keys that tell rows apart: with a third of all rows under one key
    the shares follow that key.
    """
    if not 0 <= train_pct <= 100:
        raise ValueError("train_pct must lie between 0 and 100")
    bucket = hash_bucket(keys, algorithm)
    return df.withColumn(column, F.when(bucket < train_pct, TRAIN).otherwise(TEST))


def split_random(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42
) -> list[DataFrame]:
    """One DataFrame per weight, drawn row by row.

    Repeatable for one layout of the input only: other files or partitions give another
    draw. It sorts every partition by all columns once per part; ``split_hash`` does not.
    """
    return df.randomSplit([float(w) for w in weights], seed=seed)


def part(df: DataFrame, which: str, column: str = "split") -> DataFrame:
    """The rows of one side of a split, without the marker column."""
    return df.where(named(column) == which).drop(column)


def split_sizes(df: DataFrame, column: str = "split") -> DataFrame:
    """``(split, rows)`` for all sides in one pass."""
    return (
        df.groupBy(named(column).alias("split"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy("split")
    )


def standardize(
    df: DataFrame,
    columns: Sequence[str],
    baseline: DataFrame | None = None,
    stats: DataFrame | None = None,
    suffix: str = "_scaled",
) -> DataFrame:
    """Add ``<column><suffix>``: mean 0 and sample standard deviation 1 over the baseline.

    A constant column becomes 0.0. The baseline is ``df`` itself by default; ``stats`` takes
    its ``zscore_stats`` where these are at hand.
    """
    scaled = {}
    for i, c in enumerate(columns):
        mean, std = moment(i, "mean"), moment(i, "std")
        scaled[c + suffix] = F.expr(
            f"CASE WHEN {ident(c)} IS NULL THEN NULL WHEN coalesce({std}, 0D) = 0D THEN 0D "
            f"ELSE try_divide({ident(c)} - {mean}, {std}) END"
        )
    return with_moments(df, columns, baseline, stats).withColumns(scaled).drop(MOMENTS)


def assemble(
    df: DataFrame, features: Sequence[str], out: str = "features", invalid: str = "error"
) -> DataFrame:
    """Add a vector column. ``invalid`` says what a null or NaN does: error, skip or keep."""
    assembler = VectorAssembler(
        inputCols=list(features), outputCol=out, handleInvalid=invalid
    )
    return assembler.transform(df)
