"""Outliers by z-score.

Mean and standard deviation come from a baseline, usually the cleaned rows, and are applied
to any rows. Operators take the baseline, or the ``zscore_stats`` of it where these are at
hand already. Both scans read the chosen columns only, and nothing is shuffled but one
partial aggregate per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from insight.functions import any_of, ident, literal
from insight.operators.moments import MOMENTS, lookup, moment, with_moments, zscore_stats


def _zscore(i: int, column: str) -> str:
    """z of the i-th column; NULL where the standard deviation is 0 or unknown."""
    return f"try_divide({ident(column)} - {moment(i, 'mean')}, {moment(i, 'std')})"


def _verdict(zscores: Sequence[str], z: float) -> Column:
    """True if any |z| exceeds the threshold, false if none does, NULL if that is open.

    NaN lies above every threshold.
    """
    return F.expr(any_of(f"abs({score}) > {literal(float(z))}" for score in zscores))


def add_zscores(
    df: DataFrame,
    columns: Sequence[str],
    baseline: DataFrame | None = None,
    stats: DataFrame | None = None,
    suffix: str = "_z",
) -> DataFrame:
    """Add ``<column><suffix>`` to every row; ``baseline`` is ``df`` itself by default."""
    scores = {c + suffix: F.expr(_zscore(i, c)) for i, c in enumerate(columns)}
    return with_moments(df, columns, baseline, stats).withColumns(scores).drop(MOMENTS)


def flag_outliers(
    df: DataFrame,
    columns: Sequence[str],
    z: float = 3.0,
    baseline: DataFrame | None = None,
    stats: DataFrame | None = None,
    suffix: str = "_z",
    flag: str = "is_outlier",
) -> DataFrame:
    """``add_zscores`` and the verdict per row: true OR null is true, false OR null is null."""
    scored = add_zscores(df, columns, baseline, stats, suffix)
    return scored.withColumn(flag, _verdict([ident(c + suffix) for c in columns], z))


def outliers(
    df: DataFrame,
    columns: Sequence[str],
    z: float = 3.0,
    baseline: DataFrame | None = None,
    stats: DataFrame | None = None,
    suffix: str = "_z",
) -> DataFrame:
    """The rows whose verdict is true, with their z columns."""
    scored = add_zscores(df, columns, baseline, stats, suffix)
    return scored.where(_verdict([ident(c + suffix) for c in columns], z))


def outlier_report(
    df: DataFrame,
    columns: Sequence[str],
    z: float = 3.0,
    baseline: DataFrame | None = None,
    stats: DataFrame | None = None,
    scope: str = "all",
) -> DataFrame:
    """One row: threshold, rows examined, baseline rows, outliers, ratio.

    ``scope="all"`` examines every row of ``df``, ``scope="clean"`` the baseline only. The
    ratio always divides by the rows of the baseline, so with ``"all"`` it can exceed 1; it
    is 0.0 for an empty baseline.
    """
    if scope not in ("all", "clean"):
        raise ValueError(f"scope must be 'all' or 'clean', not {scope!r}")
    if stats is None:
        stats = zscore_stats(df if baseline is None else baseline, columns)
    rows_used = lookup(stats, columns)["rows"]
    examined = df if scope == "all" or baseline is None else baseline
    counted = with_moments(examined, columns, stats=stats).agg(
        F.count(F.lit(1)).alias("rows_examined"),
        F.count_if(_verdict([_zscore(i, c) for i, c in enumerate(columns)], z)).alias(
            "outlier_count"
        ),
    )
    return counted.select(
        F.lit(float(z)).alias("z_threshold"),
        "rows_examined",
        rows_used.alias("total_rows_used"),
        "outlier_count",
        F.coalesce(
            F.try_divide(F.col("outlier_count"), rows_used), F.lit(0.0)
        ).alias("outlier_ratio"),
    )
