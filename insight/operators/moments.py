"""Mean and standard deviation of columns, and their use inside another query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from insight.functions import ident, literal


def zscore_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, mean, std, rows)``: sample standard deviation; all columns in one pass."""
    aggregates, rows = ["count(1) AS rows"], []
    for i, c in enumerate(columns):
        aggregates.append(f"CAST(avg({ident(c)}) AS double) AS mean_{i}")
        aggregates.append(f"stddev_samp({ident(c)}) AS std_{i}")
        rows.append(f"struct({literal(c)} AS column, mean_{i} AS mean, std_{i} AS std, rows)")
    return df.selectExpr(*aggregates).selectExpr(f"inline(array({', '.join(rows)}))")


MOMENTS = "_moments"


def lookup(stats: DataFrame, columns: Sequence[str]) -> Column:
    """``zscore_stats`` as a scalar subquery: ``{c0: {mean, std}, c1: …, rows}``.

    Spark evaluates it once per query and hands every task this one row. It is neither a
    join nor a trip through the driver program, and what is handed out grows with the
    number of columns only.
    """

    fields = [
        f"struct(max(CASE WHEN column = {literal(c)} THEN mean END) AS mean, "
        f"max(CASE WHEN column = {literal(c)} THEN std END) AS std) AS c{i}"
        for i, c in enumerate(columns)
    ]
    return stats.selectExpr(f"struct({', '.join(fields)}, max(rows) AS rows) AS moments").scalar()


def with_moments(
    df: DataFrame,
    columns: Sequence[str],
    baseline: DataFrame | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """``df`` with the statistics of the baseline (``df`` by default) as column ``MOMENTS``.

    Expressions refer to that column rather than to the subquery, so the plan holds the
    subquery once and not once per expression.
    """
    if stats is None:
        stats = zscore_stats(df if baseline is None else baseline, columns)
    return df.withColumn(MOMENTS, lookup(stats, columns))


def moment(i: int, value: str) -> str:
    """``mean`` or ``std`` of the i-th column, in a DataFrame made by ``with_moments``."""
    return f"{MOMENTS}.c{i}.{value}"
