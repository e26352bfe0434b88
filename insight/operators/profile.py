"""Descriptive profile of a table: sizes, types, nulls, numeric ranges, frequent values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from insight.functions import ident, literal, named
from insight.sources import local_table, settled

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _chosen(df: DataFrame, columns: Sequence[str] | None, missing: str) -> list[str]:
    """The named columns that exist, all columns by default."""
    if missing not in ("error", "skip"):
        raise ValueError(f"missing must be 'error' or 'skip', not {missing!r}")
    if columns is None:
        return df.columns
    absent = [c for c in columns if c not in df.columns]
    if absent and missing == "error":
        raise ValueError(f"no such columns: {absent}")
    return [c for c in columns if c not in absent]


def _numeric(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]


#: Columns that one aggregate profiles: so many that it stays compiled code. The aggregates of
#: all groups read columns of their own, so a columnar source is still read once.
GROUP = 10
_RANGE = ("min", "max", "min_exact", "max_exact", "mean")
_RANGE_TYPES = "min double, max double, min_exact string, max_exact string, mean double"


def _per_column(
    df: DataFrame, names: Sequence[str], columns: Sequence[tuple[list[str], list[str]]]
) -> DataFrame:
    """One row for each of ``columns``, its aggregates and its values made of them; one
    aggregate over the table for each group of columns."""
    groups = []
    for begin in range(0, len(columns), GROUP):
        group = columns[begin : begin + GROUP]
        structs = [
            "struct(" + ", ".join(f"{v} AS `{n}`" for n, v in zip(names, row)) + ")"
            for _, row in group
        ]
        groups.append(
            df.selectExpr("count(1) AS rows", *[a for aggregates, _ in group for a in aggregates])
            .selectExpr(f"inline(array({', '.join(structs)}))")
        )
    return reduce(DataFrame.unionAll, groups)


def _ranges(df: DataFrame, i: int, column: str) -> tuple[list[str], list[str]]:
    """Aggregates of the i-th column, and the values of ``_RANGE``.

    Integers and decimals, which a double may not hold, are given as text as well.
    """
    c = ident(column)
    exact = isinstance(df.schema[column].dataType, (*_INTEGRAL, T.DecimalType))
    mean = f"CAST({c} AS double)" if isinstance(df.schema[column].dataType, T.DecimalType) else c
    text = "CAST({} AS string)" if exact else "CAST(NULL AS string)"
    return [f"min({c}) AS min_{i}", f"max({c}) AS max_{i}", f"avg({mean}) AS mean_{i}"], [
        f"CAST(min_{i} AS double)",
        f"CAST(max_{i} AS double)",
        text.format(f"min_{i}"),
        text.format(f"max_{i}"),
        f"CAST(mean_{i} AS double)",
    ]


def table_summary(df: DataFrame) -> DataFrame:
    """One row: ``row_count`` and ``column_count``."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
    )


def schema_table(df: DataFrame) -> DataFrame:
    """``(ordinal, column, type)`` from the metadata; no job runs over the data."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return local_table(df.sparkSession, rows, "ordinal int, column string, type string")


def null_counts(
    df: DataFrame, columns: Sequence[str] | None = None, missing: str = "error"
) -> DataFrame:
    """``(ordinal, column, null_count)`` of all columns in one pass. NaN is not null.

    Counts by ``count(1) - count(column)``: 0, not NULL, for a table without rows.
    """
    chosen = _chosen(df, columns, missing)
    if not chosen:
        return local_table(df.sparkSession, [], "ordinal int, column string, null_count bigint")
    places = [df.columns.index(c) for c in chosen]
    return _per_column(
        df,
        ("ordinal", "column", "null_count"),
        [
            ([f"count({ident(c)}) AS filled_{i}"], [str(i), literal(c), f"rows - filled_{i}"])
            for i, c in zip(places, chosen)
        ],
    )


def top_null_columns(df: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` columns with most nulls; columns that tie stay in table order."""
    return _most_nulls(null_counts(df), n)


def _most_nulls(counts: DataFrame, n: int) -> DataFrame:
    return (
        counts.orderBy(F.desc("null_count"), "ordinal").limit(n).select("column", "null_count")
    )


def numeric_summary(
    df: DataFrame, columns: Sequence[str] | None = None, missing: str = "error"
) -> DataFrame:
    """``(column, min, max, min_exact, max_exact, mean)`` of numeric columns (default: all).

    NaN sorts above every number: it does not touch the minimum, but it becomes the maximum
    and the mean. Nulls are left out. ``min`` and ``max`` are doubles; of integers and decimals,
    ``min_exact`` and ``max_exact`` have every digit as text. The types do not depend on the
    columns.
    """
    chosen = _chosen(df, columns, missing)
    if columns is None:
        chosen = _numeric(df, chosen)
    if not chosen:
        return local_table(df.sparkSession, [], f"column string, {_RANGE_TYPES}")
    ranges = [_ranges(df, i, c) for i, c in enumerate(chosen)]
    return _per_column(
        df,
        ("column", *_RANGE),
        [(a, [literal(c), *row]) for c, (a, row) in zip(chosen, ranges)],
    )


def top_values(df: DataFrame, column: str, k: int = 10, missing: str = "error") -> DataFrame:
    """``(value, count)`` of the ``k`` most frequent values; null counts as a value.

    Values that tie come in ascending order, null first. Counts are combined before the
    shuffle, so one value in a third of all rows is one record per task there.
    """
    if not _chosen(df, [column], missing):
        return local_table(df.sparkSession, [], "value string, count bigint")
    return (
        df.groupBy(named(column).alias("value"))
        .count()
        .orderBy(F.desc("count"), "value")
        .limit(k)
    )


def column_profile(
    df: DataFrame, numeric: Sequence[str] | None = None, missing: str = "error"
) -> DataFrame:
    """Row count, nulls and numeric range of every column, each column read once.

    ``(ordinal, column, type, row_count, null_count)`` and what ``numeric_summary`` has, NULL for
    columns that are not summarised (by default those that are not numeric).
    """
    wanted = _numeric(df, df.columns) if numeric is None else _chosen(df, numeric, missing)
    columns = []
    for i, field in enumerate(df.schema.fields):
        row = [str(i), literal(field.name), literal(field.dataType.simpleString())]
        row += ["rows", f"rows - filled_{i}"]
        aggregates = [f"count({ident(field.name)}) AS filled_{i}"]
        if field.name in wanted:
            more, values = _ranges(df, i, field.name)
            aggregates += more
        else:
            kinds = (f.dataType.simpleString() for f in T.StructType.fromDDL(_RANGE_TYPES))
            values = [f"CAST(NULL AS {k})" for k in kinds]
        columns.append((aggregates, [*row, *values]))
    names = ("ordinal", "column", "type", "row_count", "null_count", *_RANGE)
    return _per_column(df, names, columns)


@dataclass(frozen=True)
class Profile:
    """The tables of a profile."""

    schema: DataFrame
    columns: DataFrame
    summary: DataFrame
    null_counts: DataFrame
    top_null_columns: DataFrame
    numeric_summary: DataFrame
    top_values: DataFrame


def profile(
    df: DataFrame,
    numeric: Sequence[str] | None = None,
    category: str | None = None,
    top_nulls: int = 20,
    top_k: int = 10,
    missing: str = "skip",
) -> Profile:
    """The whole profile: each column read once, and ``category`` once more.

    The first runs now. It leaves one row per column of ``df``, from which all tables but
    ``top_values`` are made; that one is lazy.
    """
    columns = settled(column_profile(df, numeric, missing))
    wanted = _numeric(df, df.columns) if numeric is None else _chosen(df, numeric, missing)
    return Profile(
        schema=columns.select("ordinal", "column", "type"),
        columns=columns,
        summary=columns.where("ordinal = 0").select(
            "row_count", F.lit(len(df.columns)).alias("column_count")
        ),
        null_counts=columns.select("ordinal", "column", "null_count"),
        top_null_columns=_most_nulls(columns, top_nulls),
        numeric_summary=columns.where(F.col("column").isin(wanted)).select(
            "column", *_RANGE
        ),
        top_values=local_table(df.sparkSession, [], "value string, count bigint")
        if category is None
        else top_values(df, category, top_k, missing),
    )
