"""Reading tables; writing samples and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Read a Parquet or CSV file or folder.

    Without ``fmt``, a path that ends in ``.csv`` (in any case) is CSV and everything else
    Parquet; name the format for a folder of CSV files. CSV has a header row. Its types come
    from ``schema``, and only without one from an additional pass over the whole input, so
    give a schema for large input.
    """
    fmt = fmt or ("csv" if path.lower().endswith(".csv") else "parquet")
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown format: {fmt!r}")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
    return reader.load(path)


def sample_rows(
    df: DataFrame, n: int = 50, order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """``n`` rows: any, or the first in the given order (which should identify a row).

    With an order it is one top-n per partition and a merge, never a global sort.
    """
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def write_sample(
    df: DataFrame, path: str, n: int = 50, order_by: Sequence[str | Column] | None = None
) -> None:
    """Write ``sample_rows`` as Parquet, in place of what is there."""
    sample_rows(df, n, order_by).write.mode("overwrite").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """Write a report as JSON lines, in place of what is there.

    Executors write it, so ``path`` may lie on any store Spark reaches. Null fields are
    written, so that every report of a kind has the same keys.
    """
    report.write.mode("overwrite").option("ignoreNullFields", False).json(path)
