"""Small tables held by the driver: schemas, coefficients, centres, finished reports."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The column types that such tables use.
_ARROW = {
    "integer": pa.int32(),
    "long": pa.int64(),
    "double": pa.float64(),
    "string": pa.string(),
}


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A local relation of a few rows, handed over as Arrow so that no Python worker starts."""
    fields = T.StructType.fromDDL(schema)
    columns = {
        f.name: pa.array([row[i] for row in rows], _ARROW[f.dataType.typeName()])
        for i, f in enumerate(fields)
    }
    return spark.createDataFrame(pa.table(columns), fields)


def settled(report: DataFrame) -> DataFrame:
    """The report, computed now and held as a local relation.

    For tables whose size does not depend on the number of rows behind them: one row per
    column, class, cluster or metric.
    """
    return report.sparkSession.createDataFrame(report.toArrow(), report.schema)
