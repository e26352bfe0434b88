import math

import pytest
from pyspark.sql import functions as F

import insight


@pytest.fixture
def small(spark):
    rows = [(1, 1.0, "a"), (2, float("nan"), "b"), (3, None, None)]
    return spark.createDataFrame(rows, "k bigint, x double, s string")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_table_summary(small):
    assert rows_of(insight.table_summary(small)) == [(3, 3)]


def test_schema_table(small):
    assert rows_of(insight.schema_table(small).orderBy("ordinal")) == [
        (0, "k", "bigint"),
        (1, "x", "double"),
        (2, "s", "string"),
    ]


def test_nan_is_not_null(small):
    got = rows_of(insight.null_counts(small).orderBy("ordinal"))
    assert got == [(0, "k", 0), (1, "x", 1), (2, "s", 1)]


def test_empty_table_has_no_nulls_and_no_summary(small):
    empty = small.where("false")
    assert rows_of(insight.table_summary(empty)) == [(0, 3)]
    assert [r["null_count"] for r in insight.null_counts(empty).collect()] == [0, 0, 0]
    summary = {r["column"]: r[1:] for r in insight.numeric_summary(empty).collect()}
    assert summary == {"k": (None,) * 5, "x": (None,) * 5}
    assert insight.top_values(empty, "s").count() == 0


def test_top_null_columns_ties_keep_table_order(small):
    assert rows_of(insight.top_null_columns(small, 2)) == [("x", 1), ("s", 1)]


def test_nan_becomes_maximum_and_mean(small):
    low, high, _, _, mean = insight.numeric_summary(small, ["x"]).first()[1:]
    assert low == 1.0 and math.isnan(high) and math.isnan(mean)


def test_integers_and_decimals_stay_exact(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big, 1.0), (1, 2.0)], "k bigint, x double")
    df = df.withColumn("d", F.expr("CAST('1234567890123456789012345678.0123456789' AS decimal(38,10))"))
    got = {r["column"]: r for r in insight.numeric_summary(df).collect()}
    assert (got["k"]["min_exact"], got["k"]["max_exact"]) == ("1", str(big))
    assert got["d"]["max_exact"] == "1234567890123456789012345678.0123456789"
    assert (got["x"]["min"], got["x"]["max"], got["x"]["max_exact"]) == (1.0, 2.0, None)
    assert insight.numeric_summary(df).dtypes == insight.numeric_summary(df, ["k"]).dtypes
    assert insight.numeric_summary(df, ["k"]).dtypes == insight.numeric_summary(df, []).dtypes


def test_wide_tables_are_profiled_in_groups(spark, plan_of):
    df = spark.range(10).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(35)])
    rows = insight.column_profile(df).collect()
    assert [r["ordinal"] for r in rows] == list(range(35))
    assert [(r["min"], r["mean"], r["row_count"]) for r in rows] == [(i, i + 4.5, 10) for i in range(35)]


def test_absent_columns(small):
    with pytest.raises(ValueError, match="nope"):
        insight.numeric_summary(small, ["nope"])
    assert insight.numeric_summary(small, ["nope"], missing="skip").count() == 0
    assert insight.numeric_summary(small, ["x", "nope"], missing="skip").count() == 1
    assert insight.null_counts(small, ["nope"], missing="skip").count() == 0
    assert insight.top_values(small, "nope", missing="skip").count() == 0
    with pytest.raises(ValueError):
        insight.top_values(small, "nope")
    with pytest.raises(ValueError):
        insight.top_values(small, "s", missing="ignore")


def test_top_values_count_null_and_break_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("c",)], "s string")
    assert rows_of(insight.top_values(df, "s")) == [("c", 2), (None, 1), ("a", 1), ("b", 1)]
    assert rows_of(insight.top_values(df, "s", k=1)) == [("c", 2)]


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1,), (None,)], "`a.b` int")
    assert rows_of(insight.null_counts(df)) == [(0, "a.b", 1)]
    assert rows_of(insight.numeric_summary(df)) == [("a.b", 1, 1, "1", "1", 1.0)]
    assert rows_of(insight.top_values(df, "a.b")) == [(None, 1), (1, 1)]
    assert rows_of(insight.column_profile(df)) == [(0, "a.b", "int", 2, 1, 1, 1, "1", "1", 1.0)]


def test_column_profile_agrees_with_the_single_operators(small):
    whole = {r["column"]: r for r in insight.column_profile(small).collect()}
    for r in insight.null_counts(small).collect():
        assert whole[r["column"]]["null_count"] == r["null_count"]
    for r in insight.numeric_summary(small).collect():
        assert repr(whole[r["column"]]["mean"]) == repr(r["mean"])
    assert whole["s"]["min"] is None and whole["s"]["type"] == "string"


def test_profile(small):
    report = insight.profile(small, ["x", "nope"], category="s", top_nulls=1)
    assert rows_of(report.summary) == [(3, 3)]
    assert rows_of(report.top_null_columns) == [("x", 1)]
    assert [r["column"] for r in report.numeric_summary.collect()] == ["x"]
    assert report.top_values.count() == 3
    assert rows_of(report.schema) == rows_of(insight.schema_table(small))
    assert report.null_counts.count() == 3
    assert insight.profile(small).top_values.count() == 0
    assert rows_of(insight.profile(small.where("false")).summary) == [(0, 3)]


def test_column_profile_reads_the_table_once(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    spark.range(100).withColumn("x", F.rand(1)).write.parquet(path)
    plan = plan_of(insight.column_profile(spark.read.parquet(path)))
    assert plan.count("Scan parquet") == 2  # once in the tree, once in the details
    assert "Python" not in plan and "Expand" not in plan


def test_top_values_reads_one_column_and_counts_before_the_shuffle(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "id % 3 AS c", "id * 2 AS other").write.parquet(path)
    plan = plan_of(insight.top_values(spark.read.parquet(path), "c"))
    assert "ReadSchema: struct<c:bigint>" in plan
    assert "partial_count" in plan and "TakeOrderedAndProject" in plan
