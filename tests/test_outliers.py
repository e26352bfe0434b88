import math

import pytest
from pyspark.sql import functions as F

import insight


@pytest.fixture
def points(spark):
    """A hundred values around 0 and one far away."""
    return spark.range(101).select(
        F.when(F.col("id") == 100, 50.0).otherwise((F.col("id") % 10 - 4.5)).alias("x"),
        F.lit(5.0).alias("same"),
    )


def test_stats_use_the_sample_deviation(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    assert [tuple(r) for r in insight.zscore_stats(df, ["x"]).collect()] == [
        ("x", 2.0, math.sqrt(2.0), 2)
    ]


def test_constant_column_has_no_z_and_no_outlier(points):
    rows = insight.flag_outliers(points, ["x", "same"]).collect()
    assert all(r["same_z"] is None for r in rows)
    assert [r["x"] for r in rows if r["is_outlier"]] == [50.0]
    assert all(r["is_outlier"] is None for r in rows if r["x"] != 50.0)


def test_outliers_are_the_rows_with_a_true_verdict(points):
    found = insight.outliers(points, ["x", "same"]).collect()
    assert len(found) == 1 and found[0]["x_z"] > 3
    assert insight.outliers(points, ["x"], z=100.0).count() == 0


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (1.0,)], "x double")
    assert insight.outliers(df, ["x"], z=1.0).count() == 0
    assert insight.outliers(df, ["x"], z=0.999).count() == 2


def test_verdict_with_null(spark):
    base = spark.createDataFrame([(-1.0, -1.0), (0.0, 0.0), (1.0, 1.0)], "a double, b double")
    rows = [(None, 50.0), (None, 0.5), (50.0, 0.5), (0.0, 0.5)]
    df = spark.createDataFrame(rows, "a double, b double")
    flagged = insight.flag_outliers(df, ["a", "b"], baseline=base).collect()
    assert [r["is_outlier"] for r in flagged] == [True, None, True, False]
    assert insight.outliers(df, ["a", "b"], baseline=base).count() == 2


def test_nan_exceeds_every_threshold(spark):
    base = spark.createDataFrame([(-1.0,), (1.0,)], "x double")
    df = spark.createDataFrame([(float("nan"),)], "x double")
    assert insight.outliers(df, ["x"], baseline=base).count() == 1


def test_statistics_come_from_the_baseline_verdicts_for_all_rows(points):
    baseline = points.where("x < 10")
    whole = insight.outlier_report(points, ["x"], baseline=baseline).first()
    assert whole["rows_examined"] == 101 and whole["total_rows_used"] == 100
    assert whole["outlier_count"] == 1 and whole["outlier_ratio"] == 1 / 100
    part = insight.outlier_report(points, ["x"], baseline=baseline, scope="clean").first()
    assert part["rows_examined"] == 100 and part["outlier_count"] == 0


def test_ratio_can_exceed_one(spark):
    base = spark.createDataFrame([(-1.0,), (1.0,)], "x double")
    df = spark.createDataFrame([(100.0,)] * 5, "x double")
    assert insight.outlier_report(df, ["x"], baseline=base).first()["outlier_ratio"] == 2.5


def test_empty_and_one_row(points):
    empty = insight.outlier_report(points.where("false"), ["x"]).first()
    assert tuple(empty) == (3.0, 0, 0, 0, 0.0)
    against_nothing = insight.outlier_report(points, ["x"], baseline=points.where("false")).first()
    assert against_nothing["outlier_count"] == 0 and against_nothing["outlier_ratio"] == 0.0
    stats = insight.zscore_stats(points.where("false"), ["x"]).first()
    assert stats["mean"] is None and stats["std"] is None
    one = points.limit(1)
    assert insight.add_zscores(one, ["x"]).first()["x_z"] is None
    assert insight.outlier_report(one, ["x"]).first()["outlier_count"] == 0


def test_known_statistics_can_be_given(points):
    stats = insight.zscore_stats(points, ["x"])
    given = insight.outlier_report(points, ["x"], stats=stats).first()
    assert given == insight.outlier_report(points, ["x"]).first()
    assert insight.add_zscores(points, ["x"], stats=stats).columns == ["x", "same", "x_z"]


def test_scope_is_checked(points):
    with pytest.raises(ValueError):
        insight.outlier_report(points, ["x"], scope="some")


def test_plan_has_no_join_and_reads_used_columns_only(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id * 1.5D AS x", "id AS y", "'t' AS z").write.parquet(path)
    table = spark.read.parquet(path)
    plan = plan_of(insight.outlier_report(table, ["x", "y"], baseline=table.where("x > 1")))
    assert "Join" not in plan and "CartesianProduct" not in plan and "Python" not in plan
    assert "z:string" not in plan


def test_names_with_dots(spark):
    df = spark.createDataFrame([(-1.0,), (1.0,)], "`a.b` double")
    assert insight.outlier_report(df, ["a.b"]).first()["outlier_count"] == 0
    assert insight.outliers(df, ["a.b"], z=0.5).count() == 2
