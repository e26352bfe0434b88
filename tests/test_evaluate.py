import math

import pytest
from pyspark.ml.evaluation import (
    ClusteringEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.sql import functions as F

import insight


@pytest.fixture
def scored(spark):
    return spark.range(500).select(
        (F.col("id") % 2).cast("string").alias("half"),
        (F.sin("id") * 10).alias("label"),
        (F.sin("id") * 10 + F.cos(F.col("id") * 3)).alias("prediction"),
    )


def test_regression_metrics_agree_with_the_evaluator(scored):
    ours = insight.regression_metrics(scored).first()
    for metric in ("rmse", "r2"):
        theirs = RegressionEvaluator(metricName=metric).evaluate(scored)
        assert math.isclose(ours[metric], theirs, rel_tol=1e-9)
    assert ours["rows"] == 500


def test_regression_metrics_per_group(scored):
    groups = {r["half"]: r for r in insight.regression_metrics(scored, by=["half"]).collect()}
    for half, row in groups.items():
        alone = insight.regression_metrics(scored.where(F.col("half") == half)).first()
        assert math.isclose(row["rmse"], alone["rmse"], rel_tol=1e-12)
        assert row["rows"] == 250


def test_regression_metrics_edges(spark):
    same = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "label double, prediction double")
    row = insight.regression_metrics(same).first()
    assert row["r2"] is None and math.isclose(row["rmse"], math.sqrt(0.5))
    row = insight.regression_metrics(same.where("false")).first()
    assert (row["rows"], row["rmse"], row["r2"]) == (0, None, None)
    holes = spark.createDataFrame([(1.0, None), (2.0, 2.0)], "label double, prediction double")
    assert insight.regression_metrics(holes).first()["rows"] == 1


@pytest.fixture
def classes(spark):
    return spark.range(1000).select(
        (F.col("id") % 3).cast("double").alias("label"),
        F.when(F.col("id") % 7 == 0, 1.0)
        .otherwise((F.col("id") % 3).cast("double"))
        .alias("prediction"),
    )


def test_classification_metrics_agree_with_the_evaluator(classes):
    ours = insight.classification_metrics(classes).first()
    for metric in ("accuracy", "f1"):
        theirs = MulticlassClassificationEvaluator(metricName=metric).evaluate(classes)
        assert math.isclose(ours[metric], theirs, rel_tol=1e-12)


def test_class_that_is_only_predicted(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 5.0)], "label double, prediction double")
    ours = insight.classification_metrics(df).first()
    theirs = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    assert math.isclose(ours["f1"], theirs) and ours["accuracy"] == 0.5


def test_metrics_from_a_confusion_matrix(classes):
    cells = insight.confusion_matrix(classes)
    assert cells.agg(F.sum("count")).first()[0] == 1000
    direct = insight.classification_metrics(classes).first()
    assert insight.classification_metrics(cells, weight="count").first() == direct
    keys = [(r["label"], r["prediction"]) for r in cells.collect()]
    assert keys == sorted(keys) and (0, 2) not in keys


def test_classification_metrics_of_nothing(classes):
    row = insight.classification_metrics(classes.where("false")).first()
    assert (row["rows"], row["accuracy"], row["f1"]) == (0, None, None)


def test_class_balance_and_cluster_sizes(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (1.0,), (None,)], "label double")
    got = [tuple(r) for r in insight.class_balance(df).collect()]
    assert got == [(None, 1), (0.0, 1), (1.0, 2)]
    df = spark.createDataFrame([(2,), (1,), (0,), (0,)], "cluster int")
    assert [tuple(r) for r in insight.cluster_sizes(df).collect()] == [(0, 2), (1, 1), (2, 1)]


@pytest.fixture
def groups(spark):
    return spark.range(400).select(
        (F.col("id") % 4).cast("int").alias("cluster"),
        (F.col("id") % 4 * 3 + F.sin("id")).alias("x"),
        (F.cos(F.col("id") * 7) + 1000).alias("y"),
    )


def brute_force(rows):
    """Mean silhouette by all pairs."""
    def mean(point, others):
        return sum((point[1] - o[1]) ** 2 + (point[2] - o[2]) ** 2 for o in others) / len(others)

    by_cluster = {}
    for row in rows:
        by_cluster.setdefault(row[0], []).append(row)
    total = 0.0
    for row in rows:
        own = by_cluster[row[0]]
        if len(own) == 1:
            continue
        within = mean(row, own) * len(own) / (len(own) - 1)
        nearest = min(mean(row, c) for key, c in by_cluster.items() if key != row[0])
        if max(within, nearest) > 0:
            total += (nearest - within) / max(within, nearest)
    return total / len(rows)


def test_silhouette_agrees_with_all_pairs_and_with_the_evaluator(groups):
    got = insight.silhouette(groups, ["x", "y"]).first()
    assert (got["rows"], got["clusters"]) == (400, 4)
    assert math.isclose(got["silhouette"], brute_force(groups.collect()), rel_tol=1e-9)
    vectors = insight.assemble(groups, ["x", "y"])
    theirs = ClusteringEvaluator(predictionCol="cluster").evaluate(vectors)
    assert math.isclose(got["silhouette"], theirs, rel_tol=1e-6)


def test_silhouette_of_many_clusters(spark):
    rows = spark.range(4000).select(
        (F.col("id") % 450).cast("int").alias("cluster"),
        *[(F.sin(F.col("id") * (i + 3)) * 9 + F.col("id") % 450 % 7).alias(f"f{i}") for i in range(5)],
    )
    features = [f"f{i}" for i in range(5)]
    lazy = insight.silhouette(rows, features)
    theirs = ClusteringEvaluator(predictionCol="cluster").evaluate(insight.assemble(rows, features))
    got = lazy.first()
    assert (got["rows"], got["clusters"]) == (4000, 450)
    assert math.isclose(got["silhouette"], theirs, rel_tol=1e-6)


def test_silhouette_edges(spark, groups):
    one = insight.silhouette(groups.withColumn("cluster", F.lit(0)), ["x"]).first()
    assert tuple(one) == (400, 1, None)
    none = insight.silhouette(groups.where("false"), ["x"]).first()
    assert tuple(none) == (0, 0, None)
    alone = spark.createDataFrame([(0, 0.0), (1, 1.0), (1, 2.0)], "cluster int, x double")
    expected = brute_force([(r[0], r[1], 0.0) for r in alone.collect()])
    assert math.isclose(insight.silhouette(alone, ["x"]).first()["silhouette"], expected)
    same = spark.createDataFrame([(0, 1.0)] * 2 + [(1, 1.0)] * 2, "cluster int, x double")
    assert insight.silhouette(same, ["x"]).first()["silhouette"] == 0.0
    holes = spark.createDataFrame(
        [(0, 0.0), (0, 1.0), (1, 9.0), (1, 8.0), (None, 5.0), (1, None)], "cluster int, x double"
    )
    assert insight.silhouette(holes, ["x"]).first()["rows"] == 4


def test_silhouette_with_text_labels_and_one_hot_cluster(spark):
    df = spark.range(300).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise("cold").alias("cluster"),
        F.when(F.col("id") % 3 < 2, F.sin("id")).otherwise(F.cos("id") + 5).alias("x"),
        F.lit(0.0).alias("y"),
    )
    got = insight.silhouette(df, ["x", "y"]).first()
    assert math.isclose(got["silhouette"], brute_force(df.collect()), rel_tol=1e-9)


@pytest.mark.parametrize("kind", ["tinyint", "bigint", "float", "double", "decimal(9,2)", "string"])
def test_silhouette_with_labels_of_any_type(groups, kind):
    labels = groups.withColumn("cluster", (F.col("cluster") - 1).cast(kind))
    got = insight.silhouette(labels, ["x", "y"]).first()
    whole = insight.silhouette(groups, ["x", "y"]).first()
    assert got["clusters"] == 4
    assert math.isclose(got["silhouette"], whole["silhouette"], rel_tol=1e-9)


def test_silhouette_compares_no_pairs(groups, plan_of):
    plan = plan_of(insight.silhouette(groups, ["x", "y"]))
    assert "Join" not in plan and "CartesianProduct" not in plan and "Python" not in plan


def test_silhouette_makes_no_struct_for_each_point_and_cluster(spark):
    """Each point sees the clusters once, as plain distances; a struct for every point and
    cluster made silhouettes over many clusters slow."""
    df = spark.createDataFrame([(1.0, 2.0, 0), (2.0, 1.0, 1), (3.0, 3.0, 1)], "a double, b double, c int")
    out = insight.silhouette(df, ["a", "b"], "c")
    assert "lambdafunction(struct(" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.first()["silhouette"] == pytest.approx(-0.2)
