import math

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

import insight


@pytest.fixture
def linear(spark):
    return spark.range(200).select(
        F.sin("id").alias("x1"),
        F.cos(F.col("id") * 2).alias("x2"),
        (2 + 3 * F.sin("id") - F.cos(F.col("id") * 2)).alias("y"),
        (2 + 3 * F.sin("id") + F.cos(F.col("id") * 11)).alias("noisy"),
    )


def terms(model):
    return {r["term"]: r["estimate"] for r in insight.coefficients(model).collect()}


def test_regression_recovers_the_coefficients(linear):
    model = insight.fit_regression(linear, ["x1", "x2"], "y")
    got = terms(model)
    assert list(got) == ["x1", "x2", "(intercept)"]
    assert np.allclose(list(got.values()), [3.0, -1.0, 2.0])
    scored = insight.predict(model, linear)
    assert scored.columns == [*linear.columns, "prediction"]
    metrics = insight.regression_metrics(scored, "y").first()
    assert metrics["rmse"] < 1e-9 and math.isclose(metrics["r2"], 1.0)


def test_regression_agrees_with_mllib(linear):
    ours = insight.fit_regression(linear, ["x1", "x2"], "noisy")
    vectors = insight.assemble(linear, ["x1", "x2"])
    theirs = LinearRegression(labelCol="noisy").fit(vectors)
    assert np.allclose(ours.coefficients, theirs.coefficients.toArray(), rtol=1e-9)
    assert math.isclose(ours.intercept, theirs.intercept, rel_tol=1e-9)


def test_residuals_are_orthogonal_to_the_features(linear):
    model = insight.fit_regression(linear, ["x1", "x2"], "noisy")
    residual = F.col("noisy") - F.col("prediction")
    sums = insight.predict(model, linear).agg(
        F.sum(residual), F.sum(residual * F.col("x1")), F.sum(residual * F.col("x2"))
    )
    assert np.allclose(list(sums.first()), 0.0, atol=1e-9)


def test_features_far_from_zero(spark):
    df = spark.range(1000).select(
        (F.col("id") % 17 + F.lit(1e9)).alias("x"),
        (5 * (F.col("id") % 17) + F.sin("id") * 1e-3).alias("y"),
    )
    model = insight.fit_regression(df, ["x"], "y")
    assert math.isclose(model.coefficients[0], 5.0, rel_tol=1e-4)


def test_constant_and_dependent_features(linear):
    df = linear.withColumns({"same": F.lit(0.1), "twice": F.col("x1") * 2})
    model = insight.fit_regression(df, ["x1", "same", "twice"], "y")
    assert model.coefficients[1] == 0.0
    assert math.isclose(model.coefficients[0] + 2 * model.coefficients[2], 3.0, rel_tol=1e-1)
    constant = insight.fit_regression(df, ["same"], "y")
    mean = df.agg(F.avg("y")).first()[0]
    assert constant.coefficients == (0.0,) and math.isclose(constant.intercept, mean)


@pytest.mark.parametrize("width", [1, 2, 11, 40])
@pytest.mark.parametrize("fit", ["regression", "classifier", "clusters"])
def test_every_width_refuses_the_same_rows(spark, width, fit):
    names = [f"x{i}" for i in range(width)]

    def table(*values):
        rows = [(v, *range(width - 1), float(i % 2)) for i, v in enumerate(values)]
        kinds = ", ".join(f"{n} double" for n in names)
        rows = [tuple(None if x is None else float(x) for x in r) for r in rows]
        return spark.createDataFrame(rows, f"{kinds}, y double")

    def run(df):
        if fit == "clusters":
            return insight.fit_clusters(df, names, k=2)
        call = insight.fit_regression if fit == "regression" else insight.fit_classifier
        return call(df, names, "y")

    for odd in (None, float("nan"), float("inf")):
        with pytest.raises(ValueError, match="null, NaN or infinite values"):
            run(table(1.0, odd, 2.0))
    with pytest.raises(ValueError, match="no rows"):
        run(table(1.0).where("false"))


@pytest.fixture
def counted(linear):
    """Rows that count how often they are read."""
    reads = linear.sparkSession.sparkContext.accumulator(0)

    def read(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = linear.withColumn("label", (F.col("noisy") > 2).cast("double"))
    return df.mapInArrow(read, df.schema), reads


# Reads of the input by each fit, as the README has them.
def test_times_that_differ_little_count(spark):
    df = spark.range(200, numPartitions=3).selectExpr(
        "1.7e15D + id AS at", "0.1D AS same", "3D * id + 7 AS y"
    )
    model = insight.fit_regression(df, ["at", "same"], "y")
    assert math.isclose(model.coefficients[0], 3, rel_tol=1e-9) and model.coefficients[1] == 0
    largest = insight.predict(model, df).selectExpr("max(abs(prediction - y))").first()[0]
    assert largest < 2  # a double near 5e15 has steps of 0.5 to 1


def test_rows_are_checked_once_at_any_width(spark):
    """The plan has one check a row, so its size grows with the columns, not with their square."""
    from insight.operators.models import _prepared

    wide = spark.range(1).selectExpr(*(f"id * {i} AS c{i}" for i in range(64)))
    plan = _prepared(wide, wide.columns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("raise_error") == 1 and len(plan) < 64 * 400


@pytest.mark.parametrize(
    "fit, passes",
    [
        (lambda df: insight.fit_regression(df, ["x1", "x2"], "noisy"), 1),
        (lambda df: insight.fit_classifier(df, ["x1", "x2"]), 1),
        (lambda df: insight.fit_clusters(df, ["x1", "x2"], k=3), 1),
        (lambda df: insight.fit_clusters(df, ["x1", "x2"], k=3, scale=False), 1),
    ],
)
def test_reads_of_a_fit(counted, fit, passes):
    df, reads = counted
    fit(df)
    assert reads.value == 200 * passes


@pytest.fixture
def binary(spark):
    return spark.range(2000).select(
        (F.col("id") % 40 / 10).alias("x"),
        F.cos("id").alias("z"),
        ((F.col("id") % 40 / 10 + F.sin(F.col("id") * 13)) > 2).cast("double").alias("label"),
    )


def test_classifier_solves_the_score_equations(binary):
    model = insight.fit_classifier(binary, ["x", "z"])
    scored = insight.predict(model, binary)
    error = F.col("label") - F.get("probability", F.lit(1))
    means = scored.agg(F.avg(error), F.avg(error * F.col("x")), F.avg(error * F.col("z"))).first()
    assert np.allclose(list(means), 0.0, atol=1e-5)
    assert dict(scored.dtypes)["probability"] == "array<double>"
    assert scored.columns == [*binary.columns, "prediction", "probability"]
    wrong = scored.where((F.get("probability", F.lit(1)) > 0.5) != (F.col("prediction") == 1.0))
    assert wrong.count() == 0
    assert insight.classification_metrics(scored).first()["accuracy"] > 0.8


@pytest.mark.parametrize("only", [0.0, 1.0])
def test_classifier_needs_two_classes(binary, only):
    with pytest.raises(ValueError, match="one class"):
        insight.fit_classifier(binary.withColumn("label", F.lit(only)), ["x"])


@pytest.fixture
def blobs(spark):
    return spark.range(300).select(
        (F.col("id") % 3).alias("truth"),
        (F.col("id") % 3 * 10 + F.sin("id")).alias("x"),
        ((F.col("id") % 3 == 1).cast("int") * 200 + F.cos("id")).alias("y"),
    )


@pytest.mark.parametrize("scale", [True, False])
def test_clusters_find_the_groups(blobs, scale):
    model = insight.fit_clusters(blobs, ["x", "y"], k=3, scale=scale)
    assigned = insight.assign_clusters(model, blobs, scaled_suffix="_s")
    assert assigned.columns == [*blobs.columns, "cluster", "x_s", "y_s"]
    assert assigned.select("truth", "cluster").distinct().count() == 3
    assert insight.silhouette(assigned, ["x_s", "y_s"]).first()["silhouette"] > 0.9
    sizes = [tuple(r) for r in insight.cluster_sizes(assigned).collect()]
    assert sizes == [(0, 100), (1, 100), (2, 100)]
    assert [tuple(r) for r in insight.fitted_sizes(model).collect()] == sizes


def test_every_centre_is_the_mean_of_its_points_and_the_nearest(blobs):
    model = insight.fit_clusters(blobs, ["x", "y"], k=3)
    assert model.stages[-1].summary.numIter < 20
    rows = insight.assign_clusters(model, blobs, scaled_suffix="_s").collect()
    centers = {}
    for r in insight.cluster_centers(model).collect():
        centers.setdefault(r["cluster"], {})[r["feature"]] = (r["scaled"], r["original"])
    for cluster, center in centers.items():
        own = [r for r in rows if r["cluster"] == cluster]
        for f in ("x", "y"):
            assert math.isclose(center[f][0], np.mean([r[f + "_s"] for r in own]), abs_tol=1e-9)
            assert math.isclose(center[f][1], np.mean([r[f] for r in own]), abs_tol=1e-9)
    for r in rows:
        distance = {
            c: (r["x_s"] - v["x"][0]) ** 2 + (r["y_s"] - v["y"][0]) ** 2
            for c, v in centers.items()
        }
        assert min(distance, key=distance.get) == r["cluster"]


def test_equal_points_make_one_cluster(spark):
    df = spark.createDataFrame([(1.0,)] * 5, "x double")
    assigned = insight.assign_clusters(insight.fit_clusters(df, ["x"], k=2), df)
    got = insight.silhouette(assigned, ["x"]).first()
    assert (got["clusters"], got["silhouette"]) == (1, None)


def test_cluster_iterations_run_a_task_for_each_core_not_each_input_partition(spark):
    """Each k-means iteration sends one result per task to the driver; with a task for each
    partition of the input those grew with it (cluster_means, 200 iterations)."""
    sc = spark.sparkContext
    df = spark.range(4000).selectExpr("double(id % 7) AS x", "double(id % 11) AS y").repartition(40)
    sc.setJobGroup("fit-tasks", "k-means fit")
    try:
        insight.fit_clusters(df, ["x", "y"], k=3, max_iter=20, tol=0.0)
    finally:
        sc.setJobGroup("other", "")
    tracker = sc.statusTracker()
    stages = [
        tracker.getStageInfo(s)
        for j in tracker.getJobIdsForGroup("fit-tasks")
        for s in tracker.getJobInfo(j).stageIds
    ]
    tasks = [s.numTasks for s in stages if s is not None]
    assert len(tasks) > 20
    # The stage of the repartition itself keeps its own tasks; every later one has at most a core each.
    assert sorted(tasks)[-2] <= sc.defaultParallelism
