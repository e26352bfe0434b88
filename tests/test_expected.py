"""Numbers of the fixture tables at the middle scale, known beforehand."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import insight

FOLDER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables")


def run(spark, name):
    return contract.queries()[name](spark, FOLDER)


def test_trips(spark):
    assert run(spark, "table_summary").first()["row_count"] == 60_000
    nulls = {r["column"]: r["null_count"] for r in run(spark, "null_counts").collect()}
    expected = {"dropoff": 646, "passenger_count": 3421, "total_amount": 2599, "payment_type": 2881}
    assert {c: n for c, n in nulls.items() if n} == expected
    top = [tuple(r) for r in run(spark, "top_values").collect()]
    assert top == [(2, 20_046), (1, 20_028), (3, 17_045), (None, 2881)]


@pytest.mark.parametrize(
    ("name", "rows"),
    [
        ("clean_regression", 5970),
        ("clean_classification", 4158),
        ("clean_clusters", 6236),
        ("clean_outliers", 6294),
    ],
)
def test_rows_left_after_cleaning(spark, name, rows):
    assert run(spark, name).count() == rows


def test_events(spark):
    report = run(spark, "outlier_report").first()
    assert (report["outlier_count"], report["rows_examined"]) == (182, 10_000)
    sizes = {r["split"]: r["rows"] for r in run(spark, "split_sizes").collect()}
    assert sizes == {"train": 7971, "test": 2029}
    assert run(spark, "silhouette").first()["silhouette"] == 0.626824
    metrics = run(spark, "classification_metrics").first()
    assert (metrics["accuracy"], metrics["f1"]) == (0.5085, 0.512278)


def test_regression(spark):
    items = insight.read_table(spark, f"{FOLDER}/lineitem.parquet")
    model = insight.fit_regression(items, ["l_quantity", "l_discount"], "l_extendedprice")
    got = [round(v, 6) for v in (*model.coefficients, model.intercept)]
    assert got == [7.186452, 6803.905951, 52532.078354]


def test_clusters_of_embeddings(spark):
    """Converged k-means in 64 dimensions: every centre is the mean of its points."""
    table, names = contract._vectors(spark, FOLDER)
    model = insight.fit_clusters(table, names, k=10, scale=False)
    assert model.stages[-1].summary.numIter < 20
    means = (
        insight.assign_clusters(model, table)
        .groupBy("cluster")
        .agg(*[F.avg(c).alias(c) for c in names])
        .collect()
    )
    centers = {
        (r["cluster"], r["feature"]): r["original"]
        for r in insight.cluster_centers(model).collect()
    }
    assert len(means) == 10
    for row in means:
        for c in names:
            assert abs(centers[row["cluster"], c] - row[c]) < 1e-12
