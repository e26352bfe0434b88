import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import insight
from insight.plans import ANALYSES, AnalysisPlan
from insight.plans import run as run_module


@pytest.fixture(scope="module")
def trips(spark):
    """Trips with the column names of the default plan, odd values included."""
    start = datetime(2025, 1, 1)
    rows = []
    for i in range(400):
        minutes = 5 + i * 7 % 60
        end = start + timedelta(minutes=i + minutes)
        distance = minutes * 0.4 + i % 5
        fare = 3 + 2.5 * distance + i % 3
        tip = float(i % 4)
        rows.append(
            (
                start + timedelta(minutes=i),
                None if i % 50 == 0 else end,
                -1.0 if i % 41 == 0 else distance,
                None if i % 31 == 0 else 1 + i % 4,
                fare,
                tip,
                fare + tip + (500.0 if i % 97 == 1 else 0.0),
                None if i % 37 == 0 else 1 + (i % 5) // 2,
            )
        )
    return spark.createDataFrame(
        rows,
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
        "trip_distance double, passenger_count int, fare_amount double, tip_amount double, "
        "total_amount double, payment_type int",
    )


def status_of(run):
    return {r["analysis"]: r["status"] for r in run.status.collect()}


@pytest.fixture(scope="module")
def whole(trips):
    return insight.run_analyses(trips, ANALYSES, insight.trip_plan())


def test_all_analyses(whole):
    assert status_of(whole) == dict.fromkeys(ANALYSES, "done")
    assert all(r["duration_seconds"] > 0 for r in whole.status.collect())
    assert set(whole.reports) == set(ANALYSES) == set(whole.samples)


def test_stats_report(whole, trips):
    reports = whole.reports["stats"]
    assert reports["summary"].first()[:] == (400, 8)
    assert reports["top_null_columns"].first()["column"] == "passenger_count"
    assert reports["columns"].count() == 8 and reports["numeric_summary"].count() == 4
    assert reports["top_values"].count() == 4
    assert whole.samples["stats"].count() == 50


def cleaned(trips, *conditions):
    df = trips.withColumn(
        "trip_duration", insight.elapsed("tpep_pickup_datetime", "tpep_dropoff_datetime")
    )
    common = "trip_distance > 0 AND trip_distance < 200 AND trip_duration > 0 AND trip_duration < 300"
    return df.where(" AND ".join([common, *conditions]))


def test_model_reports(whole, trips):
    metrics = whole.reports["regression"]["metrics"]
    assert {r["split"] for r in metrics.collect()} == {"train", "test"}
    used = cleaned(trips, "total_amount > 0", "passenger_count IS NOT NULL").count()
    assert metrics.agg(F.sum("rows")).first()[0] == used
    assert whole.reports["regression"]["coefficients"].count() == 4
    assert whole.samples["regression"].columns == ["label", "prediction"]

    reports = whole.reports["classification"]
    used = cleaned(trips, "passenger_count IS NOT NULL", "payment_type IN (1, 2)").count()
    assert reports["metrics"].agg(F.sum("rows")).first()[0] == used
    assert reports["class_balance"].agg(F.sum("count")).first()[0] == used
    assert whole.samples["classification"].columns == ["label", "prediction", "probability"]

    reports = whole.reports["kmeans"]
    used = cleaned(trips, "passenger_count IS NOT NULL").count()
    assert reports["metrics"].first()["rows"] == used
    assert reports["sizes"].agg(F.sum("count")).first()[0] == used
    assert reports["centers"].count() == 25

    report = whole.reports["outliers"]["metrics"].first()
    assert report["rows_examined"] == 400
    assert report["total_rows_used"] == cleaned(trips, "total_amount > 0").count()
    assert report["outlier_count"] >= 4
    assert whole.samples["outliers"].count() == report["outlier_count"]


def test_nothing_stays_cached(spark, whole):
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_order_is_that_of_the_library(trips):
    run = insight.run_analyses(trips, ["outliers", "stats"], insight.trip_plan(z=2.0))
    assert [r["analysis"] for r in run.status.collect()] == ["stats", "outliers"]
    assert run.reports["outliers"]["metrics"].first()["z_threshold"] == 2.0


def test_empty_request_and_unknown_name(trips):
    run = insight.run_analyses(trips, [], insight.trip_plan())
    assert run.status.count() == 0 and run.reports == {}
    with pytest.raises(ValueError, match="guess"):
        insight.run_analyses(trips, ["guess"], insight.trip_plan())
    with pytest.raises(ValueError, match="does not define"):
        insight.run_analyses(trips, ["kmeans"], AnalysisPlan())


def test_first_failure_stops_the_rest(trips):
    one_class = trips.withColumn("payment_type", F.lit(1))
    run = insight.run_analyses(one_class, ANALYSES, insight.trip_plan())
    assert status_of(run) == {
        "stats": "done",
        "regression": "done",
        "classification": "failed",
        "kmeans": "skipped",
        "outliers": "skipped",
    }
    errors = {r["analysis"]: r["error"] for r in run.status.collect()}
    assert "one class" in errors["classification"] and errors["stats"] is None
    assert set(run.reports) == {"stats", "regression"}


def test_missing_column_fails_where_it_is_used(trips):
    plan = insight.trip_plan()
    run = insight.run_analyses(trips.drop("tip_amount"), ["stats", "kmeans", "outliers"], plan)
    assert status_of(run) == {"stats": "done", "kmeans": "failed", "outliers": "skipped"}
    errors = {r["analysis"]: r["error"] for r in run.status.collect()}
    assert "tip_amount" in errors["kmeans"]
    run = insight.run_analyses(trips.drop("tip_amount"), ["outliers"], plan)
    assert status_of(run) == {"outliers": "done"}
    run = insight.run_analyses(trips.drop("tpep_pickup_datetime"), ["stats", "outliers"], plan)
    assert status_of(run) == {"stats": "done", "outliers": "failed"}


@pytest.fixture(scope="module")
def stored(spark, trips, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("trips") / "t")
    trips.write.parquet(folder)
    return spark.read.parquet(folder)


@pytest.mark.parametrize("name", ["regression", "classification", "kmeans", "outliers"])
def test_conditions_reach_the_reader(stored, plan_of, name):
    plan = insight.trip_plan()
    spec = getattr(plan, name)
    columns = spec.columns if name == "outliers" else spec.features
    text = plan_of(run_module._cleaned(stored, plan, spec, columns))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "GreaterThan(trip_distance,0.0)" in pushed
    assert "IsNotNull(tpep_pickup_datetime)" in pushed


# Reads of the source by each analysis, as the README has them.
@pytest.mark.parametrize(
    "name, reads", [("stats", 2), ("regression", 1), ("classification", 1), ("kmeans", 1), ("outliers", 2)]
)
def test_reads_of_an_analysis(trips, name, reads):
    count = trips.sparkSession.sparkContext.accumulator(0)

    def read(batches):
        for batch in batches:
            count.add(batch.num_rows)
            yield batch

    counted = trips.mapInArrow(read, trips.schema)
    assert status_of(insight.run_analyses(counted, [name], insight.trip_plan())) == {name: "done"}
    assert count.value == 400 * reads


def test_reports_say_what_they_are_made_of(whole):
    regression = whole.reports["regression"]["metrics"].first()
    assert regression["features"] == "trip_distance, passenger_count, trip_duration"
    assert (regression["method"], regression["label"]) == ("linear regression", "total_amount")
    assert "card" in whole.reports["classification"]["metrics"].first()["meaning"]
    assert whole.reports["kmeans"]["metrics"].first()["k"] == 5


def test_warns_of_an_uneven_split(trips):
    same = trips.where("trip_distance > 0").limit(1)
    for _ in range(8):
        same = same.unionAll(same)
    run = insight.run_analyses(trips.unionAll(same), ["regression"], insight.trip_plan())
    assert "split keys" in run.status.first()["warning"]


def test_output_folder(spark, trips, tmp_path):
    out = str(tmp_path / "out")
    insight.run_analyses(trips, ["stats", "outliers"], insight.trip_plan(), output=out)
    assert spark.read.parquet(f"{out}/stats/sample").count() == 50
    assert spark.read.json(f"{out}/outliers/metrics").first()["rows_examined"] == 400
    assert spark.read.json(f"{out}/status").count() == 2
    lines = [
        json.loads(line)
        for f in (tmp_path / "out" / "stats" / "columns").glob("part-*")
        for line in f.read_text().splitlines()
    ]
    assert len(lines) == 8 and all("mean" in line for line in lines)


def test_random_split_is_that_of_spark(trips):
    plan = insight.trip_plan(split="random")
    run = insight.run_analyses(trips, ["regression"], plan)
    sizes = {r["split"]: r["rows"] for r in run.reports["regression"]["metrics"].collect()}
    features = ["trip_distance", "passenger_count", "trip_duration"]
    rows = cleaned(trips, "total_amount > 0").select(*features, "total_amount").dropna()
    train, test = rows.randomSplit([0.8, 0.2], seed=42)
    assert sizes == {"train": train.count(), "test": test.count()}
    with pytest.raises(ValueError):
        insight.trip_plan(split="odd")


def test_split_keys(trips):
    plan = insight.trip_plan(split_keys=("tpep_pickup_datetime",))
    run = insight.run_analyses(trips, ["regression"], plan)
    assert status_of(run) == {"regression": "done"}


def test_command_line(spark, trips, tmp_path, capsys):
    from insight.__main__ import main

    source, out = str(tmp_path / "trips.csv"), str(tmp_path / "out")
    trips.coalesce(1).write.option("header", True).csv(source)
    code = main(["--input", source, "--output", out, "--analyses", "stats", "outliers", "--z", "2"])
    assert code == 0
    assert capsys.readouterr().out.splitlines() == ["stats: done", "outliers: done"]
    assert spark.read.json(f"{out}/outliers/metrics").first()["z_threshold"] == 2.0
    assert {r["input"] for r in spark.read.json(f"{out}/status").collect()} == {source}
    bad = ["--input", source, "--output", out, "--schema", "a int", "--analyses", "outliers"]
    assert main(bad) == 1


def test_several_analyses_read_the_source_once(trips):
    count = trips.sparkSession.sparkContext.accumulator(0)

    def read(batches):
        for batch in batches:
            count.add(batch.num_rows)
            yield batch

    counted = trips.mapInArrow(read, trips.schema)
    run = insight.run_analyses(counted, ANALYSES, insight.trip_plan())
    assert status_of(run) == dict.fromkeys(ANALYSES, "done")
    assert count.value == 400
    assert trips.sparkSession.sparkContext._jsc.getPersistentRDDs().size() == 0
