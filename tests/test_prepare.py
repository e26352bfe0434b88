import math

import pytest
from pyspark.sql import functions as F

import insight
from insight import Range


@pytest.fixture
def numbers(spark):
    rows = [(1, 1.0, 2.0), (2, float("nan"), 2.0), (3, None, 2.0), (4, 9.0, None), (5, 3.0, 2.0)]
    return spark.createDataFrame(rows, "id int, x double, y double")


def test_clean_drops_null_and_nan_like_dropna(numbers):
    ours = insight.clean(numbers, ["id", "x"])
    assert [tuple(r) for r in ours.collect()] == [(1, 1.0), (4, 9.0), (5, 3.0)]
    assert ours.collect() == numbers.select("id", "x").dropna().collect()


def test_clean_rules_hold_together(numbers):
    got = insight.clean(numbers, ["id"], [Range("x", gt=0, lt=9), Range("y", ge=2)], ["x"])
    assert [r[0] for r in got.collect()] == [1, 5]


def test_clean_conditions_reach_parquet(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    rows = [(1.0, 2, "a"), (None, 3, "b")]
    spark.createDataFrame(rows, "x double, n int, other string").write.parquet(path)
    table = spark.read.parquet(path)
    plan = plan_of(insight.clean(table, ["x"], [Range("x", gt=0, lt=5)], require=["n"]))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    for part in ("IsNotNull(x)", "IsNotNull(n)", "GreaterThan(x,0.0)", "LessThan(x,5.0)"):
        assert part in pushed
    assert "other" not in plan


def test_hash_split_is_complete_disjoint_and_independent_of_the_layout(spark):
    df = spark.range(10_000).withColumn("v", F.rand(3))
    marked = insight.split_hash(df, ["id"])
    train = {r[0] for r in insight.part(marked, "train").select("id").collect()}
    test = {r[0] for r in insight.part(marked, "test").select("id").collect()}
    assert not train & test and len(train) + len(test) == 10_000
    assert abs(len(train) / 10_000 - 0.8) < 0.02
    again = insight.split_hash(df.repartition(7, "v"), ["id"])
    assert {r[0] for r in insight.part(again, "train").select("id").collect()} == train
    sizes = {r["split"]: r["rows"] for r in insight.split_sizes(marked).collect()}
    assert sizes == {"train": len(train), "test": len(test)}


def test_hash_split_moves_no_rows(spark, plan_of):
    plan = plan_of(insight.split_hash(spark.range(100), ["id"], algorithm="xxhash64"))
    assert "Exchange" not in plan and "Sort" not in plan


def test_hash_split_extremes(spark):
    df = spark.range(500)
    assert insight.part(insight.split_hash(df, ["id"], 100), "test").count() == 0
    assert insight.part(insight.split_hash(df, ["id"], 0), "train").count() == 0
    with pytest.raises(ValueError):
        insight.split_hash(df, ["id"], 101)


def test_hash_split_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, None), (2, 3)], "a int, b int")
    assert insight.split_sizes(insight.split_hash(df, ["a", "b"])).agg(F.sum("rows")).first()[0] == 3


def test_random_split(spark):
    df = spark.range(10_000).repartition(4, "id")
    first = insight.split_random(df)
    again = insight.split_random(df)
    assert sum(p.count() for p in first) == 10_000
    assert first[0].intersect(first[1]).count() == 0
    assert first[0].collect() == again[0].collect()
    reference = df.randomSplit([0.8, 0.2], seed=42)
    assert first[1].collect() == reference[1].collect()


def test_standardize_agrees_with_the_mllib_stage(spark):
    from pyspark.ml.feature import StandardScaler

    df = spark.range(200).select((F.col("id") * 1.5).alias("x"), F.lit(7).alias("same"))
    ours = insight.standardize(df, ["x", "same"])
    vectors = insight.assemble(df, ["x", "same"])
    scaler = StandardScaler(
        inputCol="features", outputCol="s", withMean=True, withStd=True
    ).fit(vectors)
    theirs = scaler.transform(vectors).select("s").collect()
    for mine, other in zip(ours.collect(), theirs):
        assert math.isclose(mine["x_scaled"], other["s"][0], abs_tol=1e-12)
        assert mine["same_scaled"] == other["s"][1] == 0.0


def test_standardize_edges(spark):
    one = spark.createDataFrame([(1.0,)], "x double")
    assert insight.standardize(one, ["x"]).first()["x_scaled"] == 0.0
    with_null = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    got = [r["x_scaled"] for r in insight.standardize(with_null, ["x"]).collect()]
    assert got[1] is None and math.isclose(got[0], -math.sqrt(0.5))
    base = spark.createDataFrame([(0.0,), (2.0,)], "x double")
    got = insight.standardize(one, ["x"], baseline=base, suffix="_s").first()["x_s"]
    assert got == 0.0
    stats = insight.zscore_stats(base, ["x"])
    assert insight.standardize(one, ["x"], stats=stats).first()["x_scaled"] == 0.0


def test_standardize_joins_nothing(spark, plan_of):
    plan = plan_of(insight.standardize(spark.range(100), ["id"]))
    assert "Join" not in plan and "CartesianProduct" not in plan
    assert plan.count("Subquery:") == 1


def test_assemble_refuses_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0)], "a double, b double")
    with pytest.raises(Exception, match="null|NaN"):
        insight.assemble(df, ["a", "b"]).collect()
    assert insight.assemble(df, ["a", "b"], invalid="skip").count() == 1
    assert list(insight.assemble(df, ["a", "b"], "v", "skip").first()["v"]) == [1.0, 2.0]
