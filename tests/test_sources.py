import json

import pytest
from pyspark.sql import functions as F

from insight import read_table, sample_rows, write_report, write_sample


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "Small.CSV"
    path.write_text("t,a,b\n2024-01-01 00:00:00,1.5,x\n2024-01-02 00:00:00,,y\n")
    return str(path)


def test_csv_by_suffix_with_header_and_types(spark, csv_file):
    df = read_table(spark, csv_file)
    assert df.dtypes == [("t", "timestamp"), ("a", "double"), ("b", "string")]
    assert [r["a"] for r in df.orderBy("t").collect()] == [1.5, None]


def test_csv_schema_needs_no_pass(spark, csv_file):
    df = read_table(spark, csv_file, schema="t timestamp_ntz, a double, b string")
    assert df.dtypes == [("t", "timestamp_ntz"), ("a", "double"), ("b", "string")]
    assert df.count() == 2


def test_folder_of_csv_files_by_format(spark, tmp_path):
    folder = str(tmp_path / "folder")
    spark.range(10).repartition(3).write.option("header", True).csv(folder)
    assert read_table(spark, folder, fmt="csv").agg(F.sum("id")).first()[0] == 45


def test_parquet_file_and_folder(spark, tmp_path):
    folder = str(tmp_path / "table")
    spark.range(10).repartition(2).write.parquet(folder)
    assert read_table(spark, folder).count() == 10
    one = next((tmp_path / "table").glob("part-*.parquet"))
    assert read_table(spark, str(one)).count() < 10


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        read_table(spark, "x", fmt="xml")


def test_sample_in_order_is_repeatable(spark):
    df = spark.range(1000).repartition(7)
    got = sample_rows(df, 5, [F.desc("id")]).collect()
    assert [r[0] for r in got] == [999, 998, 997, 996, 995]
    assert sample_rows(df, 5).count() == 5
    assert sample_rows(df.limit(3), 5).count() == 3


def test_ordered_sample_sorts_no_table(spark, plan_of):
    plan = plan_of(sample_rows(spark.range(1000), 5, ["id"]))
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


def test_write_sample_replaces(spark, tmp_path):
    target = str(tmp_path / "sample")
    write_sample(spark.range(1000), target, 50)
    write_sample(spark.range(1000), target, 7, ["id"])
    assert [r[0] for r in spark.read.parquet(target).orderBy("id").collect()] == list(range(7))


def test_report_keeps_null_fields(spark, tmp_path):
    target = tmp_path / "report"
    report = spark.createDataFrame([("a", None), ("b", 1.5)], "k string, v double")
    write_report(report, str(target))
    lines = [json.loads(x) for f in target.glob("part-*") for x in f.read_text().splitlines()]
    assert sorted(lines, key=lambda r: r["k"]) == [{"k": "a", "v": None}, {"k": "b", "v": 1.5}]
    write_report(report.limit(1), str(target))
    assert spark.read.json(str(target)).count() == 1
