"""Run analyses of a trip table from the command line.

    python -m insight --input trips.parquet --output results --analyses stats kmeans --k 5

The session takes its master and resources from ``spark-submit`` or its configuration.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from insight import read_table, run_analyses, trip_plan
from insight.plans import ANALYSES


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="insight", description=__doc__.splitlines()[0])
    parser.add_argument("--input", required=True, help="Parquet or CSV, file or folder")
    parser.add_argument("--output", required=True, help="folder for reports and samples")
    parser.add_argument("--format", choices=["parquet", "csv"], help="default: by the suffix")
    parser.add_argument("--schema", help="column names and types of a CSV file (DDL)")
    parser.add_argument("--analyses", nargs="+", choices=ANALYSES, default=list(ANALYSES))
    parser.add_argument("--k", type=int, default=5, help="clusters to look for")
    parser.add_argument("--z", type=float, default=3.0, help="standard deviations from the mean beyond which a row is an outlier")
    parser.add_argument("--split", choices=["hash", "random"], default="hash")
    parser.add_argument("--split-keys", nargs="+", default=[], help="columns that tell rows apart")
    args = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("insight").getOrCreate()
    table = read_table(spark, args.input, args.format, args.schema)
    plan = trip_plan(k=args.k, z=args.z, split=args.split, split_keys=tuple(args.split_keys))
    run = run_analyses(table, args.analyses, plan, output=args.output, source=args.input)
    failed = False
    for row in run.status.collect():
        failed |= row["status"] != "done"
        print(f"{row['analysis']}: {row['status']} {row['error'] or row['warning'] or ''}".rstrip())
    return int(failed)


if __name__ == "__main__":
    raise SystemExit(main())
