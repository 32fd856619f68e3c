"""Run the consolidated job: ``python -m tempestry INPUT OUTPUT``."""

import argparse

from pyspark.sql import functions as F

from tempestry.plans.report import write_model_report, write_reports
from tempestry.schema import EVENT_ID
from tempestry.session import build_session
from tempestry.sources.csv_files import read_events_csv
from tempestry.sources.sinks import write_by_year


def main(argv=None):
    parser = argparse.ArgumentParser(prog="tempestry", description=__doc__)
    parser.add_argument("input", help="event CSV, or Parquet with --parquet")
    parser.add_argument("output", help="folder for the reports")
    parser.add_argument("--parquet", action="store_true", help="the input is Parquet")
    parser.add_argument("--row-id", default=EVENT_ID, help="column that names a row")
    parser.add_argument("--no-model", action="store_true", help="skip the harm model")
    parser.add_argument("--trees", type=int, default=100)
    parser.add_argument("--depth", type=int, default=10)
    parser.add_argument(
        "--partitions", type=int, default=200, help="tasks of the forest, about one per 128 MB"
    )
    parser.add_argument(
        "--one-line", action="store_true", help="no record spans lines: read with Spark's own line-wise reader"
    )
    parser.add_argument("--master", default=None)
    args = parser.parse_args(argv)

    spark = build_session(master=args.master)
    if args.parquet:
        events = spark.read.parquet(args.input)
    else:
        read = read_events_csv(
            spark, args.input, multi_line=not args.one_line, split=not args.one_line
        )
        write_by_year(read, f"{args.output}/events")
        events = spark.read.parquet(f"{args.output}/events")
        events = events.withColumn("YEAR", F.col("YEAR").cast("int"))
    write_reports(events, f"{args.output}/reports")
    if not args.no_model:
        write_model_report(
            events,
            f"{args.output}/model",
            args.row_id,
            trees=args.trees,
            depth=args.depth,
            partitions=args.partitions,
        )


if __name__ == "__main__":
    main()
