"""Ingest job, for ``spark-submit`` or ``python -m logmill.job``."""

import argparse
import json

from logmill.plans import pipeline, report, save_report
from logmill.plans.session import session
from logmill.sources.files import ON_CHANGED


def run(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("-log_dir", required=True, help="root folder of the log files")
    parser.add_argument("-log_pat", required=True, help="name pattern of the log files")
    parser.add_argument("-hostname_file", required=True, help="CSV with client and hostname")
    parser.add_argument("-output", default="output", help="lake folder")
    parser.add_argument("-errors", help="folder for a text copy of the lines that are not log lines")
    parser.add_argument("-table", default="joined_log_table", help="warehouse table")
    parser.add_argument("-table_path", help="folder of the table's files, if not the warehouse")
    mode = parser.add_mutually_exclusive_group()
    mode.add_argument("-overwrite", action="store_true", help="replace the table if it exists")
    mode.add_argument("-by_runs", action="store_true", help="a table that grows by the runs it doesn't have yet")
    parser.add_argument("-buckets", type=int, help="with -by_runs: keep the records by host in so many buckets")
    parser.add_argument("-run", help="name of this run; one that is done is not done again")
    parser.add_argument("-new_files_only", action="store_true", help="read only files that no earlier run has read")
    parser.add_argument("-on_changed", default="fail", choices=ON_CHANGED, help="what to do about changed files")
    parser.add_argument("-compact", type=int, metavar="MB", help="afterwards rewrite small lake files into such of this size")
    parser.add_argument("-partition_field", nargs="*", default=(), help="lake folders by these fields")
    parser.add_argument("-report", help="also write the report below this folder")
    parser.add_argument("-spread", type=int, help="spread the lines over so many tasks, for a few large .gz files")
    parser.add_argument("-shuffle_partitions", type=int, help="partitions of the join, if not the session's")
    args = parser.parse_args(argv)

    spark = session(shuffle_partitions=args.shuffle_partitions)
    pipe = pipeline(
        "apache_web_log",
        spark,
        output_location=args.output,
        errors_location=args.errors,
        table=args.table,
        table_path=args.table_path,
        table_mode="overwrite" if args.overwrite else "runs" if args.by_runs else "errorifexists",
        partition_field=args.partition_field,
        run=args.run,
        new_files_only=args.new_files_only,
        on_changed=args.on_changed,
        buckets=args.buckets,
    )
    (
        pipe.extract_log(args.log_dir, args.log_pat, args.hostname_file, args.spread)
        .clean_log_record()
        .load_to_data_lake()
        .transform_data()
        .load_datawarehouse()
    )
    print(json.dumps({"run": pipe.run, **pipe.counts}))
    if args.compact:
        pipe.runs.compact(args.compact << 20)
    if args.report:
        save_report(report(spark, args.output, args.table), args.report)


if __name__ == "__main__":
    run()
