"""Command-line load job for ``spark-submit``.

    spark-submit --py-files paylake.zip paylake/plans/job.py \\
        --raw s3a://.../raw/ --format csv \\
        --warehouse s3a://.../warehouse [--database payments] \\
        (--date 2026-08-01 | --start D --end D | --full | --yesterday) \\
        [--fact-mode ignore|replace] [--layout day|month] [--check-orphans] [--count-read] \\
        [--timestamp-format P] [--multi-line] [--export-csv DIR] \\
        [--jdbc-url URL --jdbc-user U --jdbc-password-env VAR]

``--full`` wins over a day, as in the reference.  The reference falls back to
"yesterday" when no mode is given; here that fallback must be asked for
(``--yesterday``), so a missing flag cannot silently load the wrong day.
Prints the load result (counters and rule report) as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import os
from datetime import timedelta

from pyspark.sql import SparkSession

from paylake.functions.timeparse import parse_day
from paylake.operators.timestamps import INFER
from paylake.plans.load import default_day, run_load
from paylake.schemas import TIMESTAMP_FORMAT
from paylake.session import shared_root
from paylake.sources.day_index import DayIndex
from paylake.sources.jdbc import jdbc_options
from paylake.sources.raw import read_raw_csv, read_raw_parquet
from paylake.sources.warehouse import LAYOUTS, Warehouse


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="paylake-load", description=__doc__.split("\n\n")[0])
    p.add_argument("--raw", required=True, help="raw transaction log (file or folder)")
    p.add_argument("--format", choices=("csv", "parquet"), default="csv")
    p.add_argument("--warehouse", required=True, help="warehouse root folder")
    p.add_argument("--database", default=None, help="register tables in this catalog database")
    p.add_argument("--layout", choices=LAYOUTS, default="day",
                   help="partitions of the fact; month where days are small")
    mode = p.add_mutually_exclusive_group()
    mode.add_argument("--date", help="load one day (YYYY-MM-DD)")
    mode.add_argument("--yesterday", action="store_true", help="load yesterday")
    p.add_argument("--start", help="range load: first day (inclusive)")
    p.add_argument("--end", help="range load: last day (exclusive)")
    p.add_argument("--full", action="store_true", help="load every row (wins over a day)")
    p.add_argument("--fact-mode", choices=("ignore", "replace"), default="ignore")
    p.add_argument("--check-orphans", action="store_true")
    p.add_argument("--count-read", action="store_true",
                   help="also count the whole raw log (a second scan)")
    p.add_argument("--timestamp-format", default=INFER,
                   help="Spark datetime pattern; without it each file's first value decides")
    p.add_argument("--day-index", default=None,
                   help="folder of a day index of the raw files: a load of days opens only "
                        "files that hold them")
    p.add_argument("--multi-line", action="store_true",
                   help="quoted CSV fields may hold line breaks (a second pass counts quotes)")
    p.add_argument("--export-csv", default=None, help="write the four tables as CSV folders")
    p.add_argument("--jdbc-url", default=None, help="append the batch's four tables there")
    p.add_argument("--jdbc-user", default=None)
    p.add_argument("--jdbc-password-env", default=None,
                   help="environment variable that holds the password")
    p.add_argument("--jdbc-driver", default=None)
    p.add_argument("--jdbc-connections", type=int, default=None)
    args = p.parse_args(argv)
    if (args.date or args.yesterday) and (args.start or args.end):
        p.error("--date and --yesterday exclude --start/--end")
    if not (args.full or args.date or args.yesterday or args.start or args.end):
        p.error("give --date, --start/--end, --full or --yesterday")
    return args


def main(argv=None, spark: SparkSession | None = None) -> dict:
    args = parse_args(argv)
    spark = spark or SparkSession.builder.appName("paylake-load").getOrCreate()
    shared_root(spark)  # the job stages in spark.checkpoint.dir
    def scan(session, path):
        return (read_raw_csv(session, path, args.multi_line, mark_corrupt=True) if args.format == "csv"
                else read_raw_parquet(session, path))

    day = default_day() if args.yesterday else args.date
    fmt = args.timestamp_format
    if args.day_index and not args.full:
        start, end = (day, parse_day(day) + timedelta(days=1)) if day else (args.start, args.end)
        raw = DayIndex(spark, args.raw, args.day_index, scan, fmt).read(start, end)
        fmt = TIMESTAMP_FORMAT if fmt == INFER else fmt  # the index has inferred it
    else:
        raw = scan(spark, args.raw)
    jdbc = None
    if args.jdbc_url:
        password = os.environ[args.jdbc_password_env] if args.jdbc_password_env else None
        jdbc = {"url": args.jdbc_url, "num_partitions": args.jdbc_connections,
                "props": jdbc_options(args.jdbc_url, args.jdbc_user, password, args.jdbc_driver)}
    wh = Warehouse(spark, args.warehouse, database=args.database, layout=args.layout)
    wh.create_tables()
    result = run_load(spark, raw, wh, full=args.full, day=None if args.full else day,
                      start=args.start, end=args.end, fact_mode=args.fact_mode,
                      check_orphans=args.check_orphans, count_read=args.count_read,
                      timestamp_format=fmt, jdbc=jdbc,
                      export_dir=args.export_csv)
    out = {"loaded": result.loaded, "counters": result.counters,
           "fact_rows_added": result.fact_rows_added,
           "rules": [{k: r[k] for k in ("rule_no", "rule", "table_name", "column_name",
                                        "violations", "passed")} for r in result.report]}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
