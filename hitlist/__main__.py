"""Command line for the persisted flows.

    python -m hitlist bootstrap --chart PATH --root ROOT [--version v1] [--peak debut|best]
    python -m hitlist weekly    --chart PATH --root ROOT --from v1 --to v2 [--standardize-featured]
    python -m hitlist employees --data PATH [--format csv|parquet] --root ROOT [--version v1]
    python -m hitlist check     --root ROOT --version v2

``--chart`` is the chart file (CSV with a header); ``ROOT`` is a folder every
executor can reach. Run it with plain python or through spark-submit; an existing
session is reused, and stage tables go to the folder in ``spark.checkpoint.dir``. ``check``
writes all violations to ``ROOT/VERSION/checks/violations`` and exits 1 if there are any.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from hitlist.plans import pipeline
from hitlist.session import BASE_CONF
from hitlist.sources import read_chart_csv, read_employee_data


def _session() -> SparkSession:
    builder = SparkSession.builder.appName("hitlist")
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="hitlist")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("bootstrap")
    b.add_argument("--chart", required=True)
    b.add_argument("--multi-line", action="store_true")
    b.add_argument("--root", required=True)
    b.add_argument("--version", default="v1")
    b.add_argument("--peak", choices=["debut", "best"], default="debut")
    w = sub.add_parser("weekly")
    w.add_argument("--chart", required=True)
    w.add_argument("--multi-line", action="store_true")
    w.add_argument("--root", required=True)
    w.add_argument("--from", dest="from_version", required=True)
    w.add_argument("--to", dest="to_version", required=True)
    w.add_argument("--peak", choices=["debut", "best"], default="debut")
    w.add_argument("--standardize-featured", action="store_true")
    e = sub.add_parser("employees")
    e.add_argument("--data", required=True)
    e.add_argument("--format", default="csv")
    e.add_argument("--multi-line", action="store_true")
    e.add_argument("--root", required=True)
    e.add_argument("--version", default="v1")
    c = sub.add_parser("check")
    c.add_argument("--root", required=True)
    c.add_argument("--version", required=True)
    args = p.parse_args(argv)
    spark = spark or _session()

    if args.cmd == "bootstrap":
        pipeline.bootstrap(spark, read_chart_csv(spark, args.chart, args.multi_line), args.root, args.version, args.peak)
    elif args.cmd == "weekly":
        pipeline.weekly(
            spark, read_chart_csv(spark, args.chart, args.multi_line), args.root, args.from_version, args.to_version, args.peak, args.standardize_featured
        )
    elif args.cmd == "employees":
        pipeline.employees(spark, read_employee_data(spark, args.data, args.format, args.multi_line), args.root, args.version)
    elif args.cmd == "check":
        where, n = pipeline.store_check(spark, args.root, args.version)
        print(f"{n} violations, in {where}")
        return 1 if n else 0
    return 0


if __name__ == "__main__":
    sys.exit(main())
