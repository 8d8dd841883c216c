"""Command line: load a source, or print a report.

    python -m vendaflow load --root ROOT --folder DIR --names a.xlsx b.csv
    python -m vendaflow report --root ROOT mensal --anos 2016 2017
"""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from vendaflow.errors import SalesError
from vendaflow.plans import views
from vendaflow.plans.reports import REPORTS
from vendaflow.plans.star import Filters
from vendaflow.plans.warehouse import Warehouse
from vendaflow.sources.files import find_source, read_source


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    path = find_source(spark, args.folder, args.names)
    print(f"reading {path}")
    warehouse = Warehouse(spark, args.root)
    summary = warehouse.load(read_source(spark, path), strict=not args.lenient)
    print(f"rows read: {summary.extracted}, loaded: {summary.loaded}, "
          f"rejected: {summary.rejected}, members: {summary.members}")
    views.publish(warehouse)


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    warehouse = Warehouse(spark, args.root)
    if not warehouse.ready():
        raise SalesError("the warehouse is empty: load it first")
    filters = Filters(args.segmentos, args.regioes, args.categorias, args.anos)
    rows = REPORTS[args.name](warehouse.star(), filters)
    if args.out:
        # Written by the executors, whole and in order of the report.
        rows.write.mode("overwrite").option("header", True).csv(args.out)
        return
    print(",".join(rows.columns))
    for row in rows.toLocalIterator():
        print(",".join("" if v is None else str(v) for v in row))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="vendaflow")
    commands = top.add_subparsers(required=True)
    one = commands.add_parser("load")
    one.set_defaults(run=load)
    one.add_argument("--root", required=True)
    one.add_argument("--folder", required=True)
    one.add_argument("--names", nargs="+", required=True, help="file names, first found wins")
    one.add_argument("--lenient", action="store_true", help="set unfit rows aside")
    two = commands.add_parser("report")
    two.set_defaults(run=report)
    two.add_argument("--root", required=True)
    two.add_argument("name", choices=sorted(REPORTS))
    two.add_argument("--out", help="folder for the whole report as CSV; else it is printed whole")
    for name in ("segmentos", "regioes", "categorias"):
        two.add_argument(f"--{name}", nargs="*", default=[])
    two.add_argument("--anos", nargs="*", type=int, default=[])
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("vendaflow").getOrCreate()
    try:
        args.run(spark, args)
    except (SalesError, PySparkException) as failure:
        print(f"error: {failure}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
