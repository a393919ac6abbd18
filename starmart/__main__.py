"""Command line::

    python -m starmart etl <csv> <dataset> --root <folder>
    python -m starmart report <dataset> <key> --root <folder> [--out <folder>]
    python -m starmart report <dataset> v03 --root <folder> --years 2018 2022 --genres Romance Poesia

``etl`` loads submissions into a new warehouse run with its marts, publishes it and
prints the run report. ``report`` gives a report (q01-q12, d01-d10) or a dashboard
view (v01-v11, under a selection of years and genres) of the current run: written
as Parquet to ``--out``, or its first rows shown. The root is a folder that every
executor reaches, ``spark.checkpoint.dir`` by default; a later call finds the
warehouse by the same root.

Runs on the session ``spark-submit`` / ``pyspark`` configures; ``local[*]``
when started without one.
"""

from __future__ import annotations

import argparse
import inspect

from pyspark.sql import SparkSession

from starmart.params import PRIZE_YEARS
from starmart.plans.etl import level_counts, row_counts
from starmart.plans.marts import build_marts, read_marts
from starmart.plans.reports import DASHBOARD, REPORTS
from starmart.plans.star import build_star, read_clean
from starmart.plans.views import VIEWS
from starmart.sources.csv import read_submissions_csv
from starmart.sources.warehouse import open_star, publish

SHOWN_ROWS = 50


def _arguments(argv):
    parser = argparse.ArgumentParser(prog="starmart")
    sub = parser.add_subparsers(dest="command", required=True)
    etl = sub.add_parser("etl", help="load a submissions CSV into a new warehouse run")
    etl.add_argument("csv")
    etl.add_argument("dataset")
    rep = sub.add_parser("report", help="a report or view of the current run")
    rep.add_argument("dataset")
    rep.add_argument("key", choices=sorted({**REPORTS, **DASHBOARD, **VIEWS}))
    rep.add_argument("--years", nargs=2, type=int, metavar=("FIRST", "LAST"))
    rep.add_argument("--genres", nargs="*")
    rep.add_argument("--out", help="folder for the whole result, as Parquet")
    for command in (etl, rep):
        command.add_argument("--root", help="warehouse root folder")
    return parser.parse_args(argv)


def _load(spark: SparkSession, args, root: str) -> None:
    raw = read_submissions_csv(spark, args.csv)
    star = build_star(spark, raw, PRIZE_YEARS, dataset=args.dataset, root=root, publish_run=False)
    build_marts(spark, star)
    publish(spark, args.dataset, star.path, root)
    print(f"[ETL] run {star.path}")
    levels = {r.selection_level: r["count"] for r in level_counts(read_clean(spark, star)).collect()}
    print(f"[ETL] levels {levels}")
    for r in row_counts(spark, star).collect():
        print(f"  {r.table_name:16s}: {r.row_count}")


def _report(spark: SparkSession, args, root: str) -> None:
    star = open_star(spark, args.dataset, root)
    if args.key in VIEWS:
        view = VIEWS[args.key]
        given = {"years": tuple(args.years) if args.years else None, "genres": args.genres}
        taken = {k: v for k, v in given.items() if v is not None}
        if unknown := sorted(taken.keys() - inspect.signature(view).parameters.keys()):
            raise SystemExit(f"{args.key} takes no {', '.join(unknown)}")
        result = view(read_marts(spark, star.path), **taken)
    else:
        result = {**REPORTS, **DASHBOARD}[args.key](star)
    if args.out:
        result.write.parquet(args.out)
    else:
        result.show(n=SHOWN_ROWS, truncate=False)


def main(argv=None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.getOrCreate()
    root = args.root or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise SystemExit("name the warehouse root: --root, or spark.checkpoint.dir")
    (_load if args.command == "etl" else _report)(spark, args, root)


if __name__ == "__main__":
    main()
