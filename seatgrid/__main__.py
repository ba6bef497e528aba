"""Runs a job on files: ``python -m seatgrid <job> ...``, or this file given to ``spark-submit``."""

from __future__ import annotations

import argparse

from seatgrid.plans.jobs import reexport, run_price_through_time, run_structure_all
from seatgrid.schemas import performance_schema
from seatgrid.session import build_session
from seatgrid.operators.joins import SALT
from seatgrid.sources.collections import copy_json


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="seatgrid")
    jobs = top.add_subparsers(dest="job", required=True)

    structure = jobs.add_parser("structure", help="listings with all features, one-hot encoded")
    for name in ("inventory", "meta", "performance", "base", "label"):
        structure.add_argument(f"--{name}", required=True)
    structure.add_argument("--performance-columns", default="", help="pass-through columns, as DDL")
    structure.add_argument("--discover", action="store_true", help="find the performance columns, and whether performers have roles, in the data")
    structure.add_argument("--split", help="folder for one sub-folder per event")
    structure.add_argument("--split-format", choices=["csv", "parquet"], default="csv")
    structure.add_argument("--split-buckets", type=int, help="that many folders in place of one per event")
    structure.add_argument("--stage", help="shared folder for the parsed collections")
    structure.add_argument("--unordered", action="store_true")
    structure.add_argument("--include-dense", action="store_true")
    structure.add_argument("--strict", action="store_true", help="fail on unreadable dates")
    structure.add_argument("--salt", type=int, default=SALT)

    curve = jobs.add_parser("price-through-time", help="section prices by days to the event")
    for name in ("inventory", "meta", "base", "label"):
        curve.add_argument(f"--{name}", required=True)
    curve.add_argument("--by-grouping", action="store_true")
    curve.add_argument("--stage", help="shared folder for the parsed collections")
    curve.add_argument("--salt", type=int, default=SALT)

    export = jobs.add_parser("reexport", help="Parquet to CSV without rows that have a null")
    export.add_argument("source")
    export.add_argument("target")
    export.add_argument("--header", action="store_true")

    copy = jobs.add_parser("copy-json", help="JSON to JSON")
    copy.add_argument("source")
    copy.add_argument("target")
    copy.add_argument("--keep-nulls", action="store_true")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"seatgrid {args.job}")
    if args.job == "structure":
        run = run_structure_all(
            spark, args.inventory, args.meta, args.performance,
            None if args.discover else performance_schema(args.performance_columns),
            args.base, args.label, split_path=args.split, split_format=args.split_format,
            split_buckets=args.split_buckets, stage=args.stage,
            include_dense=args.include_dense, ordered=not args.unordered, strict=args.strict, salt=args.salt,
        )
        for report in (run.loss_report, run.null_audit, run.join_coverage):
            report.show(truncate=False)
        print(run.path)
    elif args.job == "price-through-time":
        print(run_price_through_time(
            spark, args.inventory, args.meta, args.base, args.label, by_grouping=args.by_grouping, salt=args.salt,
            stage=args.stage,
        ))
    elif args.job == "reexport":
        reexport(spark, args.source, args.target, args.header).show(truncate=False)
    else:
        copy_json(spark, args.source, args.target, ignore_null_fields=not args.keep_nulls)


if __name__ == "__main__":
    main()
