"""Batch jobs for spark-submit: one snapshot each, or a whole backfill.

    spark-submit -m monthmill.jobs bronze --snapshot-date 2023-01-01 --raw … --out …
"""

from __future__ import annotations

import argparse
import sys

from .plans import stores
from .schemas import RAW_COLUMNS
from .session import build_session
from .sources.ledger import Ledger
from .sources.snapshots import read_csv


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="monthmill")
    top.add_argument("--master", help="Spark master; by default the one of spark-submit")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name, *options, dated=True):
        sub = commands.add_parser(name)
        if dated:
            sub.add_argument("--snapshot-date", required=True, help="YYYY-MM-DD")
        for option in options:
            sub.add_argument(option, required=True)
        return sub

    bronze = command("bronze", "--raw", "--out")
    bronze.add_argument("--source", choices=stores.SOURCES, help="checks the header of each file against that source's columns")
    for table in ("silver-loans", "silver-attributes", "silver-financials"):
        command(table, "--bronze", "--out")
    command("silver-clickstream", "--bronze", "--loans", "--out")
    one = command("gold-labels", "--silver", "--out")
    command("aggregate", "--clickstream", "--attributes", "--financials", "--out")
    command("gold-features", "--aggregated", "--out")
    labels = command("label-store", "--loans", "--root", "--start", "--end", dated=False)
    for sub in (labels, one):
        sub.add_argument("--dpd", type=int, default=30)
        sub.add_argument("--mob", type=int, default=6)
    features = command("feature-store", *[f"--{s}" for s in stores.SOURCES], "--root", "--start", "--end", dated=False)
    for sub in (labels, features):
        sub.add_argument("--only-changed", action="store_true", help="build only months whose inputs changed since the last such run")
    vacuum = command("vacuum", "--table", dated=False)
    vacuum.add_argument("--keep", type=int, default=1, help="ledger entries whose files stay; no reader or build may be at work")
    return top


def _raw(spark, path, source):
    """Raw files; where their source is named, what no snapshot gets of them is kept."""
    if source is None:
        return read_csv(spark, path)
    return read_csv(spark, path, RAW_COLUMNS[source], keep_rejects=True, multi_line=None)


def run(spark, args) -> None:
    day = [getattr(args, "snapshot_date", None)]
    jobs = {
        "bronze": lambda: stores.build_bronze(spark, _raw(spark, args.raw, args.source), args.out, day),
        "silver-loans": lambda: stores.build_silver_loans(spark, args.bronze, args.out, day),
        "silver-attributes": lambda: stores.build_silver_attributes(spark, args.bronze, args.out, day),
        "silver-financials": lambda: stores.build_silver_financials(spark, args.bronze, args.out, day),
        "silver-clickstream": lambda: stores.build_silver_clickstream(spark, args.bronze, args.loans, args.out, day),
        "aggregate": lambda: stores.build_silver_aggregated(
            spark, args.clickstream, args.attributes, args.financials, args.out, day
        ),
        "gold-labels": lambda: stores.build_gold_labels(spark, args.silver, args.out, day, args.dpd, args.mob),
        "gold-features": lambda: stores.build_gold_features(spark, args.aggregated, args.out, day),
        "label-store": lambda: stores.run_label_store(spark, args.loans, args.root, args.start, args.end, args.dpd, args.mob, args.only_changed),
        "feature-store": lambda: stores.run_feature_store(
            spark, {s: getattr(args, s) for s in stores.SOURCES}, args.root, args.start, args.end, only_changed=args.only_changed
        ),
        "vacuum": lambda: Ledger(spark, args.table).vacuum(args.keep),
    }
    built = jobs[args.command]()
    if isinstance(built, stores.Built) and built.rejected:
        print(f"{built.rejected} raw rows are kept apart in {args.out}_rejects", file=sys.stderr)
    if isinstance(built, stores.Built) and built.skipped:
        print(f"skipped for want of an input: {', '.join(built.skipped)}", file=sys.stderr)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"monthmill-{args.command}", args.master)
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
