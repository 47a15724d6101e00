"""Time the silver and gold backfill of 24 months in one pass and month by month.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench_backfill.py
"""

from __future__ import annotations

import json
import os
import time

from monthmill.checks import views
from monthmill.checks.queries import END, SEGMENTS, START
from monthmill.plans import stores
from monthmill.session import build_session, staging
from monthmill.sources.snapshots import ingest, snapshot_dates, write_snapshots


def backfill(spark, mart: stores.Mart, dates: list[str]) -> None:
    stores.build_silver_loans(spark, mart.bronze("loans"), mart.silver("loans"), dates)
    stores.build_silver_clickstream(spark, mart.bronze("clickstream"), mart.silver("loans"), mart.silver("clickstream"), dates)
    stores.build_silver_attributes(spark, mart.bronze("attributes"), mart.silver("attributes"), dates, SEGMENTS)
    stores.build_silver_financials(spark, mart.bronze("financials"), mart.silver("financials"), dates)
    stores.build_silver_aggregated(
        spark, mart.silver("clickstream"), mart.silver("attributes"), mart.silver("financials"),
        mart.silver("aggregated"), dates,
    )
    stores.build_gold_labels(spark, mart.silver("loans"), mart.gold("labels"), dates)
    stores.build_gold_features(spark, mart.silver("aggregated"), mart.gold("features"), dates)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "monthmill-backfill", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    dates = snapshot_dates(START, END)
    with staging(spark, spark.conf.get("spark.sql.warehouse.dir")) as root:
        mart = stores.Mart(root)
        for source in stores.SOURCES:
            write_snapshots(ingest(getattr(views, source)(spark, sf_dir), dates), mart.bronze(source), dates)
        backfill(spark, mart, dates[:1])
        start = time.perf_counter()
        backfill(spark, mart, dates)
        one_pass = time.perf_counter() - start
        start = time.perf_counter()
        for day in dates:
            backfill(spark, mart, [day])
        by_month = time.perf_counter() - start
    spark.stop()
    print(json.dumps({"one_pass_sec": round(one_pass, 1), "by_month_sec": round(by_month, 1), "months": len(dates)}))


if __name__ == "__main__":
    main()
