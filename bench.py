"""Times the snapshot build and the reports; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads.  Each
query runs twice and the faster run counts.  Builds write every row to a sink
that drops it; reports read the stored cells and are collected, since they are
small by construction.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from riskbook.sources.snapshot import to_cells
from workload import queries as workload

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2

REPORTS = [
    "overdue_by_date",
    "overdue_by_province",
    "overdue_by_city",
    "reloan_overdue_by_date",
    "reloan_rate_by_province",
    "repayment",
    "fund_change_count",
    "migration_rates",
    "vintage_rate",
    "structure_detail",
    "lending_by_city",
    "light_by_province",
    "reloan_new_vs_cumulative",
    "m30_overdue_interest",
    "m30_reloan_vintage_rate_principal",
    "vintage_rate_history",
]

# Whole runs: every table of a run written, with its manifest.
RUNS_WHOLE = ["report_bundle_month", "report_bundle_month_30"]


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def timed(run) -> float:
    best = float("inf")
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def drop_rows(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    queries = workload.registered()[0]
    times = {}
    for cadence in ("month", "week", "day"):
        times[f"snapshot_{cadence}"] = timed(
            lambda c=cadence: drop_rows(workload.snapshots(spark, FOLDER, c))
        )
    for cadence in ("month", "history"):
        times[f"cells_{cadence}"] = timed(
            lambda c=cadence: drop_rows(to_cells(workload.snapshots(spark, FOLDER, c)))
        )
    workload.cells(spark, FOLDER, "month")
    for name in REPORTS:
        times[name] = timed(lambda n=name: queries[n](spark, FOLDER).collect())
    for name in RUNS_WHOLE:
        times[f"run_{name.removeprefix('report_bundle_')}"] = timed(lambda n=name: queries[n](spark, FOLDER).collect())
    # the last month-end from the state stored for the one before and the events since (the faster run has both stored)
    times["snapshot_incremental"] = timed(lambda: drop_rows(workload.carried(spark, FOLDER, "month")))
    print(
        json.dumps(
            {
                "metric": "snapshot builds and reports, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
