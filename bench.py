"""Times the headline queries, a refresh and an upsert, and prints one JSON line.

``BENCH_SF_DIR`` is the data directory, ``BENCH_CPUS`` the local cores. Every query is run
once untimed and once timed, each time over the whole tables and down to its last row (the
result goes to Spark's no-op sink). The stored marts that WEEK, FYtD, the reports and the
checks read are written during the untimed pass, as a real run writes them once a day. What
that writing costs is timed apart: ``refresh_week`` brings all marts, both reports and the
dashboard up to date for one week, ``upsert_mart`` merges the supply mart's daily rows into a
table that holds them already.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.queries import QUERIES  # noqa: E402
from tidemark.params import DAY, RunParams  # noqa: E402
from tidemark.plans.refresh import refresh  # noqa: E402
from tidemark.queries import Setup  # noqa: E402
from tidemark.session import local_session, scratch_table  # noqa: E402
from tidemark.sinks.upsert import upsert  # noqa: E402

HEADLINE = [
    *[f"{mart}_mart_{scope}" for mart in ("acquisition", "conversion", "monetisation", "retention", "supply") for scope in ("day", "week", "fytd")],
    "budget_mart_day", "budget_mart_week", "report_breakout", "report_overview", "report_dashboard",
    "metrics_ads_metrics", "metrics_hotel_revenue", "metrics_payback_months",
    "check_booking_fee_take_rate", "check_campaign_day", "check_journey_leisure", "check_foreign_travel_monetisation", "check_unique_keys",
]


def refresh_week(spark, sf_dir: str) -> None:
    s = Setup(spark, sf_dir)
    refresh(spark, s.src, RunParams(date(1999, 5, 9), date(1999, 5, 15), as_of=s.p.as_of), scratch_table(spark, "bench"), s.cfg)


def upsert_mart(spark, sf_dir: str) -> None:
    path, rows = scratch_table(spark, "bench"), Setup(spark, sf_dir).store.stored("supply_mart", [DAY])
    for _ in range(2):
        upsert(path, rows)


WRITES = {"refresh_week": refresh_week, "upsert_mart": upsert_mart}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in sys.argv[1].split(",")] if len(sys.argv) > 1 else [*HEADLINE, *WRITES]
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8, folder=tempfile.mkdtemp(prefix="run-", dir="/tmp"))

    def run(name: str) -> None:
        if name in WRITES:
            WRITES[name](spark, sf_dir)
        else:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    took = {}
    for name in names:
        if name not in WRITES:  # a write starts from nothing each time
            run(name)
        t = time.perf_counter()
        run(name)
        took[name] = round(time.perf_counter() - t, 3)
        print(f"{name} {took[name]}", file=sys.stderr, flush=True)
    queries = {name: sec for name, sec in took.items() if name not in WRITES}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(queries.values()), 3), "unit": "sec", "queries": queries,
        "writes": {name: sec for name, sec in took.items() if name in WRITES},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
