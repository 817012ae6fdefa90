"""Time the headline queries: median of three runs after one warm-up, on a star loaded beforehand.

BENCH_SF_DIR names the sample tables, BENCH_CPUS the local cores. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from starloom.plans.queries import QUERIES
from starloom.session import build_session
from starloom.sources import sample

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# Query -> table whose rows it works through.
HEADLINE = {
    "scd2_merge_change": "customer",
    "point_in_time_join": "events",
    "fact_transactions": "lineitem",
    "mv_monthly_transaction_summary": "lineitem",
    "v_transaction_enriched": "lineitem",
    "fraud_rate_by_category": "lineitem",
    "fraud_lookup": "lineitem",
    "running_balance": "lineitem",
    "window_tour": "lineitem",
    "window_tour_report": "lineitem",
    "amount_percentiles": "lineitem",
    "top_customers_per_segment": "lineitem",
    "monthly_growth": "lineitem",
    "cohort_retention": "lineitem",
    "dedup_transactions": "lineitem",
    "check_foreign_keys": "lineitem",
    "activity_streaks": "events",
    "fact_daily_balances": "events",
    "fact_loan_monthly": "orders",
    "delinquency_roll_rate": "orders",
    "vintage_analysis": "orders",
}


def run(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def load_star(spark) -> float:
    """Load and write every table of two stars: dimensions, transactions, loan months."""
    start = time.perf_counter()
    for source in ("events", "lineitem"):
        star = sample.Star(spark, SF_DIR, source)
        star.fact  # noqa: B018 - asking for a table loads it
        if source == "lineitem":
            star.loan_months  # noqa: B018
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "starloom-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold = round(load_star(spark), 3)
    seconds = {"load_star": round(load_star(spark), 3)}
    rates = {}
    rows = {t: sample.table(spark, SF_DIR, t).count() for t in set(HEADLINE.values())}
    for name, table in HEADLINE.items():
        run(spark, name)
        seconds[name] = round(statistics.median(run(spark, name) for _ in range(RUNS)), 3)
        rates[name] = round(rows[table] / seconds[name])
    print(
        json.dumps(
            {
                "metric": "starloom headline queries, median seconds summed",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rates,
                "load_star_cold": cold,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
