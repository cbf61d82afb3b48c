"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is built and written to the no-op sink, so all its columns are computed and nothing is collected.
The first run of a query, which also compiles it, is not counted; the better of two further runs is.
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import queries
from checks.session import local_session

HEADLINE = (
    "daily_counts",
    "loan_daily",
    "recharge_type_daily",
    "type_template",
    "cohort_recharges",
    "cohort_bucket_recharges",
    "amount_peers",
    "paid_totals",
    "loan_repayment",
    "merge_loan_bursts",
    "pay_day_features",
    "lookback_features",
    "forward_features",
    "timeline_features",
    "future_spend_corrected",
    "order_lookback_features",
    "daily_sample",
    "build_feature_table",
    "t3_days_between_loans",
    "t8_recharges_per_subscriber_month",
)


def seconds(spark, query, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session()
    all_queries = queries()
    times = {}
    for name in HEADLINE:
        query = all_queries[name]
        seconds(spark, query, sf_dir)
        times[name] = round(min(seconds(spark, query, sf_dir) for _ in range(2)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
