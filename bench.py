"""Time the headline queries; prints one JSON line.

Every query runs to its last row through the ``noop`` sink, which computes all
columns and writes nothing.  One untimed query starts the JVM (reported apart);
each query is then run twice and the better time counts.
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import QUERIES
from tallygrove.session import local_session

HEADLINE = (
    "kpi1_cost_per_impact", "kpi2_programme_progress", "kpi3_demographic_reach",
    "kpi4_outcome_effectiveness", "v_cost_per_impact", "v_programme_progress",
    "v_beneficiary_360", "v_outcome_effectiveness", "v_financial_overview",
    "clean_dates", "clean_dedup_keys", "impute_median", "clean_fk", "clean_all_tables",
    "clean_audit", "dash_card_cost", "dash_trend_top5", "dash_demographic_share",
    "dash_detail_page", "dq_log",
)
WARM_UP = "v_programme_progress"
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    start = time.perf_counter()
    QUERIES[WARM_UP](spark, sf_dir).write.format("noop").mode("overwrite").save()
    warm_up = round(time.perf_counter() - start, 3)
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "warm_up_sec": warm_up,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
