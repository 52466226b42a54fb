"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS (default 8) the threads.
Each query is planned and run to the end into a sink that stores nothing; the better of two
runs counts. ``python bench.py all`` times every query once.
"""

from __future__ import annotations

import json
import os
import sys
import time

from ledgerline.plans.registry import load_all
from ledgerline.session import local_session

HEADLINE = [
    "scan_parquet",
    "sink_daily_partition",
    "filter_timestamp_range",
    "join_star_three_way",
    "join_star_enrich",
    "join_asof_last_login",
    "join_role_playing_date",
    "agg_rollup_executive",
    "window_first_per_user_maturity",
    "surrogate_key_dense",
    "running_wallet_balance",
    "sample_stratified",
    "assign_hierarchical",
    "scd1_merge",
    "wallet_balance_snapshot",
    "position_extract",
    "session_login_review",
    "withdrawal_retry_pairs",
    "dq_foreign_key",
    "dq_event_precedence",
    "metric_activation_rate",
    "metric_dau_wau",
    "metric_retention_day_n",
    "metric_cohort_matrix",
    "metric_funnel_lifecycle",
    "metric_aum_daily",
    "metric_net_deposits",
    "metric_rfm",
    "metric_executive_summary",
    "stream_tumbling_counts",
]


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    catalog = load_all()
    everything = sys.argv[1:] == ["all"]
    names = list(catalog) if everything else HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    run(catalog["metric_signups"], spark, folder)
    seconds = {
        name: round(min(run(catalog[name], spark, folder) for _ in range(1 if everything else 2)), 3)
        for name in names
    }
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
