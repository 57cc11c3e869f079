"""Time the headline queries and print one JSON line.

Each query is run once to warm up and then timed; a run writes its whole result to Spark's `noop` sink, so
every row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from txnwatch.plans.registry import queries  # noqa: E402
from txnwatch.session import build_session  # noqa: E402

HEADLINE = [
    "silver_transactions", "dq_report", "window_features", "flow_features", "gold_features", "rule_structuring",
    "rule_layering_mule", "rule_dormant_spike", "rule_cash_intensive", "rule_high_velocity", "rule_watchlist_pep",
    "rule_smurfing", "rule_circular_flow", "circular_flow_nb", "all_rule_hits", "circular_flags", "feature_matrix",
    "standard_scale", "typology_label", "ml_flags", "kpi_all", "country_flagged_amount", "alert_queue",
    "inv_account_history", "inv_account_dossier", "inv_connections", "inv_three_hop", "inv_network",
    "graph_edges", "graph_watchlist_reach", "alert_enrich", "stream_structuring", "stream_layering",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    every = queries()
    names = [n for n in (os.environ.get("BENCH_QUERIES") or ",".join(HEADLINE)).split(",") if n in every]
    times: dict[str, float] = {}
    for name in names:
        took = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            every[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        times[name] = round(statistics.median(took[1:]), 3)
    print(json.dumps({
        "metric": "total_warm_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
