"""Time the headline queries; prints one JSON line.

Every query is written to a sink that discards rows, so all columns are computed and
nothing is collected. Each is run twice and the faster run counts: the first one also pays
for code generation. A few untimed runs warm up the JVM before that.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from riskloom.plans import catalog  # noqa: E402
from riskloom.session import local_session  # noqa: E402

HEADLINE = [
    "features",
    "features_ties",
    "features_skewed",
    "features_dense",
    "trailing_24h_half_open",
    "feature_store_rows",
    "validated_rows",
    "rule_counts",
    "normalised_rows",
    "upsert_raw",
    "upsert_scores",
    "global_positions",
    "pr_curve",
    "best_f1",
    "areas",
    "alert_budgets",
    "curve_samples",
    "walk_forward_folds",
    "exact_quantiles",
    "scored_contract",
    "buckets_daily",
    "histogram",
    "top_scored",
    "alerts",
    "profile_dataset",
    "profile_rows_in_24h",
    "profile_amounts_by_label",
    "isolation_forest_scores",
    "ingest_replay",
]

WARM_UP = ["features", "features_ties", "pr_curve", "features", "exact_quantiles"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cores, partitions=int(cores) if cores.isdigit() else 8)

    def run(name: str) -> float:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in WARM_UP:
        run(name)
    times = {name: round(min(run(name), run(name)), 3) for name in wanted}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
