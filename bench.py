"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]: one warm-up pass over all queries, then $BENCH_RUNS timed
rounds (interleaved); each query reports the median of its rounds.
Each run executes the whole plan into Spark's ``noop`` sink (nothing is
collected to the driver). Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskweave.plans.bound import REGISTRY  # noqa: E402
from riskweave.session import build_session  # noqa: E402

HEADLINE = [
    "true_exposure_summary", "breach_alerts", "hidden_exposure", "known_exposure",
    "exposure_before_resolution", "exposure_after_resolution", "resolution_breakdown",
    "resolution_trend", "exceptions_queue", "resolve_by_variant", "resolve_by_key",
    "fuzzy_candidates", "parent_rollup", "encumbrance_view", "limit_utilisation",
    "exposure_trend", "collateral_value", "aggregate_then_join", "reconcile", "flat_daily_fact",
    "check_constraints", "freshness", "measure_query", "net_exposure", "exposure_profile",
    "stressed_pfe", "cva", "cva_cs01", "discounted_pv", "cs01", "weighted_capital", "pnl_explain",
    "direct_access", "inherit_classification",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    if names == ["all"]:
        names = sorted(REGISTRY)
    spark = build_session(f"local[{cpus}]", app="riskweave-bench",
                          shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", int(cpus) * 2)),
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    def run(name: str) -> float:
        t0 = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:          # one warm-up pass over every query (JIT, file listing caches)
        run(name)
    samples: dict[str, list[float]] = {n: [] for n in names}
    for _ in range(runs):       # timed rounds, interleaved so no query always runs first
        for name in names:
            samples[name].append(run(name))
    times = {n: round(statistics.median(v), 3) for n, v in samples.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "runs": runs, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
