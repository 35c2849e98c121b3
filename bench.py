"""Time headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose data and cores.
Each query first runs once on the smallest tables beside (code generation and workers), then up to three times on the
given ones while it is short; the median counts.  Results go to the no-op sink, so every row is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from daypanel.core import get_session  # noqa: E402

HEADLINE = [
    "processed_daily", "prepared_metrics_orders", "ewm_weight_orders", "adaptive_tdee_orders", "tdee_estimates",
    "lagged_corr", "best_lag_bars", "lag_best", "zscore_outliers", "regimes", "recovery_boxes", "activity_regime_runs",
    "weekly_decision", "waterfall_orders", "key_figures", "coverage_month", "session_groups", "session_table", "hr_daily",
    "merge_daily", "merge_sessions", "gap_dates", "sync_dates", "payload_daily", "payload_sessions", "weight_scenarios",
    "goal_progress", "burndown", "stratified_sample", "text_prepare",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", f"local[{cpus}]")
    spark.conf.set("spark.sql.shuffle.partitions", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    small = Path(sf_dir).parent / "sf0.001"
    warm_up = str(small) if small.exists() else sf_dir
    seconds = {}
    for name in names:
        run(QUERIES[name](spark, warm_up))
        taken: list[float] = []
        while len(taken) < 3 and sum(taken) < 6:
            start = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            taken.append(time.perf_counter() - start)
        seconds[name] = round(median(taken), 3)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
