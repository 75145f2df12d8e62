"""Benchmark: wall time of the headline queries, one JSON line on standard output."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from loomcast.plans.queries import QUERIES  # noqa: E402
from loomcast.session import build_session  # noqa: E402

HEADLINE = (
    "flagship_naive_forecasts",
    "wn01_lag",
    "wn01_lag_daily",
    "wn01_lag_single_series",
    "wn03_trailing_mean",
    "wn04_trailing_std",
    "wn06_lead_targets",
    "wn08_chronological_split",
    "wn11_keep_first",
    "wn13_decomposition",
    "wn14_calendar_grid",
    "ud03_hourly_features",
    "ud03_daily_features",
    "ag02_exact_quantiles",
    "ag03_iqr_fences",
    "ag07_correlation_matrix",
    "ag09_forecast_metrics",
    "ag11_winning_model",
    "ag15_daily_from_hourly",
    "ag16_mutual_information",
    "fl07_time_lookup",
    "jn05_predictions_with_actuals",
    "jn09_enough_history",
    "ml03_preprocess",
    "ml06_linear_horizons",
    "ml09_lasso_one_feature",
    "ml11_model_inventory",
    "sf01_cyclical",
    "sf03_calendar_parts",
    "sf19_time_texts",
    "sf23_reply_to_record",
    "tk01_latest_rows",
    "in04_monitoring",
    "in05_refresh_features",
)


def run(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    spent = time.perf_counter() - started
    spark.catalog.clearCache()
    return spent


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", cpus, shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, folder)  # one run to warm up, not timed
        seconds[name] = round(statistics.median(run(spark, name, folder) for _ in range(repeats)), 3)
    line = {
        "metric": "total wall time of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
