"""Time the headline queries; prints one JSON line.

Every query is read in full into a sink that discards the rows, after one untimed
run of a small query to warm the session up.
"""

import json
import os
import sys
import time

from checks.queries import QUERIES
from tachyline.session import build_session

HEADLINE = [
    "parse_flatten",
    "dq_metrics",
    "silver_valid",
    "silver_idempotent",
    "future_wear_rate",
    "rolling_features",
    "label_threshold_exact",
    "label_threshold_approx",
    "gold_features",
    "gold_features_approx",
    "split_counts",
    "classification_report",
    "serving_features_300",
    "session_running_avg",
    "session_summary",
    "score_ema",
    "slow_ema",
    "last_300_history",
    "latest_state",
    "fan_hysteresis",
    "gear_dwell",
    "rpm_zone_time",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cores}]",
        **{
            "spark.sql.shuffle.partitions": cores,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in ["session_summary", *(sys.argv[1:] or HEADLINE)]:
        started = time.perf_counter()
        QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    scale = os.path.basename(directory.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "telemetry queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
