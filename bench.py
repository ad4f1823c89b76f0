"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default: all)
BENCH_ONLY    comma-separated names, to time a few
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "carrier_effect_lagged",
    "customer_effect_lagged",
    "special_day_effect",
    "prev_event_tracker",
    "station_shortlist",
    "hourly_rollup",
    "hour_key_join",
    "interval_join",
    "joined_table",
    "utc_convert",
    "dedup_rows",
    "key_audit",
    "distinct_counts",
    "null_audit",
    "mean_impute",
    "percent_rank_global",
    "percent_rank_events",
    "percent_rank_by_year",
    "blocking_folds",
    "downsample",
    "downsample_by_year",
    "upsample",
    "pagerank_by_year",
    "engineered_features",
    "pearson_matrix",
    "spearman_matrix",
    "threshold_table",
    "roc_pr_curve",
    "auc",
    "vote_ensemble",
    "error_slices",
    "model_lr",
    "model_gbt",
]


def run_all(spark, folder: str, names: list[str]) -> dict[str, float]:
    from delaykit.catalogue import REGISTRY

    seconds = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    return seconds


def main() -> None:
    from delaykit.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    only = os.environ.get("BENCH_ONLY")
    names = only.split(",") if only else HEADLINE
    conf = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()

    seconds = run_all(spark, folder, names)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
