"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then REPEATS times into a sink that discards rows; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from kilnwatt.checks.queries import QUERIES
from kilnwatt.session import build_session, drop_materialised

HEADLINE = (
    "features_full",
    "features_analysis",
    "win_ma_96",
    "win_slot_halo",
    "win_cum_daily",
    "agg_describe",
    "agg_iqr_summary",
    "agg_boxplot",
    "agg_histogram",
    "agg_daily_resample",
    "agg_week_status",
    "agg_anomaly_summary",
    "flt_iqr",
    "stream_tariff_cost",
    "join_left_anti",
    "join_insert_ignore",
    "topk_latest_anomalies",
    "scan_ordered",
    "sink_processed",
    "st_enrich",
    "st_poll_features",
    "st_dedup",
)
REPEATS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "kilnwatt-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__driver__host="127.0.0.1",
        spark__driver__bindAddress="127.0.0.1",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = os.environ.get("BENCH_QUERIES")
    timings: dict[str, float] = {}
    for name in wanted.split(",") if wanted else HEADLINE:
        runs = []
        for _ in range(REPEATS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(runs[1:]), 3)
    drop_materialised(spark)
    spark.stop()
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
