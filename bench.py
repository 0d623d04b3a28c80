"""Time the headline queries and print one JSON line.

The session starts before the clock and each query runs once to warm up the JVM; the best of the
timed runs counts.  Results go to Spark's ``noop`` sink: every row is computed, none is collected.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from sumstone import build_session
from sumstone.plans import catalog

HEADLINE = [
    "events_channel_top10",
    "revenue_by_flag",
    "star_sales",
    "mean_by_category",
    "net_revenue_flag",
    "monthly_volume",
    "top_rejects",
    "traffic_validation",
    "crosstab_counts",
    "value_counts_top7",
    "top_segment_hue",
    "box_stats",
    "top_suppliers",
    "top_parts_rounded",
    "filter_compute",
    "group_stats",
    "left_join_m2o",
    "rolling_2h",
    "rank_in_user",
    "strings_flag",
    "resample_dense",
    "tumbling_sparse",
    "pivot_mean_bucket",
    "sort_mixed",
    "csv_roundtrip",
    "csv_to_parquet",
    "arrow_ipc_roundtrip",
    "stream_sum_equals_batch",
]


def main() -> None:
    scratch = os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="sumstone-bench-")
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    spark = build_session(
        "sumstone-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": f"file://{scratch}",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:]), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
