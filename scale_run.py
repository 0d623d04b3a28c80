"""Time the reports at the sizes they are known for, over generated inputs.

``SCALE_DIR`` holds the inputs (made on the first run, by Spark, with the library's generators);
``SCALE_SHARE`` shrinks every row count.  Prints one JSON line; nothing is asserted.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sumstone import build_session, scratch_path
from sumstone.functions.calendar import calendar_between
from sumstone.generators import tables as gen
from sumstone.generators.draws import row_numbers
from sumstone.plans import reports
from sumstone.sources import readers, schemas, writers


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    share = float(os.environ.get("SCALE_SHARE", "1"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = build_session(
        "sumstone-scale",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": str(2 * int(cpus)),
            "spark.driver.memory": "20g",
            "spark.checkpoint.dir": os.environ["SCALE_SCRATCH"],
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = os.environ.get("SCALE_DIR") or scratch_path(spark, "scale")

    def rows(n: float) -> DataFrame:
        return row_numbers(spark, int(n * share), 2 * int(cpus))

    made: dict[str, float] = {}

    def need(name: str, make: Callable[[], DataFrame], fmt: str = "parquet") -> str:
        path = f"{root}/{name}"
        if not os.path.exists(path):
            start = time.perf_counter()
            write = writers.write_csv if fmt == "csv" else writers.write_parquet
            write(make(), path)
            made[name] = round(time.perf_counter() - start, 2)
        return path

    region = need("region_sales", lambda: gen.region_sales(rows(50e6)))
    events = need("events.csv", lambda: gen.events_narrow(rows(20e6)), "csv")
    category = need("category_sales.csv", lambda: gen.category_sales(rows(20e6)), "csv")
    orders = need("sales_orders.csv", lambda: gen.sales_orders(rows(10e6)), "csv")
    micro = need("micro", lambda: gen.micro(rows(5e6)).withColumn("row", F.monotonically_increasing_id()))
    facts = need("facts", lambda: gen.fact_sales(rows(10e6)))
    traffic = need("traffic", lambda: gen.traffic(rows(10e6)))

    bounds = spark.sql("SELECT DATE'2012-01-01' AS lo, DATE'2026-12-31' AS hi")
    dims = {
        "dim_category": lambda: gen.dim_category(row_numbers(spark, gen.CATEGORY_COUNT)),
        "dim_date": lambda: calendar_between(bounds, "lo", "hi"),
        "dim_store": lambda: gen.dim_store(row_numbers(spark, gen.STORE_COUNT)),
        "dim_vendor": lambda: gen.dim_vendor(row_numbers(spark, gen.VENDOR_COUNT)),
        "dim_item": lambda: gen.dim_item(row_numbers(spark, gen.ITEM_COUNT)),
    }
    star = [need(n, m) for n, m in dims.items()]

    def read(path: str) -> DataFrame:
        return readers.read_parquet(spark, path)

    def weights() -> DataFrame:
        return gen.micro_dimension(row_numbers(spark, 200_000))

    queries: dict[str, Callable[[], DataFrame]] = {
        "N1 events csv 20M": lambda: reports.top_channels(
            readers.read_csv(spark, events, schema=schemas.EVENTS_NARROW),
            "2025-01-01",
            ["US", "UK", "DE"],
            dense_ids=True,
        ),
        "N2 revenue by region 50M": lambda: reports.revenue_by(read(region)),
        "N3 star 10M": lambda: reports.star_report(read(facts), *[read(p) for p in star]),
        "N4 mean by category csv 20M": lambda: reports.mean_by(
            readers.read_csv(spark, category, schema=schemas.CATEGORY_SALES)
        ),
        "N5 net revenue csv 10M": lambda: reports.net_revenue_by(
            readers.read_csv(spark, orders, schema=schemas.SALES_ORDERS)
        ),
        "N6 monthly traffic 10M": lambda: reports.monthly_traffic(read(traffic)),
        "N7 top rejected 10M": lambda: reports.top_rejected(read(traffic)),
        "N13 top stores 10M": lambda: reports.top_stores(read(facts), read(star[2])),
        "N14 filter 5M": lambda: reports.filter_and_score(read(micro)),
        "N14 group statistics 5M": lambda: reports.group_statistics(read(micro)),
        "N14 left join 5M": lambda: reports.with_weight(read(micro), weights()),
        "N14 rolling and rank 5M": lambda: reports.rolling_and_rank(read(micro), "row"),
        "N14 strings 5M": lambda: reports.text_flag(read(micro)),
        "N14 resample 5M": lambda: reports.five_minute_means(read(micro), dense=True),
        "N14 pivot 5M": lambda: reports.bucket_pivot(read(micro)),
    }
    seconds: dict[str, float] = {}
    for name, query in queries.items():
        times = []
        for _ in range(repeats):
            start = time.perf_counter()
            query().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    print(json.dumps({"share": share, "cpus": int(cpus), "made": made, "queries": seconds}))


if __name__ == "__main__":
    main()
