"""Generated tables: schema, value domains, shares, independence of partitioning."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sumstone.generators import draws
from sumstone.generators import tables as gen
from sumstone.operators.setops import frames_equal
from sumstone.plans import reports
from sumstone.sources import schemas

N = 40_000
TABLES = {
    "sales_orders": schemas.SALES_ORDERS,
    "events_wide": schemas.EVENTS_WIDE,
    "events_narrow": schemas.EVENTS_NARROW,
    "region_sales": schemas.REGION_SALES,
    "category_sales": schemas.CATEGORY_SALES,
    "micro": schemas.MICRO,
    "fact_sales": schemas.FACT_SALES,
    "dim_category": schemas.DIM_CATEGORY,
    "dim_store": schemas.DIM_STORE,
    "dim_vendor": schemas.DIM_VENDOR,
    "dim_item": schemas.DIM_ITEM,
}


@pytest.fixture(scope="module")
def ids(spark):
    return draws.row_numbers(spark, N)


@pytest.mark.parametrize("name", sorted(TABLES))
def test_schema_and_partition_independence(spark, name):
    make = getattr(gen, name)
    few = make(draws.row_numbers(spark, 2_000, 1))
    many = make(draws.row_numbers(spark, 2_000, 7))
    loaded = ", Inserted timestamp_ntz" if name == "fact_sales" or name.startswith("dim_") else ""
    wanted = spark.createDataFrame([], TABLES[name] + loaded).dtypes
    assert few.dtypes == wanted
    assert frames_equal(few, many)


def test_draws_are_uniform_and_uncorrelated(spark, ids):
    a, b = draws.uniform(F.col("id"), 1), draws.uniform(F.col("id"), 2)
    stats = ids.agg(
        F.avg(a).alias("mean"),
        F.stddev(a).alias("std"),
        F.corr(a, b).alias("columns"),
        F.corr(a, draws.uniform(F.col("id") + 1, 1)).alias("rows"),
        F.count_distinct(a).alias("values"),
    ).first()
    assert abs(stats["mean"] - 0.5) < 0.01
    assert abs(stats["std"] - 0.2887) < 0.01
    assert abs(stats["columns"]) < 0.02
    assert abs(stats["rows"]) < 0.02
    assert stats["values"] > N * 0.99
    tens = ids.groupBy(draws.below(F.col("id"), 3, 10).alias("d")).count().collect()
    assert len(tens) == 10
    assert all(abs(r["count"] - N / 10) < N / 10 * 0.1 for r in tens)


def test_rows_beyond_two_billion_differ(spark):
    near = spark.range(1_000).select(draws.draw(F.col("id"), 1).alias("x"))
    far = spark.range(1_000).select(draws.draw(F.col("id") + draws.PRIME, 1).alias("x"))
    assert near.join(far, "x").count() < 5


def test_shares_and_moments(spark, ids):
    traffic = gen.traffic(ids)
    row = traffic.agg(
        F.avg((F.col("month") == 6).cast("int")).alias("june"),
        F.avg((F.col("byt") == 0).cast("int")).alias("zero"),
        F.avg((F.col("act") == "ALLOW").cast("int")).alias("allow"),
        F.avg((F.col("protocol") == "UDP").cast("int")).alias("udp"),
        F.avg((F.col("dst_port") == 443).cast("int")).alias("https"),
        F.min("src").alias("src"),
        F.max("dst").alias("dst"),
    ).first()
    assert abs(row.june - (0.35 + 0.65 / 12)) < 0.02
    assert abs(row.zero - 0.30) < 0.02
    assert abs(row.allow - 0.75) < 0.02
    assert abs(row.udp - 0.19) < 0.02
    assert abs(row.https - 0.50) < 0.02
    assert row.src >= 10 << 24 and row.dst > 4_000_000_000

    sales = gen.category_sales(ids).agg(F.avg("sales"), F.stddev("sales")).first()
    assert abs(sales[0] - 500) < 3 and abs(sales[1] - 100) < 3

    revenue = gen.events_narrow(ids).agg(
        F.avg((F.col("revenue") == 0).cast("int")), F.avg(F.when(F.col("revenue") > 0, F.col("revenue")))
    ).first()
    assert abs(revenue[0] - 0.15) < 0.02 and abs(revenue[1] - 60) < 2

    wide = gen.events_wide(ids).agg(
        F.avg(F.col("is_new_customer").cast("int")),
        F.avg((F.col("discount_pct") > 0).cast("int")),
        F.min("event_date").cast("string"),
        F.max("event_date").cast("string"),
        F.count_distinct("country"),
    ).first()
    assert abs(wide[0] - 0.3) < 0.02 and abs(wide[1] - 0.4) < 0.02
    assert tuple(wide)[2:] == ("2023-01-01", "2026-08-05", 50)


def test_facts_fit_their_dimensions(spark, ids):
    facts = gen.fact_sales(ids)
    stores = gen.dim_store(draws.row_numbers(spark, gen.STORE_COUNT))
    assert facts.join(stores, "StoreID", "left_anti").count() == 0
    wrong = facts.filter(
        (F.abs(F.col("SaleDollars") - F.col("StateBottleRetail") * F.col("BottlesSold")) > 0.005)
        | (F.col("PartitionKeyYear") != F.floor(F.col("DateID") / 10_000))
        | (F.length("InvoiceItemNumber") != 14)
    )
    assert wrong.count() == 0
    top = reports.top_stores(facts, stores).collect()
    assert len(top) == 5 and top[0].total_sales_dollars >= top[4].total_sales_dollars
    categories = gen.dim_category(draws.row_numbers(spark, gen.CATEGORY_COUNT))
    assert reports.top_categories(facts, categories).count() == 5


def test_reports_over_generated_inputs(spark, ids):
    traffic = gen.traffic(ids)
    board = reports.executive_dashboard(traffic)
    assert len(board["monthly_traffic"]) == 12 and len(board["top_rejects"]) == 10
    check = reports.traffic_validation(traffic).first()
    assert (check.rows, check.min_year, check.max_year) == (N, 2024, 2024)
    assert reports.monthly_bytes(traffic).count() == 12
    assert reports.revenue_by(gen.region_sales(ids)).count() == 5
    assert reports.mean_by(gen.category_sales(ids)).count() == 4
    assert reports.net_revenue_by(gen.sales_orders(ids)).count() == 4
    narrow = reports.top_channels(gen.events_narrow(ids), "2025-01-01", ["US", "UK", "DE"])
    assert narrow.count() == 10


def test_census_reports(spark):
    rows = []
    for i in range(300):
        work = ["Private", "State", "?", "Local"][i % 4]
        income = ">50K" if i % 3 == 0 else "<=50K"
        rows.append((str(20 + i % 50), work, ["HS", "BA"][i % 2], ["Exec", "Tech"][i % 2],
                     ["Male", "Female"][i % 2], str(30 + i % 20), income))
    census = spark.createDataFrame(
        rows,
        "age string, workclass string, education string, occupation string, sex string, "
        "`hours.per.week` string, income string",
    )
    for c in ("fnlwgt", "education.num", "capital.gain", "capital.loss"):
        census = census.withColumn(c, F.lit("1"))
    cleaned = reports.census_clean(census)
    assert cleaned.count() == 225
    assert dict(cleaned.dtypes)["hours_per_week"] == "bigint"
    for by in ("education", "sex"):
        assert reports.income_crosstab(cleaned, by).columns == [by, "<=50K", ">50K"]
    assert reports.top_workclasses(cleaned, 2).count() == 2
    assert reports.top_occupations(cleaned).count() == 2
    assert reports.workclass_by_income(cleaned, 2).count() == 4
    assert reports.income_boxes(cleaned, "age").count() == 2
