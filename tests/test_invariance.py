"""Same result for every partitioning and for every strategy of an operator."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shared import SF_DIR, rows_of
from sumstone.functions.exact import exact_mean, exact_sum
from sumstone.functions.scalar import epoch_micros
from sumstone.operators import aggregate as agg
from sumstone.operators.ordered import ordinal_rank, running_totals
from sumstone.operators.quantiles import box_stats, quantiles_by
from sumstone.operators.setops import frames_equal
from sumstone.operators.timeseries import resample, rolling_mean, tumbling
from sumstone.plans.registry import table
from sumstone.plans.reports import star_report

TWO_HOURS = dt.timedelta(hours=2)


@pytest.fixture
def skewed(spark):
    """A third of the rows in one key, a third at one instant, nulls in every column."""
    rnd = random.Random(7)
    start = dt.datetime(2024, 3, 1)
    rows = []
    for i in range(1_500):
        key = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "c", None])
        at = start + dt.timedelta(
            hours=5, microseconds=0 if i % 3 == 1 else rnd.randrange(0, 86_400_000_000)
        )
        rows.append(
            (i, key, None if i % 50 == 2 else at, None if i % 40 == 5 else rnd.randrange(2_000) / 100)
        )
    return spark.createDataFrame(rows, "id int, k string, ts timestamp_ntz, v double")


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_exact_figures_do_not_depend_on_partitions(spark, parts):
    lines = table(spark, SF_DIR, "lineitem")
    figures = {
        "s": exact_sum(F.col("l_extendedprice")),
        "m": exact_mean(F.col("l_discount")),
        "d": agg.distinct_count("l_partkey"),
    }
    wanted = rows_of(agg.grouped(lines, ["l_returnflag"], figures))
    assert rows_of(agg.grouped(lines.repartition(parts), ["l_returnflag"], figures)) == wanted


def test_running_totals_equal_the_plain_window(spark, skewed):
    df = skewed.filter("v IS NOT NULL").select("id", "k", "v")
    window = Window.partitionBy("k").orderBy("v", "id")
    plain = df.withColumn("n", F.row_number().over(window).cast("bigint"))
    for parts in (1, 2, 9):
        ranged = running_totals(df, ["k"], ["v", "id"], {"n": F.lit(1).cast("bigint")}, parts)
        assert frames_equal(plain, ranged.select(*plain.columns))
    whole = running_totals(df, [], ["v", "id"], {"n": F.lit(1).cast("bigint")}, 5)
    assert sorted(r.n for r in whole.collect()) == list(range(1, df.count() + 1))


def test_rank_over_ranges_equals_rank_by_window(spark, skewed):
    plain = ordinal_rank(skewed, ["k"], "v", "id")
    window = Window.partitionBy("k").orderBy(F.col("v").asc_nulls_last(), "id")
    number = F.when(F.col("v").isNotNull(), F.row_number().over(window).cast("bigint"))
    assert frames_equal(plain, skewed.withColumn("rank", number).select(*plain.columns))
    for hot in (1, 300):
        split = ordinal_rank(skewed, ["k"], "v", "id", hot=hot)
        assert frames_equal(plain, split.select(*plain.columns))
    assert plain.filter("v IS NULL AND rank IS NOT NULL").count() == 0


def test_rank_with_a_hot_null_key(spark, skewed):
    df = skewed.withColumn("k", F.when(F.col("k") != "hot", F.col("k")))
    plain = ordinal_rank(df, ["k"], "v", "id")
    split = ordinal_rank(df, ["k"], "v", "id", hot=100)
    assert frames_equal(plain, split.select(*plain.columns))


def test_quantiles_over_ranges_equal_percentile(spark, skewed):
    probs = {"p0": 0.0, "q1": 0.25, "m": 0.5, "p93": 0.93, "p100": 1.0}
    exact = skewed.groupBy("k").agg(
        *[F.percentile("v", F.lit(p)).alias(n) for n, p in probs.items()]
    )
    for accuracy in (10_000, 100, 20):
        found = quantiles_by(skewed, ["k"], "v", probs, accuracy=accuracy)
        assert frames_equal(exact, found, digits=9)
    one = box_stats(skewed, ["k"], "v")
    assert frames_equal(one, box_stats(skewed, ["k"], "v", accuracy=20), digits=9)
    close = quantiles_by(skewed, ["k"], "v", {"m": 0.5}, approximate=True)
    assert close.count() == 5


@pytest.mark.parametrize("width", [TWO_HOURS, dt.timedelta(seconds=1), dt.timedelta(days=3)])
def test_rolling_mean_equals_the_plain_range_window(spark, skewed, width):
    micros = int(width.total_seconds() * 1_000_000)
    window = Window.orderBy("t").rangeBetween(-(micros - 1), 0)
    wanted = (
        skewed.withColumn("t", epoch_micros(skewed, "ts"))
        .withColumn("s", F.sum(F.col("v").cast("decimal(18,2)")).over(window).cast("double"))
        .withColumn("m", F.try_divide("s", F.count("v").over(window).cast("double")))
        .withColumn("m", F.when(F.col("t").isNotNull(), F.col("m")))
        .select("id", "m")
    )
    for ranges in (None, 1, 50):
        found = rolling_mean(skewed, "ts", "v", width, "m", scale=2, ranges=ranges).select("id", "m")
        assert frames_equal(wanted, found)


def test_rolling_mean_edges(spark):
    start = dt.datetime(1969, 12, 31, 22, 0)
    hours = [0, 2, 2, 4, 3.9999999]
    df = spark.createDataFrame(
        [(i, start + dt.timedelta(hours=h), float(i + 1)) for i, h in enumerate(hours)],
        "id int, ts timestamp_ntz, v double",
    )
    means = {r.id: r.m for r in rolling_mean(df, "ts", "v", TWO_HOURS, "m").collect()}
    # Exactly two hours apart is outside; equal times see each other.
    assert means == {0: 1.0, 1: 2.5, 2: 2.5, 4: pytest.approx(10 / 3), 3: 4.5}


def test_rolling_mean_of_tiny_and_unbounded_values(spark):
    start = dt.datetime(2024, 1, 1)
    values = [4e-7, float("nan"), 1.0, float("inf"), 2.0, None, 5e13]
    df = spark.createDataFrame(
        [(i, start + dt.timedelta(hours=3 * i), v) for i, v in enumerate(values)],
        "id int, ts timestamp_ntz, v double",
    )
    means = {r.id: r.m for r in rolling_mean(df, "ts", "v", TWO_HOURS, "m").collect()}
    assert means[0] == pytest.approx(4e-7, rel=1e-9) and str(means[1]) == "nan"
    assert (means[2], means[3], means[5]) == (1.0, float("inf"), None)
    assert means[4] == pytest.approx(2.0) and means[6] == pytest.approx(5e13)


def test_zoned_times_and_dates_roll_too(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), 2.0), (2, dt.date(2024, 1, 2), 4.0)],
                               "id int, d date, v double")
    two_days = dt.timedelta(days=2)
    found = {r.id: r.m for r in rolling_mean(df, "d", "v", two_days, "m").collect()}
    assert found == {1: 2.0, 2: 3.0}
    zoned = df.withColumn("d", F.col("d").cast("timestamp"))
    assert {r.id: r.m for r in rolling_mean(zoned, "d", "v", two_days, "m").collect()} == found


def test_results_do_not_depend_on_the_session_zone(spark, conf, skewed):
    def figures():
        rolled = rolling_mean(skewed, "ts", "v", TWO_HOURS, "m", scale=2).select("id", "m")
        buckets = tumbling(skewed, "ts", dt.timedelta(minutes=5), {"n": agg.rows()})
        return rows_of(rolled), rows_of(buckets)

    wanted = figures()
    conf("spark.sql.session.timeZone", "America/New_York")
    assert figures() == wanted


def test_resample_fills_gaps_of_any_length(spark):
    minutes = [0, 4, 21]
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [(start + dt.timedelta(minutes=m), float(m)) for m in minutes], "ts timestamp_ntz, v double"
    )
    five = dt.timedelta(minutes=5)
    found = resample(df, "ts", five, {"m": F.avg("v")})
    values = [r.m for r in found.orderBy("bucket").collect()]
    assert values == [2.0, None, None, None, 21.0]
    ends = df.limit(2).withColumn("ts", F.when(F.col("v") > 1, F.lit(dt.datetime(2624, 1, 1))).otherwise(F.col("ts")))
    year = dt.timedelta(days=1)
    assert resample(ends.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "ts", year, {"m": F.avg("v")}).count() > 219_000
    many = resample(df, "ts", dt.timedelta(seconds=1), {"m": F.avg("v")})
    assert many.count() == 21 * 60 + 1
    assert resample(df.limit(0), "ts", five, {"m": F.avg("v")}).count() == 0


def test_star_report_with_and_without_broadcast(spark, conf):
    from sumstone.functions.calendar import calendar_between
    from sumstone.generators import tables as gen
    from sumstone.generators.draws import row_numbers

    bounds = spark.sql("SELECT DATE'2012-01-01' AS lo, DATE'2026-12-31' AS hi")
    inputs = [
        gen.fact_sales(row_numbers(spark, 3_000)),
        gen.dim_category(row_numbers(spark, 300)),
        calendar_between(bounds, "lo", "hi"),
        gen.dim_store(row_numbers(spark, 2_500)),
        gen.dim_vendor(row_numbers(spark, 600)),
        gen.dim_item(row_numbers(spark, 50_000)),
    ]
    report = star_report(*inputs)
    sold = inputs[0].filter("PartitionKeyYear >= 2022").agg(F.sum("BottlesSold")).first()[0]
    assert report.agg(F.sum("bottles_sold")).first()[0] == sold
    wanted = [tuple(r) for r in report.collect()]
    assert wanted == sorted(wanted, key=lambda r: r[:6])
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert [tuple(r) for r in star_report(*inputs).collect()] == wanted


def test_join_per_group_meets_null_keys(spark, skewed):
    from sumstone.operators.ordered import join_per_group

    per_group = skewed.groupBy("k").agg(F.max("v").alias("top"))
    assert join_per_group(skewed, per_group, ["k"]).count() == skewed.count()


def test_star_report_adds_up_keys_of_one_name(spark):
    from sumstone.functions.calendar import calendar_between
    from sumstone.generators import tables as gen
    from sumstone.generators.draws import row_numbers

    bounds = spark.sql("SELECT DATE'2012-01-01' AS lo, DATE'2026-12-31' AS hi")
    stores = gen.dim_store(row_numbers(spark, 2_500))
    stores = stores.withColumn("StoreName", F.col("City"))  # ten names for 2,500 keys
    vendors = gen.dim_vendor(row_numbers(spark, 600))
    vendors = vendors.unionByName(vendors.filter("VendorID = 700"))  # a key twice
    items = gen.dim_item(row_numbers(spark, 40_000))  # some facts have no item
    items = items.withColumn("ItemName", F.substring("ItemName", 1, 20))
    facts = gen.fact_sales(row_numbers(spark, 5_000))
    calendar = calendar_between(bounds, "lo", "hi")
    categories = gen.dim_category(row_numbers(spark, 300))
    found = star_report(facts, categories, calendar, stores, vendors, items)
    joined = (
        facts.join(calendar.filter("CalendarYear >= 2022"), "DateID")
        .join(stores, "StoreID").join(vendors, "VendorID")
        .join(categories, "CategoryID").join(items, "ItemID")
    )
    wanted = joined.groupBy(found.columns[:6]).agg(
        F.sum(F.col("SaleDollars").cast("decimal(18,2)")).cast("double").alias("total_sales"),
        F.sum("BottlesSold").alias("bottles_sold"),
        F.sum(F.col("VolumeSoldLiters").cast("decimal(18,4)")).cast("double").alias("volume_liters"),
        F.avg("StateBottleRetail").alias("avg_retail"),
        F.avg("StateBottleCost").alias("avg_cost"),
        F.count("ID").alias("transactions"),
    )
    assert found.count() > 500
    assert frames_equal(wanted, found, digits=6)
