"""The physical plans are the ones meant for large tables."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from shared import SF_DIR, plan_text
from sumstone.operators import aggregate as agg
from sumstone.operators import quantiles
from sumstone.operators.filters import from_year
from sumstone.operators.joins import star_join
from sumstone.operators.timeseries import rolling_mean
from sumstone.plans import catalog, report_queries
from sumstone.plans.registry import table


def plan_of(spark, name: str) -> str:
    return plan_text(catalog.QUERIES[name](spark, SF_DIR))


def test_no_query_multiplies_rows(spark):
    for name in catalog.QUERIES:
        if name.startswith(("csv", "stream", "arrow", "parquet")):
            continue
        plan = plan_of(spark, name)
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "events_channel_top10")
    assert "GreaterThanOrEqual(ts" in plan
    assert "In(event_type" in plan
    assert "GreaterThan(value,0.0)" in plan
    assert "props" not in plan
    assert "TakeOrderedAndProject" in plan


def test_year_filter_is_a_range_on_the_column(spark):
    orders = table(spark, SF_DIR, "orders")
    plan = plan_text(orders.filter(from_year(orders, "o_orderdate", 1998)))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01" in plan


def test_distinct_count_is_spread_over_key_and_value(spark):
    events = table(spark, SF_DIR, "events")
    plan = plan_text(agg.grouped(events, ["event_type"], {"u": agg.distinct_count("user_id")}))
    assert re.search(r"hashpartitioning\(event_type#\d+, user_id#\d+L", plan)


def test_top_k_does_not_sort_globally(spark):
    for name in ("top_rejects", "value_counts_top7", "top_suppliers"):
        plan = plan_of(spark, name)
        assert "TakeOrderedAndProject" in plan
        assert "rangepartitioning" not in plan


def test_star_join_broadcasts_small_sides_only(spark, conf):
    plan = plan_of(spark, "star_sales")
    assert plan.count("BroadcastHashJoin") == 5
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(spark, "star_sales")
    assert plan.count("SortMergeJoin") == 5
    assert "BroadcastHashJoin" not in plan


def test_hot_join_key_is_split(spark, conf):
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }.items():
        conf(key, value)
    fact = spark.range(0, 60_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"),
        F.xxhash64("id").alias("n"),
    )
    dim = spark.range(60_000).select(F.col("id").alias("k"), (F.col("id") % 5).alias("w"))
    joined = star_join(fact, [(dim, "k", "k")])
    assert joined.agg(F.sum("w"), F.count("n")).first()[1] == 60_000
    counted = joined.agg(F.sum("w"), F.max("n"))
    counted.collect()
    assert "skew=true" in plan_text(counted)


def test_rolling_mean_has_one_small_unpartitioned_window(spark):
    events = table(spark, SF_DIR, "events")
    hours = dt.timedelta(hours=2)
    rolled = rolling_mean(events, "ts", "value", hours)
    plan = plan_text(rolled)
    # The single task sees one row per range of time, after an aggregation by range.
    single = plan.split("Exchange SinglePartition")
    assert len(single) == 2
    assert re.match(r"[^\n]*\n[^\n]*HashAggregate\(keys=\[_range", single[1])
    # Rows are added up by instant before they move, and running totals take one exchange more.
    assert plan.count("Window [sum(") == 2


def test_unused_flag_is_removed(spark):
    report = report_queries.reports.net_revenue_by(
        table(spark, SF_DIR, "lineitem"),
        ["l_linestatus"],
        sales="l_extendedprice",
        quantity="l_quantity",
    )
    assert "high" not in plan_text(report)


def test_distinct_counts_do_not_multiply_rows(spark):
    assert "Expand" not in plan_of(spark, "traffic_validation")


def test_quantiles_are_not_sorted_or_written(spark):
    lines = table(spark, SF_DIR, "lineitem")
    plan = plan_text(quantiles.box_stats(lines, ["l_returnflag"], "l_extendedprice"))
    assert "rangepartitioning" not in plan and "Sort " not in plan and "Window" not in plan


def test_quantiles_do_not_shuffle_rows_to_meet_their_group(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in ("box_stats", "box_stats_over_ranges"):
        plan = plan_of(spark, name)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, name


def test_ranks_move_rows_once(spark):
    plan = plan_of(spark, "rank_in_user")
    assert plan.count("Exchange ") == 1
