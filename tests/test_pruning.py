"""Facts pruned by the keys of a dimension, and grouping by codes of attributes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shared import SF_DIR, plan_text, rows_of
from sumstone.operators.joins import grouped_by_attributes, maybe_in_keys, star_join, within_keys
from sumstone.plans import catalog
from sumstone.session import scratch_path


def scanned_rows(df) -> int:
    """Rows that the scans of the executed plan handed on, by their metrics."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        elif name.startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


@pytest.fixture(scope="module")
def facts(spark):
    """30 row groups in order of the key; a null key and one of a wider type among them."""
    path = scratch_path(spark, "facts")
    rows = spark.range(0, 30_000, 1, 30).select(
        F.when(F.col("id") % 1000 != 7, F.col("id")).cast("int").alias("k"), F.xxhash64("id").alias("v")
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_row_groups_outside_the_keys_are_not_read(spark, facts):
    dim = spark.range(12_100, 12_900).select("id")
    kept = within_keys(facts, dim, "k", "id")
    assert kept.count() == 800
    assert scanned_rows(kept.select("v")) == 1_000
    assert "GreaterThanOrEqual(k,12100), LessThanOrEqual(k,12899)" in plan_text(kept)
    far = dim.unionByName(spark.range(1 << 40, (1 << 40) + 1))
    assert within_keys(facts, far, "k", "id").filter("k < 12900").count() == 800
    assert within_keys(facts, dim.limit(0), "k", "id").count() == 0


def test_joins_do_not_change_by_pruning(spark, facts):
    dim = spark.range(100, 29_000, 37).select("id", (F.col("id") % 3).cast("string").alias("name"))
    plain = star_join(facts, [(dim, "k", "id")])
    for bits in (64, 1 << 14, 1 << 20):
        kept = maybe_in_keys(within_keys(facts, dim, "k", "id"), dim, "k", "id", bits)
        assert rows_of(star_join(kept, [(dim, "k", "id")])) == rows_of(plain)
    assert kept.count() < 1.1 * plain.count()  # a wide field keeps few foreign keys
    text = facts.select(F.col("k").cast("string").alias("k"), "v")
    named = dim.select(F.col("id").cast("string").alias("id"))
    assert maybe_in_keys(text, named, "k", "id").join(named, F.col("k") == F.col("id")).count() == plain.count()
    assert maybe_in_keys(facts, dim.limit(0), "k", "id").count() == 0


def test_the_field_is_tested_before_the_shuffle(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_text(catalog.QUERIES["star_pruned"](spark, SF_DIR))
    assert "getbit" in plan or "bit_get" in plan
    lines = [line for line in plan.splitlines() if "getbit" in line or "bit_get" in line]
    assert any("Filter" in line and "l_orderkey" in line for line in lines)


def test_customers_meet_orders_and_parts_are_met_once(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_text(catalog.QUERIES["star_pruned"](spark, SF_DIR))
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert sum("(l_partkey" in line for line in moved) == 1
    assert plan.index("(o_custkey") > plan.index("(l_orderkey")  # below the join with the lines


def test_facts_do_not_move_to_the_calendar(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_text(catalog.QUERIES["star_report_sales"](spark, SF_DIR))
    assert "hashpartitioning(DateID" not in plan and "BroadcastHashJoin [DateID" in plan


def test_codes_group_as_attributes_do(spark):
    fact = spark.createDataFrame(
        [(1, 10, 1.0), (2, 10, 2.0), (3, 20, 4.0), (4, 20, 8.0), (5, None, 16.0), (9, 10, 32.0), (None, 10, 64.0)],
        "a int, b int, v double",
    )
    # Two keys share a name, one key has two rows, a name is NULL.
    first = spark.createDataFrame(
        [(1, "x", None), (2, "x", None), (3, None, "s"), (4, "y", "s"), (5, "y", "s"), (4, "z", "t")],
        "ka bigint, name string, kind string",
    )
    second = spark.createDataFrame([(10, "p"), (20, "p")], "kb int, other string")
    found = grouped_by_attributes(
        fact,
        [(first, "a", "ka", ["name", "kind"]), (second, "b", "kb", ["other"])],
        [],
        {"total": F.sum("v"), "n": F.count("v")},
    )
    joined = star_join(fact, [(first, "a", "ka"), (second, "b", "kb")])
    wanted = joined.groupBy("name", "kind", "other").agg(F.sum("v").alias("total"), F.count("v").alias("n"))
    assert rows_of(found) == rows_of(wanted) and found.count() == 4
