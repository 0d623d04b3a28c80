"""Incremental queries: equal to batch, restartable, with a bound on lateness."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shared import SF_DIR, rows_of
from sumstone import scratch_path
from sumstone.operators import aggregate as agg
from sumstone.plans.registry import table
from sumstone.session import LARGE_STATE
from sumstone.sources.schemas import TABLES
from sumstone.streaming import incremental as inc

FIVE = dt.timedelta(minutes=5)
SCHEMA = "ts timestamp_ntz, v double"


IN_MEMORY = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    )
}


@pytest.mark.parametrize("options", [IN_MEMORY, LARGE_STATE])
def test_many_files_equal_one_batch_and_restart_adds_nothing(spark, conf, options):
    for key, value in options.items():
        conf(key, value)
    source = scratch_path(spark, "in")
    orders = table(spark, SF_DIR, "orders")
    orders.repartition(6).write.parquet(source)
    target, state = scratch_path(spark, "out"), scratch_path(spark, "state")

    def run():
        stream = inc.read_file_stream(spark, source, TABLES["orders"], files_per_batch=2)
        totals = inc.incremental_aggregate(
            stream, ["o_orderstatus"], {"n": agg.rows(), "top": F.max("o_totalprice")}
        )
        return rows_of(inc.complete_result(totals, target, state))

    wanted = rows_of(
        agg.grouped(orders, ["o_orderstatus"], {"n": agg.rows(), "top": F.max("o_totalprice")})
    )
    assert run() == wanted
    assert run() == wanted
    orders.write.mode("append").parquet(source)
    assert run() == [(s, 2 * n, top) for s, n, top in wanted]
    assert len(os.listdir(target)) <= 2


def test_late_rows_are_dropped_and_open_windows_held_back(spark):
    source, target, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    start = dt.datetime(2024, 1, 1)

    def add(*minutes):
        rows = [(start + dt.timedelta(minutes=m), float(m)) for m in minutes]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = inc.read_file_stream(spark, source, SCHEMA)
        counts = inc.incremental_tumbling(stream, "ts", FIVE, {"n": agg.rows()}, late=FIVE)
        return {
            r.bucket.minute: r.n for r in inc.appended_result(counts, target, state).collect()
        }

    add(0, 1, 7)
    assert run() == {}
    add(16)
    assert run() == {0: 2, 5: 1}
    add(2, 12, 30)  # minute 2 is older than the watermark (11), minute 12 is not
    assert run() == {0: 2, 5: 1, 10: 1, 15: 1}


def test_conversion_is_exactly_once(spark):
    source, target, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    df = spark.range(100).select("id", (F.col("id") * 2).cast("string").alias("s"))
    df.repartition(3).write.option("header", True).csv(source)

    def run():
        stream = inc.read_file_stream(spark, source, "id bigint, s string", "csv")
        return inc.convert_stream(stream, target, state)

    assert rows_of(run()) == rows_of(df)
    assert rows_of(run()) == rows_of(df)


def test_batches_write_what_they_changed(spark):
    source, target, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    schema = "k string, v bigint"

    def add(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = inc.read_file_stream(spark, source, schema, files_per_batch=1)
        totals = inc.incremental_aggregate(stream, ["k"], {"n": agg.rows(), "total": F.sum("v")})
        return rows_of(inc.changed_result(totals, ["k"], target, state, merge_every=4))

    def written():
        folders = [p for p in os.listdir(target) if p.startswith("batch=")]
        return {int(p[6:]): spark.read.parquet(f"{target}/{p}").count() for p in folders}

    add(*[(f"k{i}", 1) for i in range(300)], (None, 5))
    assert len(run()) == 301 and written() == {0: 301}
    add(("k7", 10), (None, 1))
    told = dict((k, (n, v)) for k, n, v in run())
    assert told["k7"] == (2, 11) and told[None] == (2, 6) and told["k8"] == (1, 1)
    assert written() == {0: 301, 1: 2}
    assert len(run()) == 301 and written() == {0: 301, 1: 2}  # a restart without input adds nothing
    wanted = dict(told)
    for i in range(8):
        add(("k9", 1), (f"new{i}", i))
        n, v = wanted["k9"]
        wanted["k9"], wanted[f"new{i}"] = (n + 1, v + 1), (1, i)
        assert dict((k, (n, v)) for k, n, v in run()) == wanted
    # Batch 8 holds all keys, and those before it went with the next.
    assert written() == {8: 308, 9: 2}
