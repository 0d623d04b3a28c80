"""Sources, sinks and streams bound to the test tables.

Each query writes a whole table to a fresh folder below the shared scratch folder and reads it
back, so the SQL beside it is a query over the original table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sumstone.functions.exact import exact_mean, exact_sum
from sumstone.operators import aggregate as agg
from sumstone.operators import checks
from sumstone.operators.clean import plain_names
from sumstone.operators.setops import append_summary, stack
from sumstone.plans.registry import register, table
from sumstone.plans.reports import FIVE_MINUTES
from sumstone.session import scratch_path
from sumstone.sources import arrow_ipc, readers, writers
from sumstone.sources.schemas import TABLES
from sumstone.streaming import incremental as inc

_ORDERS_SQL = "SELECT * FROM orders"


# --- CSV ------------------------------------------------------------------------------------


@register("csv_roundtrip", "S1 S2 K1", _ORDERS_SQL)
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    writers.write_csv(table(spark, sf, "orders"), path)
    return readers.read_csv(spark, path, schema=TABLES["orders"])


@register(
    "csv_inferred",
    "S1 A3",
    """
    SELECT c_mktsegment, count(*) AS n, max(c_nationkey) AS last_nation,
           cast(sum(cast(c_acctbal AS decimal(18,2))) AS double) / count(c_acctbal) AS mean_balance
    FROM customer GROUP BY 1
    """,
)
def csv_inferred(spark, sf):
    path = scratch_path(spark, "csv")
    writers.write_csv(table(spark, sf, "customer"), path)
    customers = readers.read_csv(spark, path)
    return agg.grouped(
        customers,
        ["c_mktsegment"],
        {
            "n": agg.rows(),
            "last_nation": F.max("c_nationkey"),
            "mean_balance": exact_mean(F.col("c_acctbal")),
        },
    )


@register(
    "csv_typed_dates",
    "S6 F4",
    """
    SELECT o_orderkey, cast(o_orderdate AS date) AS order_day FROM orders
    WHERE o_orderdate >= DATE '1999-01-01'
    """,
)
def csv_typed_dates(spark, sf):
    path = scratch_path(spark, "csv")
    day = F.date_format("o_orderdate", "dd/MM/yyyy").alias("order_day")
    writers.write_csv(table(spark, sf, "orders").select("o_orderkey", day), path)
    orders = readers.read_csv(
        spark, path, schema="o_orderkey bigint, order_day date", date_format="dd/MM/yyyy"
    )
    return orders.filter(F.col("order_day") >= F.expr("DATE'1999-01-01'"))


@register(
    "csv_sentinel",
    "S7 F9",
    """
    SELECT c_custkey, c_acctbal AS acct_bal, c_mktsegment FROM customer
    WHERE c_acctbal >= 0 AND c_mktsegment <> 'BUILDING'
    """,
)
def csv_sentinel(spark, sf):
    """``?`` in a number and in a text column, a dotted header, and a typed read that skips both."""
    path = scratch_path(spark, "csv")
    marked = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, "?").otherwise(F.col("c_acctbal").cast("string")).alias("acct.bal"),
        F.when(F.col("c_mktsegment") == "BUILDING", "?").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    writers.write_csv(marked, path)
    schema = "c_custkey bigint, `acct.bal` double, c_mktsegment string"
    return plain_names(readers.read_csv(spark, path, schema=schema, null_marker="?")).na.drop("any")


@register(
    "csv_all_text",
    "S7 P14 P16",
    """
    SELECT c_custkey, cast(c_nationkey AS bigint) AS c_nationkey, c_mktsegment FROM customer
    WHERE c_mktsegment <> 'BUILDING'
    """,
)
def csv_all_text(spark, sf):
    from sumstone.operators.clean import clean_table

    path = scratch_path(spark, "csv")
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "?").otherwise(F.col("c_mktsegment"))
    marked = table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", segment.alias("c_mktsegment")
    )
    writers.write_csv(marked, path)
    return clean_table(
        readers.read_csv(spark, path, all_text=True), "?", ["c_custkey", "c_nationkey"]
    )


@register("csv_glob", "S5 K3", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
def csv_glob(spark, sf):
    root = scratch_path(spark, "csv")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    done = F.col("l_linestatus") == "F"
    for flag, part in (("F", done), ("other", ~done | F.col("l_linestatus").isNull())):
        chosen = table(spark, sf, "lineitem").filter(part)
        writers.write_csv(chosen.select(*lines.columns), f"{root}/batch_{flag}.csv")
    target = scratch_path(spark, "csv")
    schema = "l_orderkey bigint, l_linenumber int, l_extendedprice double"
    writers.compact_csv(spark, f"{root}/batch_*.csv", target, files=2, schema=schema)
    return readers.read_csv(spark, target, schema=schema)


@register(
    "csv_documents",
    "S1 S2 K1 (quotes, commas and line breaks in the text)",
    "SELECT doc_id, text, lang, source FROM documents",
)
def csv_documents(spark, sf):
    path = scratch_path(spark, "csv")
    columns = ["doc_id", "text", "lang", "source"]
    writers.write_csv(spark.read.parquet(f"{sf}/documents.parquet").select(*columns), path)
    schema = "doc_id bigint, text string, lang string, source string"
    return readers.read_csv(spark, path, schema=schema, multi_line=True)


@register("csv_header_order", "S1 S2 (columns by name)", _ORDERS_SQL)
def csv_header_order(spark, sf):
    path = scratch_path(spark, "csv")
    orders = table(spark, sf, "orders")
    writers.write_csv(orders.select(*reversed(orders.columns)), path)
    return readers.read_csv(spark, path, schema=TABLES["orders"])


@register(
    "sql_bound_parameters",
    "S14",
    """
    SELECT l_returnflag, count(*) AS n FROM lineitem
    WHERE l_quantity > 25 AND l_linestatus = 'O' GROUP BY 1
    """,
)
def sql_bound_parameters(spark, sf):
    return readers.query(
        spark,
        "SELECT l_returnflag, count(*) AS n FROM {lines} "
        "WHERE l_quantity > :least AND l_linestatus = :status GROUP BY l_returnflag",
        args={"least": 25, "status": "O"},
        lines=table(spark, sf, "lineitem"),
    )


@register(
    "columns_of_orders",
    "S16",
    """
    SELECT * FROM (VALUES (0, 'o_orderkey', 'bigint'), (1, 'o_custkey', 'bigint'),
      (2, 'o_orderstatus', 'string'), (3, 'o_totalprice', 'double'),
      (4, 'o_orderdate', 'timestamp_ntz'), (5, 'o_orderpriority', 'string'))
      t(position, column_name, data_type)
    WHERE (SELECT count(*) FROM orders) >= 0
    """,
)
def columns_of_orders(spark, sf):
    return readers.schema_table(spark.read.parquet(f"{sf}/orders.parquet"))


@register(
    "csv_sql_view",
    "S3 S4",
    """
    SELECT p_brand, count(*) AS n, max(p_size) AS largest FROM part GROUP BY 1
    """,
)
def csv_sql_view(spark, sf):
    path = scratch_path(spark, "csv")
    writers.write_csv(table(spark, sf, "part"), path)
    readers.csv_view(spark, "part_csv", path, schema=TABLES["part"])
    return spark.sql(
        "SELECT p_brand, count(*) AS n, max(p_size) AS largest FROM part_csv GROUP BY p_brand"
    )


@register(
    "csv_append",
    "K2",
    "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def csv_append(spark, sf):
    path = scratch_path(spark, "csv")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    writers.write_csv(suppliers, path)
    writers.write_csv(suppliers, path, append=True)
    return readers.read_csv(spark, path, schema="s_suppkey bigint, s_name string")


# --- Parquet and views ----------------------------------------------------------------------


@register(
    "parquet_views",
    "S9 S10 S11 S13",
    """
    SELECT n_name, count(*) AS customers, cast(sum(cast(c_acctbal AS decimal(18,2))) AS double) AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
    """,
)
def parquet_views(spark, sf):
    readers.register_files(spark, {"view_nation": f"{sf}/nation.parquet"})
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW view_customer AS SELECT * FROM parquet.`{sf}/customer.parquet`"
    )
    return spark.sql(
        """
        SELECT n_name, count(*) AS customers,
               cast(sum(cast(c_acctbal AS decimal(18,2))) AS double) AS balance
        FROM view_customer JOIN view_nation ON c_nationkey = n_nationkey GROUP BY n_name
        """
    )


@register(
    "sql_over_frames",
    "S10 S14",
    """
    SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity > 25 GROUP BY 1
    """,
)
def sql_over_frames(spark, sf):
    large = table(spark, sf, "lineitem").filter("l_quantity > 25")
    return readers.query(
        spark, "SELECT l_returnflag, count(*) AS n FROM {large} GROUP BY l_returnflag", large=large
    )


@register(
    "local_table_join",
    "S15 J1",
    """
    SELECT label, count(*) AS n FROM orders
    JOIN (VALUES ('F', 'finished'), ('O', 'open')) t(code, label) ON o_orderstatus = code GROUP BY 1
    """,
)
def local_table_join(spark, sf):
    labels = readers.from_columns(
        spark, {"code": ["F", "O"], "label": ["finished", "open"]}, "code string, label string"
    )
    orders = table(spark, sf, "orders")
    joined = orders.join(labels, orders["o_orderstatus"] == labels["code"])
    return agg.histogram(joined, ["label"], "n")


@register(
    "parquet_codecs",
    "K4 K5",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS codec, count(*) AS n, cast(sum(cast(o_totalprice AS decimal(18,2))) AS double)"
        " AS total FROM orders"
        for c in ("snappy", "zstd", "gzip", "none")
    ),
)
def parquet_codecs(spark, sf):
    orders = table(spark, sf, "orders")
    found = []
    for codec in ("snappy", "zstd", "gzip", "none"):
        path = scratch_path(spark, "parquet")
        level = 3 if codec == "zstd" else None
        writers.write_parquet(
            orders, path, codec, level, max_rows_per_file=5_000, row_group_bytes=1 << 20
        )
        back = readers.read_parquet(spark, path, schema=TABLES["orders"])
        found.append(
            back.agg(
                agg.rows().alias("n"), exact_sum(F.col("o_totalprice")).alias("total")
            ).select(F.lit(codec).alias("codec"), "n", "total")
        )
    return stack(found)


@register(
    "csv_to_parquet",
    "K7 N15",
    "SELECT count(*) AS rows, true AS sizes_known FROM lineitem",
)
def csv_to_parquet(spark, sf):
    source, target = scratch_path(spark, "csv"), scratch_path(spark, "parquet")
    writers.write_csv(table(spark, sf, "lineitem"), source)
    report = writers.csv_to_parquet(spark, source, target, schema=TABLES["lineitem"])
    # The sizes once more, as the file sources tell them with the rows.
    told = {
        "csv_bytes": checks.dataset_summary(readers.read_csv(spark, source, schema=TABLES["lineitem"])),
        "parquet_bytes": checks.dataset_summary(spark.read.parquet(target)),
    }
    known = F.abs(F.col("ratio") - F.col("csv_bytes") / F.col("parquet_bytes")) < 1e-9
    for column, files in told.items():
        known = known & (files.agg(F.sum("bytes")).scalar() == F.col(column))
    return report.select("rows", known.alias("sizes_known"))


@register(
    "dataset_summary",
    "Q1",
    """
    SELECT 'lineitem.parquet' AS file, count(*) AS rows, 11 AS columns, true AS has_size FROM lineitem
    UNION ALL SELECT 'orders.parquet', count(*), 6, true FROM orders
    """,
)
def dataset_summary(spark, sf):
    """From the footers; the sizes must be those that the file source tells with the rows."""
    names = ("lineitem", "orders")
    summary = checks.parquet_summary(spark, *[f"{sf}/{n}.parquet" for n in names])
    read = stack([checks.dataset_summary(table(spark, sf, n)) for n in names])
    read = read.select("file", F.col("rows").alias("_rows"), F.col("size_mb").alias("_mb"))
    same = (F.col("size_mb") == F.col("_mb")) & (F.col("rows") == F.col("_rows"))
    return summary.join(read, "file").select("file", "rows", "columns", same.alias("has_size"))


@register(
    "parquet_footers",
    "Q4 S16",
    """
    SELECT 'lineitem.parquet' AS file, count(*) AS rows, 11 AS columns, true AS has_groups FROM lineitem
    UNION ALL SELECT 'part.parquet', count(*), 6, true FROM part
    """,
)
def parquet_footers(spark, sf):
    """Row groups as the files have them: none without rows, none with more than a million."""
    footers = checks.parquet_footers(spark, *[f"{sf}/{n}.parquet" for n in ("lineitem", "part")])
    least = F.ceil(F.col("rows") / F.lit(1 << 20))
    groups = (F.col("row_groups") >= least) & (F.col("row_groups") <= F.col("rows"))
    return footers.select("file", "rows", "columns", groups.alias("has_groups"))


@register(
    "column_facts",
    "Q4 Q6 S16",
    """
    WITH c AS (
      SELECT 0 AS position, 'o_orderkey' AS column_name, 'int64' AS data_type, count(*) AS rows,
             count(*) - count(o_orderkey) AS nulls, cast(min(o_orderkey) AS double) AS least,
             cast(max(o_orderkey) AS double) AS most, NULL::text AS first_text, NULL::text AS last_text
      FROM orders
      UNION ALL SELECT 1, 'o_custkey', 'int64', count(*), count(*) - count(o_custkey),
             cast(min(o_custkey) AS double), cast(max(o_custkey) AS double), NULL, NULL FROM orders
      UNION ALL SELECT 2, 'o_orderstatus', 'string', count(*), count(*) - count(o_orderstatus),
             NULL, NULL, min(o_orderstatus), max(o_orderstatus) FROM orders
      UNION ALL SELECT 3, 'o_totalprice', 'double', count(*), count(*) - count(o_totalprice),
             min(o_totalprice), max(o_totalprice), NULL, NULL FROM orders
      UNION ALL SELECT 4, 'o_orderdate', 'timestamp[us]', count(*), count(*) - count(o_orderdate),
             epoch(min(o_orderdate)), epoch(max(o_orderdate)), NULL, NULL FROM orders
      UNION ALL SELECT 5, 'o_orderpriority', 'string', count(*), count(*) - count(o_orderpriority),
             NULL, NULL, min(o_orderpriority), max(o_orderpriority) FROM orders)
    SELECT * FROM c
    """,
)
def column_facts(spark, sf):
    """Types, nulls and extreme values of a table by its footers, against those of its rows."""
    facts = checks.parquet_columns(spark, f"{sf}/orders.parquet")
    return facts.drop("column_bytes")


_RUNS_SQL = """
    SELECT l_returnflag AS engine, cast(sum(cast(l_quantity AS decimal(18,2))) AS double) AS time,
           count(*) AS rows FROM lineitem GROUP BY 1, l_linenumber
    """


@register(
    "results_appended",
    "N16 U2 K2",
    f"""
    WITH e AS ({_RUNS_SQL}),
    s AS (SELECT engine, time, rows FROM e
          UNION ALL
          SELECT engine || '_AVG', round(cast(sum(cast(time AS decimal(18,2))) AS double) / count(*), 2),
                 cast(floor(avg(rows)) AS bigint)
          FROM e GROUP BY engine)
    SELECT engine, time, rows, count(*) * 2 AS times FROM s GROUP BY ALL
    """,
)
def results_appended(spark, sf):
    """Run results with their averages, appended to a results folder twice; a repeated run adds nothing."""
    runs = agg.grouped(
        table(spark, sf, "lineitem"),
        ["l_returnflag", "l_linenumber"],
        {"time": exact_sum(F.col("l_quantity")), "rows": agg.rows()},
    ).select(F.col("l_returnflag").alias("engine"), "time", "rows")
    averages = {"time": F.round(exact_mean(F.col("time")), 2), "rows": F.floor(F.avg("rows"))}
    summary = append_summary(runs, "engine", averages)
    folder = scratch_path(spark, "results")
    added = [writers.append_once(summary, folder, batch) for batch in ("first", "second", "first")]
    assert added == [True, True, False]
    back = writers.read_results(spark, folder, "engine string, time double, rows bigint")
    return agg.grouped(back, ["engine", "time", "rows"], {"times": agg.rows()})


# --- Arrow IPC ------------------------------------------------------------------------------


@register("arrow_ipc_roundtrip", "S12 K6", _ORDERS_SQL)
def arrow_ipc_roundtrip(spark, sf):
    path = scratch_path(spark, "arrow")
    writers_manifest = arrow_ipc.write_arrow_ipc(table(spark, sf, "orders"), path, 4_096)
    assert writers_manifest.count() > 0
    return arrow_ipc.read_arrow_ipc(spark, path, batches_per_task=2)


@register(
    "arrow_ipc_columns",
    "S12 K6",
    """
    SELECT event_type, count(*) AS n, max(ts) AS last_ts FROM events GROUP BY 1
    """,
)
def arrow_ipc_columns(spark, sf):
    path = scratch_path(spark, "arrow")
    arrow_ipc.write_arrow_ipc(table(spark, sf, "events"), path)
    events = arrow_ipc.read_arrow_ipc(spark, path, columns=["event_type", "ts"])
    return events.groupBy("event_type").agg(agg.rows().alias("n"), F.max("ts").alias("last_ts"))


# --- streams --------------------------------------------------------------------------------


_STREAM_SUM_SQL = """
    SELECT l_linestatus, count(*) AS n, cast(sum(cast(l_extendedprice AS decimal(18,2))) AS double) AS total
    FROM lineitem GROUP BY 1
    """


def _line_totals(spark, sf):
    lines = inc.read_file_stream(spark, sf, TABLES["lineitem"], file_glob="lineitem.parquet")
    return inc.incremental_aggregate(
        lines,
        ["l_linestatus"],
        {"n": agg.rows(), "total": exact_sum(F.col("l_extendedprice"))},
    )


@register("stream_sum_equals_batch", "R1", _STREAM_SUM_SQL)
def stream_sum_equals_batch(spark, sf):
    totals = _line_totals(spark, sf)
    return inc.complete_result(totals, scratch_path(spark, "stream"), scratch_path(spark, "state"))


@register("stream_changed_keys", "R1 (changed keys only)", _STREAM_SUM_SQL)
def stream_changed_keys(spark, sf):
    totals = _line_totals(spark, sf)
    return inc.changed_result(
        totals, ["l_linestatus"], scratch_path(spark, "stream"), scratch_path(spark, "state")
    )


_STREAM_TUMBLING_SQL = """
    SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bucket, count(*) AS n,
           cast(sum(cast(value AS decimal(18,2))) AS double) / count(value) AS mean_value
    FROM events GROUP BY 1
    """


def _five_minutes(spark, sf):
    events = inc.read_file_stream(spark, sf, TABLES["events"], file_glob="events.parquet")
    return inc.incremental_tumbling(
        events,
        "ts",
        FIVE_MINUTES,
        {"n": agg.rows(), "mean_value": exact_mean(F.col("value"))},
        late=dt.timedelta(minutes=10),
    )


@register("stream_tumbling", "R2 T2", _STREAM_TUMBLING_SQL)
def stream_tumbling(spark, sf):
    means = _five_minutes(spark, sf)
    return inc.complete_result(means, scratch_path(spark, "stream"), scratch_path(spark, "state"))


@register("stream_tumbling_changed", "R2 (changed buckets only)", _STREAM_TUMBLING_SQL)
def stream_tumbling_changed(spark, sf):
    means = _five_minutes(spark, sf)
    return inc.changed_result(
        means, ["bucket"], scratch_path(spark, "stream"), scratch_path(spark, "state")
    )


@register(
    "stream_tumbling_closed",
    "R2 (append mode: closed windows only)",
    """
    SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bucket, count(*) AS n
    FROM events GROUP BY 1
    HAVING time_bucket(INTERVAL 5 MINUTE, any_value(ts)) + INTERVAL 5 MINUTE
           <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)
    """,
)
def stream_tumbling_closed(spark, sf):
    events = inc.read_file_stream(spark, sf, TABLES["events"], file_glob="events.parquet")
    counts = inc.incremental_tumbling(
        events, "ts", FIVE_MINUTES, {"n": agg.rows()}, late=dt.timedelta(minutes=10)
    )
    return inc.appended_result(counts, scratch_path(spark, "stream"), scratch_path(spark, "state"))


@register("stream_convert", "R3", _ORDERS_SQL)
def stream_convert(spark, sf):
    """Parquet to CSV and back, both as streams."""
    orders = inc.read_file_stream(spark, sf, TABLES["orders"], file_glob="orders.parquet")
    text = scratch_path(spark, "stream")
    inc.convert_stream(orders, text, scratch_path(spark, "state"), "csv")
    lines = inc.read_file_stream(spark, text, TABLES["orders"], "csv", file_glob="*.csv")
    return inc.convert_stream(lines, scratch_path(spark, "stream"), scratch_path(spark, "state"))
