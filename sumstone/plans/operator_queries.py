"""Single operators bound to the test tables: cleaning, expressions, order, sets, time, checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from sumstone.functions import scalar as sc
from sumstone.functions.calendar import (
    calendar_between,
    date_key,
    fiscal_month,
    fiscal_year,
)
from sumstone.functions.exact import exact_mean, exact_sum
from sumstone.operators import aggregate as agg
from sumstone.operators import checks, clean, filters, joins, setops
from sumstone.operators.ordered import ordinal_rank
from sumstone.operators.pivot import pivot_mean
from sumstone.operators.timeseries import resample, tumbling
from sumstone.plans.registry import register, table
from sumstone.plans.reports import FIVE_MINUTES
from sumstone.sources.writers import preview


# --- cleaning -------------------------------------------------------------------------------


@register(
    "clean_sentinel",
    "P14 P16 F9",
    """
    SELECT o_orderkey, o_orderstatus, try_cast(substr(o_orderpriority, 1, 1) AS bigint) AS level,
           try_cast(o_orderpriority AS bigint) AS bad_number
    FROM orders WHERE o_orderstatus <> 'P'
    """,
)
def clean_sentinel(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.substring("o_orderpriority", 1, 1).alias("level"),
        F.col("o_orderpriority").alias("bad.number"),
    )
    return clean.clean_table(orders, "P", ["level", "bad_number"])


@register(
    "sentinel_filter",
    "F10",
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderstatus <> 'P' AND o_orderpriority <> 'P'
    """,
)
def sentinel_filter(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return clean.without_marker(orders, ["o_orderstatus", "o_orderpriority"], "P")


@register(
    "rows_before_after",
    "Q3",
    """
    SELECT count(*) AS rows_before, count(*) FILTER (WHERE o_orderstatus <> 'P') AS rows_after
    FROM orders
    """,
)
def rows_before_after(spark, sf):
    return clean.rows_before_after(table(spark, sf, "orders"), "P")


# --- expressions ----------------------------------------------------------------------------


@register(
    "calendar_dim",
    "P9 P15 P17 P18 G8",
    """
    WITH days AS (
      SELECT cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY))
             AS date) AS d FROM orders)
    SELECT cast(strftime(d, '%Y%m%d') AS int) AS "DateID", d AS "CalendarDate",
           cast(year(d) AS int) AS "CalendarYear", strftime(d, '%B') AS "CalendarMonth",
           cast(month(d) AS int) AS "MonthOfYear", strftime(d, '%A') AS "CalendarDay",
           cast(dayofweek(d) + 1 AS int) AS "DayOfWeek",
           cast(isodow(d) - 1 AS int) AS "DayOfWeekStartMonday",
           CASE WHEN isodow(d) < 6 THEN 'TRUE' ELSE 'FALSE' END AS "IsWeekDay",
           cast(day(d) AS int) AS "DayOfMonth",
           CASE WHEN last_day(d) = d THEN 'TRUE' ELSE 'FALSE' END AS "IsLastDayOfMonth",
           cast(dayofyear(d) AS int) AS "DayOfYear", cast(weekofyear(d) AS int) AS "WeekOfYearIso",
           cast(quarter(d) AS int) AS "QuarterOfYear",
           cast(year(d) + CASE WHEN month(d) >= 10 THEN 1 ELSE 0 END AS int) AS "FiscalYearOctToSep",
           cast((month(d) + 2) % 12 + 1 AS int) AS "FiscalMonthOctToSep",
           cast(year(d) + CASE WHEN month(d) >= 7 THEN 1 ELSE 0 END AS int) AS "FiscalYearJulToJun",
           cast((month(d) + 5) % 12 + 1 AS int) AS "FiscalMonthJulToJun"
    FROM days
    """,
)
def calendar_dim(spark, sf):
    bounds = table(spark, sf, "orders").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    return calendar_between(bounds, "first", "last")


@register(
    "fiscal_parts",
    "P9 P15 P18",
    """
    SELECT o_orderkey, cast(strftime(o_orderdate, '%Y%m%d') AS int) AS order_day,
           cast(year(o_orderdate) AS int) AS key_year,
           cast(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 10 THEN 1 ELSE 0 END AS int)
             AS fiscal_year,
           cast((month(o_orderdate) + 2) % 12 + 1 AS int) AS fiscal_month
    FROM orders
    """,
)
def fiscal_parts(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        date_key(day).alias("order_day"),
        sc.year_of_date_key(date_key(day)).alias("key_year"),
        fiscal_year(day, 10).alias("fiscal_year"),
        fiscal_month(day, 10).alias("fiscal_month"),
    )


@register(
    "format_strings",
    "P3 P19 P22",
    """
    SELECT o_orderkey, printf('INV-%010d', o_orderkey) AS invoice,
           'Order #' || o_orderkey || ' - ' || o_orderpriority AS label,
           printf('%.4f', o_totalprice) AS price_text,
           ['alpha', 'beta', 'gamma'][(o_orderkey % 3 + 1)::int] AS word
    FROM orders
    """,
)
def format_strings(spark, sf):
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        key,
        sc.padded_code("INV-", key).alias("invoice"),
        sc.labelled("Order #", key, " - ", F.col("o_orderpriority")).alias("label"),
        sc.fixed_decimals(F.col("o_totalprice"), 4).alias("price_text"),
        sc.pick(["alpha", "beta", "gamma"], key).alias("word"),
    )


@register(
    "timestamp_math",
    "P20",
    """
    SELECT event_id, ts + user_id * INTERVAL 86400 SECOND AS shifted,
           TIMESTAMP '1970-01-01 00:00:00' + (1640995200 + event_id * 60) * INTERVAL 1 SECOND AS minute_mark,
           epoch_us(ts) AS micros
    FROM events
    """,
)
def timestamp_math(spark, sf):
    events = table(spark, sf, "events")
    return events.select(
        "event_id",
        sc.add_seconds(F.col("ts"), F.col("user_id") * 86_400).alias("shifted"),
        sc.timestamp_from_seconds(F.col("event_id") * 60 + 1_640_995_200).alias("minute_mark"),
        sc.epoch_micros(events, "ts").alias("micros"),
    )


@register(
    "ip_pack",
    "P8 P21",
    """
    SELECT c_custkey, (10::bigint << 24) | (c_custkey % 16500000) AS address, c_custkey % 17 AS bucket
    FROM customer
    """,
)
def ip_pack(spark, sf):
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        key,
        sc.pack_ipv4(10, sc.modulo_bucket(key, 16_500_000)).alias("address"),
        sc.modulo_bucket(key, 17).alias("bucket"),
    )


@register(
    "masked_zero",
    "P7",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0::double ELSE c_acctbal END AS balance,
           CASE WHEN c_acctbal > 5000 THEN 'high' ELSE 'low' END AS flag
    FROM customer
    """,
)
def masked_zero(spark, sf):
    balance = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey",
        sc.zero_where(balance < 0, balance).alias("balance"),
        sc.two_way_flag(balance > 5000, "high", "low").alias("flag"),
    )


@register(
    "select_drop_rename",
    "P1 P2 P3",
    "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer",
)
def select_drop_rename(spark, sf):
    customers = table(spark, sf, "customer").drop("c_acctbal", "c_nationkey", "no_such_column")
    return customers.withColumnsRenamed(
        {"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment"}
    )


# --- filters --------------------------------------------------------------------------------


@register(
    "query_string_filter",
    "F2 F6",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE year(o_orderdate) >= 1999 AND o_totalprice > 100000
    """,
)
def query_string_filter(spark, sf):
    kept = filters.keep(
        table(spark, sf, "orders"),
        "o_orderdate >= timestamp_ntz'{year}-01-01' AND o_totalprice > {floor}",
        {"year": 1999, "floor": 100_000},
    )
    return kept.select("o_orderkey", "o_totalprice")


@register(
    "date_cast_filter",
    "F4 P15",
    """
    SELECT event_id, cast(ts AS date) AS day FROM events
    WHERE cast(ts AS date) >= DATE '2024-01-15'
    """,
)
def date_cast_filter(spark, sf):
    day = F.col("ts").cast("date")
    events = table(spark, sf, "events").select("event_id", day.alias("day"))
    return events.filter(filters.on_or_after(events, "day", "2024-01-15"))


# --- joins ----------------------------------------------------------------------------------


@register(
    "hot_key_lookup",
    "J3 J4 (frequent keys on the left)",
    """
    SELECT l_returnflag, l_orderkey, l_linenumber, label
    FROM lineitem LEFT JOIN (SELECT o_orderstatus AS s, any_value('status ' || o_orderstatus)
      AS label FROM orders GROUP BY 1) ON l_linestatus = s
    """,
)
def hot_key_lookup(spark, sf):
    labels = (
        table(spark, sf, "orders")
        .select(F.col("o_orderstatus").alias("l_linestatus"))
        .distinct()
        .withColumn("label", sc.labelled("status ", F.col("l_linestatus")))
    )
    lines = table(spark, sf, "lineitem").select(
        "l_linestatus", "l_returnflag", "l_orderkey", "l_linenumber"
    )
    return joins.hot_key_lookup(lines, labels, ["l_linestatus"]).drop("l_linestatus")


@register(
    "fk_orphans",
    "Q7 J5",
    """
    SELECT count(*) AS orphans FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_totalprice > 200000)
    """,
)
def fk_orphans(spark, sf):
    large = table(spark, sf, "orders").filter("o_totalprice > 200000")
    lost = joins.orphans(table(spark, sf, "lineitem"), large, "l_orderkey", "o_orderkey")
    return lost.agg(agg.rows().alias("orphans"))


@register(
    "fk_orphans_by_width",
    "Q7 J5",
    """
    SELECT count(*) AS orphans FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c_custkey)
    """,
)
def fk_orphans_by_width(spark, sf):
    lost = joins.orphans(
        table(spark, sf, "customer"), table(spark, sf, "nation"), "c_custkey", "n_nationkey"
    )
    return lost.agg(agg.rows().alias("orphans"))


# --- order ----------------------------------------------------------------------------------

_RANK_SQL = """
    SELECT event_id, user_id, value,
           row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS rank
    FROM events
    """


@register("rank_in_user", "N14 W2", _RANK_SQL)
def rank_in_user(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    return ordinal_rank(events, ["user_id"], "value", "event_id")


@register("rank_in_user_over_ranges", "W2 (other ranges)", _RANK_SQL)
def rank_in_user_over_ranges(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    return ordinal_rank(events, ["user_id"], "value", "event_id", hot=50)


@register(
    "sort_mixed",
    "O1 O4",
    """
    SELECT o_orderpriority, o_orderstatus, o_totalprice, o_orderkey FROM orders
    ORDER BY 1, 2, 3 DESC, 4 DESC
    """,
)
def sort_mixed(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderpriority", "o_orderstatus", "o_totalprice", "o_orderkey"
    )
    return agg.mixed_sort(
        orders,
        [
            ("o_orderpriority", True),
            ("o_orderstatus", True),
            ("o_totalprice", False),
            ("o_orderkey", False),
        ],
    )


@register(
    "limit_only",
    "O6 K9",
    """
    SELECT least(count(*), 10) AS shown, least(count(*), 10) AS shown_in_table FROM orders
    """,
)
def limit_only(spark, sf):
    """Which rows a bare limit shows is open, so the query checks their number and origin."""
    orders = table(spark, sf, "orders")
    shown = F.broadcast(preview(orders.select(F.col("o_orderkey").alias("_shown")), 10))
    found = orders.join(shown, orders["o_orderkey"] == shown["_shown"])
    return found.agg(
        F.count_distinct("_shown").alias("shown"), F.count("o_orderkey").alias("shown_in_table")
    )


# --- pivots and time ------------------------------------------------------------------------


@register(
    "pivot_mean_bucket",
    "N14 V2 P8",
    "SELECT event_type, "
    + ", ".join(
        f'round(avg(value) FILTER (WHERE user_id % 8 = {b}), 4) AS "{b}"' for b in range(8)
    )
    + " FROM events GROUP BY 1",
)
def pivot_mean_bucket(spark, sf):
    means = pivot_mean(
        table(spark, sf, "events"),
        "event_type",
        sc.modulo_bucket(F.col("user_id"), 8),
        range(8),
        "value",
    )
    return means.withColumns({str(b): F.round(F.col(f"`{b}`"), 4) for b in range(8)})


@register(
    "tumbling_sparse",
    "N14 T2",
    """
    SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bucket, count(*) AS n,
           cast(sum(cast(value AS decimal(18,2))) AS double) / count(value) AS mean_value
    FROM events GROUP BY 1
    """,
)
def tumbling_sparse(spark, sf):
    return tumbling(
        table(spark, sf, "events"),
        "ts",
        FIVE_MINUTES,
        {"n": agg.rows(), "mean_value": exact_mean(F.col("value"))},
    )


@register(
    "resample_dense",
    "N14 T1",
    """
    WITH b AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bucket,
                 cast(sum(cast(value AS decimal(18,2))) AS double) / count(value) AS mean_value
               FROM events GROUP BY 1),
    spine AS (SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL 5 MINUTE)) AS bucket
              FROM b)
    SELECT spine.bucket, mean_value FROM spine LEFT JOIN b ON spine.bucket = b.bucket
    """,
)
def resample_dense(spark, sf):
    return resample(
        table(spark, sf, "events"), "ts", FIVE_MINUTES, {"mean_value": exact_mean(F.col("value"))}
    )


# --- sets and result tables -----------------------------------------------------------------


@register(
    "union_all",
    "U1",
    """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'A'
    UNION ALL SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag <> 'A'
    UNION ALL SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 40
    """,
)
def union_all(spark, sf):
    lines = table(spark, sf, "lineitem")
    parts = [
        lines.filter("l_returnflag = 'A'"),
        lines.filter("l_returnflag <> 'A'"),
        lines.filter("l_quantity > 40"),
    ]
    return setops.stack([p.select("l_orderkey", "l_linenumber", "l_quantity") for p in parts])


def _supplier_results(spark, sf):
    lines = table(spark, sf, "lineitem")
    return agg.grouped(
        lines,
        ["l_returnflag", "l_suppkey"],
        {"quantity": exact_sum(F.col("l_quantity")), "rows": agg.rows()},
    )


_SUPPLIER_SQL = """
    SELECT l_returnflag, l_suppkey, cast(sum(cast(l_quantity AS decimal(18,2))) AS double) AS quantity,
           count(*) AS rows FROM lineitem GROUP BY 1, 2
    """


@register(
    "append_summary",
    "U2 A18 N16",
    f"""
    WITH d AS ({_SUPPLIER_SQL}),
    e AS (SELECT l_returnflag AS engine, l_suppkey AS run, quantity AS time, rows FROM d)
    SELECT engine, run, time, rows FROM e
    UNION ALL
    SELECT engine || '_AVG', NULL, round(cast(sum(cast(time AS decimal(18,2))) AS double) / count(*), 2),
           cast(floor(avg(rows)) AS bigint)
    FROM e GROUP BY engine
    """,
)
def append_summary(spark, sf):
    runs = _supplier_results(spark, sf).select(
        F.col("l_returnflag").alias("engine"),
        F.col("l_suppkey").alias("run"),
        F.col("quantity").alias("time"),
        "rows",
    )
    return setops.append_summary(
        runs,
        "engine",
        {
            "run": F.max(F.lit(None).cast("bigint")),
            "time": F.round(exact_mean(F.col("time")), 2),
            "rows": F.floor(F.avg("rows")),
        },
    )


@register(
    "run_statistics",
    "A18",
    f"""
    WITH d AS ({_SUPPLIER_SQL})
    SELECT l_returnflag, round(avg(quantity), 4) AS mean, min(quantity) AS best, count(*) AS runs,
           quantile_cont(quantity, 0.5) AS median
    FROM d GROUP BY 1
    """,
)
def run_statistics(spark, sf):
    stats = agg.run_statistics(_supplier_results(spark, sf), "l_returnflag", "quantity")
    return stats.withColumn("mean", F.round("mean", 4))


@register(
    "baseline_ratio",
    "A19",
    """
    WITH d AS (SELECT l_returnflag, cast(sum(cast(l_quantity AS decimal(18,2))) AS double) AS quantity
               FROM lineitem GROUP BY 1)
    SELECT l_returnflag, quantity,
           (SELECT quantity FROM d WHERE l_returnflag = 'A') / quantity AS ratio FROM d
    """,
)
def baseline_ratio(spark, sf):
    totals = agg.grouped(
        table(spark, sf, "lineitem"), ["l_returnflag"], {"quantity": exact_sum(F.col("l_quantity"))}
    )
    return agg.ratio_to_baseline(totals, "l_returnflag", "A", "quantity", "ratio")


@register(
    "frames_equal",
    "U3",
    """
    SELECT 0::bigint AS differing_rows
    """,
)
def frames_equal(spark, sf):
    """Two plans for the same result: one pass, and the union of two halves added up."""
    lines = table(spark, sf, "lineitem")
    direct = agg.grouped(lines, ["l_suppkey"], {"quantity": exact_sum(F.col("l_quantity"))})
    halves = setops.stack(
        [
            agg.grouped(lines.filter(c), ["l_suppkey"], {"quantity": exact_sum(F.col("l_quantity"))})
            for c in ("l_linestatus = 'F'", "l_linestatus <> 'F'")
        ]
    )
    added = agg.grouped(halves, ["l_suppkey"], {"quantity": exact_sum(F.col("quantity"))})
    return setops.difference_count(direct, added)


@register(
    "frames_differ",
    "U3",
    """
    SELECT l_returnflag, l_linestatus, n AS surplus FROM (
      SELECT l_returnflag, l_linestatus, count(*) FILTER (WHERE l_quantity > 40) AS n
      FROM lineitem GROUP BY 1, 2)
    """,
)
def frames_differ(spark, sf):
    lines = table(spark, sf, "lineitem")
    columns = ["l_returnflag", "l_linestatus"]
    return setops.differences(
        lines.select(*columns), lines.filter("l_quantity <= 40").select(*columns)
    )


@register(
    "distinct_null_as_value",
    "A6 A11",
    """
    SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status,
           count(DISTINCT CASE WHEN o_custkey % 5 > 0 THEN o_custkey END) AS customers,
           count(DISTINCT CASE WHEN o_custkey % 5 > 0 THEN o_custkey END)
             + max(CASE WHEN o_custkey % 5 > 0 THEN 0 ELSE 1 END) AS customers_and_null
    FROM orders GROUP BY 1
    """,
)
def distinct_null_as_value(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_custkey") % 5 > 0, F.col("o_custkey")).alias("customer"),
    )
    return agg.grouped(
        orders,
        ["status"],
        {
            "customers": agg.distinct_count("customer"),
            "customers_and_null": agg.distinct_count("customer", null_as_value=True),
        },
    )


# --- checks ---------------------------------------------------------------------------------


@register(
    "row_count_check",
    "Q2",
    """
    SELECT n AS expected, n AS found, true AS ok FROM (SELECT count(*) AS n FROM orders)
    """,
)
def row_count_check(spark, sf):
    """Rows that must come out of a left join to a unique key, against those that do."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    joined = joins.lookup(orders, customers, ["o_custkey"])
    return checks.row_count_check(joined, orders.count())


@register(
    "profile_columns",
    "Q6",
    """
    WITH c AS (SELECT count(*) AS n, count(c_custkey) AS a, count(c_name) AS b,
                 count(nullif(c_mktsegment, 'BUILDING')) AS d FROM customer)
    SELECT 0 AS position, 'c_custkey' AS column_name, 'bigint' AS data_type, n AS rows,
           a AS non_null FROM c
    UNION ALL SELECT 1, 'c_name', 'string', n, b FROM c
    UNION ALL SELECT 2, 'segment', 'string', n, d FROM c
    """,
)
def profile_columns(spark, sf):
    customers = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment")
    )
    return checks.column_profile(customers)


@register(
    "result_sizes",
    "Q5",
    """
    SELECT 'all' AS result, count(*) AS rows FROM orders
    UNION ALL SELECT 'finished', count(*) FROM orders WHERE o_orderstatus = 'F'
    """,
)
def result_sizes(spark, sf):
    orders = table(spark, sf, "orders")
    return checks.result_sizes({"all": orders, "finished": orders.filter("o_orderstatus = 'F'")})
