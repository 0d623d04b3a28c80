"""The reports of ``sumstone.plans.reports`` bound to the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sumstone.functions.exact import exact_mean, exact_sum
from sumstone.functions.scalar import bytes_to_mib, modulo_bucket
from sumstone.operators import aggregate as agg
from sumstone.operators.filters import among, from_year
from sumstone.operators.joins import (
    grouped_by_attributes,
    in_top,
    maybe_in_keys,
    star_join,
    within_keys,
)
from sumstone.operators.pivot import crosstab
from sumstone.operators.quantiles import box_stats
from sumstone.operators.timeseries import rolling_mean
from sumstone.plans import reports
from sumstone.plans.registry import register, table
from sumstone.session import scratch_path
from sumstone.sources import readers, writers


def events_as_orders(spark, sf):
    """The events table under the column names of the events report."""
    return table(spark, sf, "events").select(
        F.col("ts").alias("event_date"),
        F.col("event_type").alias("country"),
        modulo_bucket(F.col("user_id"), 4).alias("channel"),
        "user_id",
        F.col("event_id").alias("order_id"),
        F.col("value").alias("revenue"),
    )


def orders_as_traffic(spark, sf):
    """The orders table under the column names of the traffic reports."""
    return table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.col("o_custkey").alias("src"),
        F.col("o_orderkey").alias("dst"),
        F.col("o_orderpriority").alias("act"),
        F.floor("o_totalprice").alias("byt"),
    )


_TOP_CHANNELS_SQL = """
    SELECT event_type AS country, user_id % 4 AS channel,
           count(DISTINCT user_id) AS users, count(event_id) AS orders,
           cast(sum(cast(value AS decimal(18,2))) AS double) AS revenue
    FROM events
    WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'
      AND event_type IN ('click', 'purchase', 'view') AND value > 0
    GROUP BY 1, 2 ORDER BY revenue DESC, country, channel LIMIT 10
    """


@register("events_channel_top10", "N1 S8 F1 F2 F3 F4 A1 A4 A6 A9 A10 O3", _TOP_CHANNELS_SQL)
def events_channel_top10(spark, sf):
    return reports.top_channels(
        events_as_orders(spark, sf), "2024-01-10", ["click", "purchase", "view"]
    )


@register("events_channel_top10_dense_ids", "N1 A6 (bitmaps)", _TOP_CHANNELS_SQL)
def events_channel_top10_dense_ids(spark, sf):
    return reports.top_channels(
        events_as_orders(spark, sf), "2024-01-10", ["click", "purchase", "view"], dense_ids=True
    )


@register(
    "revenue_by_flag",
    "N2 P4 F5 A2 O2",
    """
    SELECT l_returnflag,
           cast(sum(cast(l_extendedprice AS decimal(18,2)) * cast(l_quantity AS decimal(18,2)))
                AS double) AS revenue
    FROM lineitem WHERE l_extendedprice * l_quantity > 0
    GROUP BY 1 ORDER BY revenue DESC, l_returnflag
    """,
)
def revenue_by_flag(spark, sf):
    lines = table(spark, sf, "lineitem")
    return reports.revenue_by(lines, "l_returnflag", "l_extendedprice", "l_quantity", scale=2)


@register(
    "star_report_sales",
    "N3 J1 A10 O1",
    """
    SELECT cast(year(o_orderdate) AS int) AS "CalendarYear", c_mktsegment AS "County",
           c_name AS "StoreName", s_name AS "VendorName", n_name AS "CategoryName",
           p_brand AS "ItemName",
           cast(sum(cast(l_extendedprice AS decimal(18,2))) AS double) AS total_sales,
           cast(sum(l_quantity) AS bigint) AS bottles_sold,
           cast(sum(cast(l_discount AS decimal(18,4))) AS double) AS volume_liters,
           cast(sum(cast(l_extendedprice AS decimal(18,2))) AS double) / count(l_extendedprice)
             AS avg_retail,
           cast(sum(cast(l_tax AS decimal(18,2))) AS double) / count(l_tax) AS avg_cost,
           count(l_linenumber) AS transactions
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON s_nationkey = n_nationkey
    WHERE year(o_orderdate) >= 1998
    GROUP BY ALL
    """,
)
def star_report_sales(spark, sf):
    """The six-table report of the sales star, with the test tables in the places of its tables."""
    day = F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("DateID")
    orders = table(spark, sf, "orders")
    dates = orders.select(day, F.year("o_orderdate").alias("CalendarYear")).distinct()
    orders = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", day)
    suppliers = table(spark, sf, "supplier")
    nation = suppliers.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    lines = table(spark, sf, "lineitem").join(orders, "l_orderkey").join(nation, "l_suppkey")
    sales = lines.select(
        F.col("l_linenumber").alias("ID"),
        "DateID",
        F.col("o_custkey").alias("StoreID"),
        F.col("l_suppkey").alias("VendorID"),
        F.col("s_nationkey").alias("CategoryID"),
        F.col("l_partkey").alias("ItemID"),
        F.col("l_extendedprice").alias("SaleDollars"),
        F.col("l_quantity").cast("bigint").alias("BottlesSold"),
        F.col("l_discount").alias("VolumeSoldLiters"),
        F.col("l_extendedprice").alias("StateBottleRetail"),
        F.col("l_tax").alias("StateBottleCost"),
    )
    named = {
        "nation": ("n_nationkey", "CategoryID", {"n_name": "CategoryName"}),
        "customer": ("c_custkey", "StoreID", {"c_mktsegment": "County", "c_name": "StoreName"}),
        "supplier": ("s_suppkey", "VendorID", {"s_name": "VendorName"}),
        "part": ("p_partkey", "ItemID", {"p_brand": "ItemName"}),
    }
    dims = {
        name: table(spark, sf, name).withColumnsRenamed({key: id_, **names})
        for name, (key, id_, names) in named.items()
    }
    return reports.star_report(
        sales, dims["nation"], dates, dims["customer"], dims["supplier"], dims["part"], 1998
    )


@register(
    "sum_small_values",
    "A1 A2",
    """
    SELECT l_returnflag, round(sum(l_extendedprice * 0.00001), 6) AS total,
           round(avg(l_extendedprice * 0.00001), 9) AS mean
    FROM lineitem GROUP BY 1
    """,
)
def sum_small_values(spark, sf):
    small = F.col("l_extendedprice") * 0.00001
    return agg.grouped(
        table(spark, sf, "lineitem"),
        ["l_returnflag"],
        {"total": F.round(exact_sum(small), 6), "mean": F.round(exact_mean(small), 9)},
    )


STAR_SQL = """
    SELECT cast(year(o_orderdate) AS int) AS order_year, n_name, c_mktsegment, p_brand, s_name,
           o_orderpriority,
           cast(sum(cast(l_extendedprice AS decimal(18,2))) AS double) AS total_sales,
           cast(sum(cast(l_quantity AS decimal(18,2))) AS double) AS quantity,
           cast(sum(cast(l_tax AS decimal(18,2))) AS double) AS tax,
           cast(sum(cast(p_retailprice AS decimal(18,2))) AS double) / count(p_retailprice)
             AS avg_retail,
           cast(sum(cast(l_discount AS decimal(18,2))) AS double) / count(l_discount)
             AS avg_discount,
           count(l_linenumber) AS transactions
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    WHERE year(o_orderdate) >= 1998
    GROUP BY 1, 2, 3, 4, 5, 6
    ORDER BY 1, 2, 3, 4, 5, 6, total_sales DESC, quantity DESC
    """
STAR_KEYS = ["order_year", "n_name", "c_mktsegment", "p_brand", "s_name", "o_orderpriority"]


def star_sums():
    return {
        "total_sales": exact_sum(F.col("l_extendedprice"), wide=False),
        "quantity": exact_sum(F.col("l_quantity"), wide=False),
        "tax": exact_sum(F.col("l_tax"), wide=False),
        "avg_retail": exact_mean(F.col("p_retailprice"), wide=False),
        "avg_discount": exact_mean(F.col("l_discount"), wide=False),
        "transactions": F.count("l_linenumber"),
    }


@register("star_sales", "N3 P2 J1 J5 F7 A9 A10 A11 O1", STAR_SQL)
def star_sales(spark, sf):
    orders = table(spark, sf, "orders")
    orders = orders.filter(from_year(orders, "o_orderdate", 1998)).withColumn(
        "order_year", F.year("o_orderdate")
    )
    joined = star_join(
        table(spark, sf, "lineitem"),
        [
            (orders, "l_orderkey", "o_orderkey"),
            (table(spark, sf, "part"), "l_partkey", "p_partkey"),
            (table(spark, sf, "supplier"), "l_suppkey", "s_suppkey"),
            (table(spark, sf, "customer"), "o_custkey", "c_custkey"),
            (table(spark, sf, "nation"), "c_nationkey", "n_nationkey"),
        ],
    )
    # The keys tell all rows apart: measures would never decide their order.
    return reports.star_summary(joined, STAR_KEYS, star_sums(), [])


@register("star_pruned", "N3 J1 A10 (facts pruned by keys, grouped by codes)", STAR_SQL)
def star_pruned(spark, sf):
    """The same report: lines pruned by the keys of the orders, grouped by codes of the attributes."""
    orders = table(spark, sf, "orders")
    orders = orders.filter(from_year(orders, "o_orderdate", 1998)).select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.year("o_orderdate").alias("order_year")
    )
    lines = within_keys(table(spark, sf, "lineitem"), orders, "l_orderkey", "o_orderkey")
    lines = maybe_in_keys(lines, orders, "l_orderkey", "o_orderkey")
    part, nation = table(spark, sf, "part"), table(spark, sf, "nation")
    people = star_join(table(spark, sf, "customer"), [(nation, "c_nationkey", "n_nationkey")])
    report = grouped_by_attributes(
        lines,
        [
            (people, "o_custkey", "c_custkey", ["n_name", "c_mktsegment"]),
            (part, "l_partkey", "p_partkey", ["p_brand"]),
            (table(spark, sf, "supplier"), "l_suppkey", "s_suppkey", ["s_name"]),
        ],
        ["order_year", "o_orderpriority"],
        star_sums(),
        through=(orders, "l_orderkey", "o_orderkey"),
        measures=["p_retailprice"],
    )
    return report.select(*STAR_KEYS, *star_sums())


@register(
    "mean_by_category",
    "N4 A3",
    """
    SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean_price
    FROM orders GROUP BY 1
    """,
)
def mean_by_category(spark, sf):
    means = reports.mean_by(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice", "mean_price")
    return means.withColumn("mean_price", F.round("mean_price", 4))


@register(
    "net_revenue_flag",
    "N5 P5 P7 A1 O5",
    """
    SELECT l_linestatus,
           CASE WHEN l_extendedprice * l_quantity * (1 - 0.075) > 50000 THEN 'high' ELSE 'low' END
             AS order_flag,
           cast(sum(cast(l_extendedprice AS decimal(12,2)) * cast(l_quantity AS decimal(6,0))
                * 0.925) AS double) AS net_revenue
    FROM lineitem GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def net_revenue_flag(spark, sf):
    return reports.net_revenue_by(
        table(spark, sf, "lineitem"),
        ["l_linestatus", "order_flag"],
        scale=5,
        sales="l_extendedprice",
        quantity="l_quantity",
    )


@register(
    "monthly_volume",
    "N6 A1 P10 P11 O4",
    """
    SELECT cast(year(o_orderdate) AS int) AS year, cast(month(o_orderdate) AS int) AS month,
           round(sum(cast(floor(o_totalprice) AS bigint)) / 1024 / 1024 / 1024, 2) AS total_gb
    FROM orders GROUP BY 1, 2 ORDER BY 1 DESC, 2 DESC
    """,
)
def monthly_volume(spark, sf):
    return reports.monthly_traffic(orders_as_traffic(spark, sf))


@register(
    "top_rejects",
    "N7 F3 A1 P11 O3",
    """
    SELECT l_suppkey, l_partkey,
           round(cast(sum(cast(l_extendedprice AS decimal(18,2))) AS double) / 1024 / 1024, 6)
             AS total_mb
    FROM lineitem WHERE l_returnflag IN ('R', 'A')
    GROUP BY 1, 2 ORDER BY total_mb DESC, l_suppkey, l_partkey LIMIT 10
    """,
)
def top_rejects(spark, sf):
    rejected = table(spark, sf, "lineitem").filter(among("l_returnflag", ["R", "A"]))
    volume = bytes_to_mib(exact_sum(F.col("l_extendedprice")))
    report = agg.grouped(rejected, ["l_suppkey", "l_partkey"], {"total_mb": F.round(volume, 6)})
    return agg.top_k(report, "total_mb", 10, ["l_suppkey", "l_partkey"])


_DASHBOARD_SQL = """
    WITH rejects AS (
      SELECT o_custkey AS src, o_orderkey AS dst,
             round(sum(cast(floor(o_totalprice) AS bigint)) / 1024 / 1024, 2) AS total_mb
      FROM orders WHERE o_orderpriority IN ('REJECT', 'BLOCK', 'DROP', '1-URGENT')
      GROUP BY 1, 2 ORDER BY total_mb DESC, src, dst LIMIT 10),
    monthly AS (
      SELECT cast(year(o_orderdate) AS int) AS year, cast(month(o_orderdate) AS int) AS month,
             round(sum(cast(floor(o_totalprice) AS bigint)) / 1024 / 1024 / 1024, 2) AS total_gb
      FROM orders GROUP BY 1, 2)
    SELECT 'top_rejects' AS section, src AS first_key, dst AS second_key, total_mb AS volume
    FROM rejects
    UNION ALL
    SELECT 'monthly_traffic', cast(year AS bigint), cast(month AS bigint), total_gb FROM monthly
    """


@register("dashboard", "N8", _DASHBOARD_SQL)
def dashboard(spark, sf):
    traffic = orders_as_traffic(spark, sf)
    rejects = reports.top_rejected(traffic, ["REJECT", "BLOCK", "DROP", "1-URGENT"])
    monthly = reports.monthly_traffic(traffic)
    return rejects.select(
        F.lit("top_rejects").alias("section"),
        F.col("src").alias("first_key"),
        F.col("dst").alias("second_key"),
        F.col("total_mb").alias("volume"),
    ).unionByName(
        monthly.select(
            F.lit("monthly_traffic").alias("section"),
            F.col("year").cast("bigint").alias("first_key"),
            F.col("month").cast("bigint").alias("second_key"),
            F.col("total_gb").alias("volume"),
        )
    )


@register("dashboard_handover", "N8 K8", _DASHBOARD_SQL)
def dashboard_handover(spark, sf):
    """The same through the lists of dicts that a client gets."""
    told = reports.executive_dashboard(
        orders_as_traffic(spark, sf), ["REJECT", "BLOCK", "DROP", "1-URGENT"]
    )
    rows = [("top_rejects", r["src"], r["dst"], r["total_mb"]) for r in told["top_rejects"]]
    rows += [
        ("monthly_traffic", r["year"], r["month"], r["total_gb"]) for r in told["monthly_traffic"]
    ]
    return spark.createDataFrame(
        rows, "section string, first_key bigint, second_key bigint, volume double"
    )


@register(
    "traffic_validation",
    "N9 A5 A6 A8 A12",
    """
    SELECT count(*) AS rows, cast(min(year(o_orderdate)) AS int) AS min_year,
           cast(max(year(o_orderdate)) AS int) AS max_year,
           count(DISTINCT o_custkey) AS unique_sources,
           count(DISTINCT o_orderkey) AS unique_destinations
    FROM orders
    """,
)
def traffic_validation(spark, sf):
    return reports.traffic_validation(orders_as_traffic(spark, sf))


@register(
    "profile_minmax_distinct",
    "N9 A5 A8 A12",
    """
    SELECT count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts,
           count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types
    FROM events
    """,
)
def profile_minmax_distinct(spark, sf):
    return agg.grouped(
        table(spark, sf, "events"),
        [],
        {
            "n": agg.rows(),
            "first_ts": F.min("ts"),
            "last_ts": F.max("ts"),
            "users": agg.distinct_count("user_id"),
            "types": agg.distinct_count("event_type"),
        },
    )


@register(
    "monthly_bytes",
    "N9 A1 O5",
    """
    SELECT cast(year(o_orderdate) AS int) AS year, cast(month(o_orderdate) AS int) AS month,
           cast(sum(cast(floor(o_totalprice) AS bigint)) AS bigint) AS total_bytes
    FROM orders GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def monthly_bytes(spark, sf):
    return reports.monthly_bytes(orders_as_traffic(spark, sf))


@register(
    "monthly_sum",
    "N9 A1 O5",
    """
    SELECT cast(year(l_shipdate) AS int) AS ship_year, cast(month(l_shipdate) AS int) AS ship_month,
           cast(sum(cast(l_quantity AS decimal(18,2))) AS double) AS quantity
    FROM lineitem GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def monthly_sum(spark, sf):
    shipped = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("ship_year"),
        F.month("l_shipdate").alias("ship_month"),
        "l_quantity",
    )
    report = agg.grouped(
        shipped, ["ship_year", "ship_month"], {"quantity": exact_sum(F.col("l_quantity"))}
    )
    return report.orderBy(*agg.ascending("ship_year", "ship_month"))


@register(
    "crosstab_counts",
    "N10 V1",
    """
    SELECT o_orderpriority,
           nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS "F",
           nullif(count(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS "O",
           nullif(count(*) FILTER (WHERE o_orderstatus = 'P'), 0) AS "P"
    FROM orders GROUP BY 1
    """,
)
def crosstab_counts(spark, sf):
    return crosstab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@register(
    "crosstab_sparse",
    "N10 V1",
    """
    SELECT c_nationkey,
           nullif(count(*) FILTER (WHERE c_mktsegment = 'BUILDING'), 0) AS "BUILDING",
           nullif(count(*) FILTER (WHERE c_mktsegment = 'NO SUCH SEGMENT'), 0) AS "NO SUCH SEGMENT",
           nullif(count(*) FILTER (WHERE c_mktsegment NOT IN ('BUILDING', 'NO SUCH SEGMENT')), 0)
             AS "other"
    FROM customer GROUP BY 1
    """,
)
def crosstab_sparse(spark, sf):
    customers = table(spark, sf, "customer")
    listed = ["BUILDING", "NO SUCH SEGMENT"]
    return crosstab(customers, "c_nationkey", "c_mktsegment", listed, rest="other")


@register(
    "crosstab_found_values",
    "N10 V1",
    """
    SELECT c_nationkey,
           nullif(count(*) FILTER (WHERE c_mktsegment = 'AUTOMOBILE'), 0) AS "AUTOMOBILE",
           nullif(count(*) FILTER (WHERE c_mktsegment = 'BUILDING'), 0) AS "BUILDING",
           nullif(count(*) FILTER (WHERE c_mktsegment = 'FURNITURE'), 0) AS "FURNITURE",
           nullif(count(*) FILTER (WHERE c_mktsegment = 'HOUSEHOLD'), 0) AS "HOUSEHOLD",
           nullif(count(*) FILTER (WHERE c_mktsegment = 'MACHINERY'), 0) AS "MACHINERY"
    FROM customer GROUP BY 1
    """,
)
def crosstab_found_values(spark, sf):
    return crosstab(table(spark, sf, "customer"), "c_nationkey", "c_mktsegment")


@register(
    "value_counts_top7",
    "N11 A13",
    """
    SELECT p_brand, count(*) AS count FROM part WHERE p_brand IS NOT NULL
    GROUP BY 1 ORDER BY count DESC, p_brand LIMIT 7
    """,
)
def value_counts_top7(spark, sf):
    return agg.value_counts(table(spark, sf, "part"), "p_brand", 7)


@register(
    "value_counts_filtered",
    "N11 F1 A13",
    """
    SELECT p_name, count(*) AS count FROM part WHERE p_size > 25
    GROUP BY 1 ORDER BY count DESC, p_name LIMIT 10
    """,
)
def value_counts_filtered(spark, sf):
    return agg.value_counts(table(spark, sf, "part").filter(F.col("p_size") > 25), "p_name", 10)


@register(
    "histogram", "N12 A15", "SELECT c_mktsegment, count(*) AS count FROM customer GROUP BY 1"
)
def histogram(spark, sf):
    return agg.histogram(table(spark, sf, "customer"), ["c_mktsegment"])


@register("distinct_values", "A14", "SELECT DISTINCT c_mktsegment FROM customer")
def distinct_values(spark, sf):
    return agg.distinct_values(table(spark, sf, "customer"), "c_mktsegment")


@register(
    "top_segment_hue",
    "N12 F8 A13 A16",
    """
    WITH top AS (SELECT c_mktsegment FROM customer GROUP BY 1
                 ORDER BY count(*) DESC, c_mktsegment LIMIT 3)
    SELECT c_mktsegment, c_nationkey, count(*) AS count
    FROM customer WHERE c_mktsegment IN (SELECT c_mktsegment FROM top) GROUP BY 1, 2
    """,
)
def top_segment_hue(spark, sf):
    customers = table(spark, sf, "customer")
    top = agg.value_counts(customers, "c_mktsegment", 3)
    kept = in_top(customers, top, "c_mktsegment")
    return agg.histogram(kept, ["c_mktsegment", "c_nationkey"])


_BOX_SQL = """
    WITH q AS (
      SELECT l_returnflag AS k, quantile_cont(l_extendedprice, 0.25) AS q1,
             quantile_cont(l_extendedprice, 0.5) AS median,
             quantile_cont(l_extendedprice, 0.75) AS q3
      FROM lineitem GROUP BY 1)
    SELECT l_returnflag, count(l_extendedprice) AS n, round(any_value(q1), 4) AS q1,
           round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3,
           min(l_extendedprice) FILTER (WHERE l_extendedprice >= q1 - 1.5 * (q3 - q1)
             AND l_extendedprice <= q3 + 1.5 * (q3 - q1)) AS whisker_low,
           max(l_extendedprice) FILTER (WHERE l_extendedprice >= q1 - 1.5 * (q3 - q1)
             AND l_extendedprice <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
           count(*) FILTER (WHERE l_extendedprice < q1 - 1.5 * (q3 - q1)
             OR l_extendedprice > q3 + 1.5 * (q3 - q1)) AS outliers
    FROM lineitem JOIN q ON l_returnflag = k GROUP BY 1
    """


def _rounded_boxes(boxes):
    return boxes.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


@register("box_stats", "N12 A17", _BOX_SQL)
def box_stats_query(spark, sf):
    return _rounded_boxes(box_stats(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice"))


@register("box_stats_over_ranges", "A17 (other ranges)", _BOX_SQL)
def box_stats_over_ranges(spark, sf):
    lines = table(spark, sf, "lineitem")
    return _rounded_boxes(box_stats(lines, ["l_returnflag"], "l_extendedprice", accuracy=50))


@register(
    "top_suppliers",
    "N13 J2 A1 A4 O3",
    """
    SELECT s_name, count(l_orderkey) AS lines,
           cast(sum(cast(l_extendedprice AS decimal(18,2))) AS double) AS total_sales,
           cast(sum(cast(l_quantity AS decimal(18,2))) AS double) AS total_quantity
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY 1 ORDER BY total_sales DESC, s_name LIMIT 5
    """,
)
def top_suppliers(spark, sf):
    joined = star_join(
        table(spark, sf, "lineitem"), [(table(spark, sf, "supplier"), "l_suppkey", "s_suppkey")]
    )
    report = agg.grouped(
        joined,
        ["s_name"],
        {
            "lines": F.count("l_orderkey"),
            "total_sales": exact_sum(F.col("l_extendedprice")),
            "total_quantity": exact_sum(F.col("l_quantity")),
        },
    )
    return agg.top_k(report, "total_sales", 5, ["s_name"])


@register(
    "top_parts_rounded",
    "N13 J2 A3 P10 O3",
    """
    SELECT p_name, count(l_orderkey) AS tx_count,
           round(cast(sum(cast(l_extendedprice AS decimal(18,2))) AS double), 2) AS total_sales,
           round(cast(sum(cast(p_retailprice AS decimal(18,2))) AS double) / count(p_retailprice), 2)
             AS avg_retail_price
    FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY 1 ORDER BY total_sales DESC, p_name LIMIT 5
    """,
)
def top_parts_rounded(spark, sf):
    joined = star_join(
        table(spark, sf, "lineitem"), [(table(spark, sf, "part"), "l_partkey", "p_partkey")]
    )
    report = agg.grouped(
        joined,
        ["p_name"],
        {
            "tx_count": F.count("l_orderkey"),
            "total_sales": F.round(exact_sum(F.col("l_extendedprice")), 2),
            "avg_retail_price": F.round(exact_mean(F.col("p_retailprice")), 2),
        },
    )
    return agg.top_k(report, "total_sales", 5, ["p_name"])


@register(
    "filter_compute",
    "N14 P6 F1 F3",
    """
    SELECT event_id, event_type, value, round((value - 100) * 1.2, 6) AS score
    FROM events WHERE value > 50 AND event_type IN ('click', 'view')
    """,
)
def filter_compute(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    scored = reports.filter_and_score(events, "value", "event_type", 50, ["click", "view"])
    return scored.withColumn("score", F.round("score", 6))


@register(
    "group_stats",
    "N14 A3 A5 A6 A7 A9",
    """
    SELECT event_type, round(avg(value), 4) AS mean_val, round(stddev_samp(value), 4) AS std_val,
           count(*) AS n, count(DISTINCT user_id) AS nuniq
    FROM events GROUP BY 1
    """,
)
def group_stats(spark, sf):
    stats = reports.group_statistics(table(spark, sf, "events"), "event_type", "value", "user_id")
    return stats.withColumns({c: F.round(c, 4) for c in ("mean_val", "std_val")})


@register(
    "left_join_m2o",
    "N14 J3 J4",
    """
    SELECT o_custkey, o_orderkey, c_name, c_mktsegment
    FROM orders LEFT JOIN (SELECT c_custkey, c_name, c_mktsegment FROM customer
                           WHERE c_acctbal > 0) ON o_custkey = c_custkey
    """,
)
def left_join_m2o(spark, sf):
    customers = (
        table(spark, sf, "customer")
        .filter("c_acctbal > 0")
        .select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    )
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return reports.with_weight(orders, customers, "o_custkey")


_ROLLING_SQL = """
    SELECT event_id,
           cast(sum(cast(value AS decimal(18,2))) OVER w AS double) / count(value) OVER w AS roll
    FROM events
    WINDOW w AS (ORDER BY epoch_us(ts) RANGE BETWEEN 7199999999 PRECEDING AND CURRENT ROW)
    """


def _rolling(spark, sf, ranges=None):
    events = table(spark, sf, "events").select("event_id", "ts", "value")
    rolled = rolling_mean(events, "ts", "value", reports.TWO_HOURS, "roll", scale=2, ranges=ranges)
    return rolled.select("event_id", "roll")


@register("rolling_2h", "N14 W1", _ROLLING_SQL)
def rolling_2h(spark, sf):
    return _rolling(spark, sf)


@register("rolling_2h_by_slot", "W1", _ROLLING_SQL)
def rolling_2h_by_slot(spark, sf):
    """The same over other ranges of time."""
    return _rolling(spark, sf, ranges=61)


@register(
    "strings_flag",
    "N14 P12 P13",
    """
    SELECT p_partkey, cast(contains(upper(p_name), 'A') AS tinyint) AS has_a FROM part
    """,
)
def strings_flag(spark, sf):
    from sumstone.functions.scalar import contains_flag

    return table(spark, sf, "part").select(
        "p_partkey", contains_flag(F.col("p_name"), "A").alias("has_a")
    )


_CENSUS_SQL = """
    WITH raw AS (
      SELECT cast(o_custkey % 73 + 17 AS text) AS age, o_orderpriority AS education,
        CASE WHEN o_orderkey % 11 = 0 THEN '?' ELSE 'class ' || o_orderkey % 9 END AS workclass,
        CASE WHEN o_orderkey % 17 = 0 THEN '?' ELSE 'job ' || o_custkey % 15 END AS occupation,
        CASE WHEN o_orderkey % 3 = 0 THEN 'Female' ELSE 'Male' END AS sex,
        CASE WHEN o_custkey % 29 = 0 THEN '?' ELSE 'land ' || o_custkey % 25 END AS native_country,
        CASE WHEN o_orderkey % 97 = 0 THEN 'many' ELSE cast(o_orderkey % 60 + 20 AS text) END
          AS hours_per_week,
        CASE WHEN o_totalprice > 200000 THEN '>50K' ELSE '<=50K' END AS income
      FROM orders),
    c AS (
      SELECT cast(age AS bigint) AS age, try_cast(hours_per_week AS bigint) AS hours_per_week,
             education, workclass, occupation, sex, income
      FROM raw WHERE workclass <> '?' AND occupation <> '?' AND native_country <> '?'),
    m AS (SELECT 'hours_per_week box' AS report, income, hours_per_week AS v FROM c
          UNION ALL SELECT 'age box', income, age FROM c),
    q AS (SELECT report, income, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
                 quantile_cont(v, 0.75) AS q3 FROM m GROUP BY 1, 2),
    b AS (
      SELECT report, income, count(v)::double AS n, any_value(q1)::double AS q1,
        any_value(median)::double AS median, any_value(q3)::double AS q3,
        min(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::double AS whisker_low,
        max(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::double AS whisker_high,
        count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1))::double AS outliers
      FROM m JOIN q USING (report, income) GROUP BY 1, 2),
    w AS (SELECT workclass, count(*) AS n FROM c GROUP BY 1 ORDER BY n DESC, workclass LIMIT 7),
    o AS (SELECT occupation, count(*) AS n FROM c WHERE income = '>50K' GROUP BY 1
          ORDER BY n DESC, occupation LIMIT 10)
    SELECT 'incomes' AS report, NULL::text AS category, income, NULL::text AS figure,
           count(*)::double AS value FROM c GROUP BY income
    UNION ALL SELECT 'education by income' AS report, education AS category, income, NULL::text AS figure,
           count(*)::double AS value FROM c GROUP BY education, income
    UNION ALL SELECT 'sex by income', sex, income, NULL, count(*) FROM c GROUP BY sex, income
    UNION ALL SELECT 'top workclasses', workclass, NULL, NULL, n FROM w
    UNION ALL SELECT 'top occupations', occupation, NULL, NULL, n FROM o
    UNION ALL SELECT 'workclass by income', workclass, income, NULL, count(*) FROM c
              WHERE workclass IN (SELECT workclass FROM w) GROUP BY workclass, income
    UNION ALL SELECT report, NULL, income, figure, value FROM (
      UNPIVOT b ON n, q1, median, q3, whisker_low, whisker_high, outliers INTO NAME figure VALUE value)
    """


@register("census_chain", "N10 N11 N12 S7 M1 M2 M3 V1 A13 A15 A16 A17 F8", _CENSUS_SQL)
def census_chain(spark, sf):
    """The census analysis from a CSV file with dotted names and ``?`` markers to all its figures."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")

    def some(marked, text):
        return F.when(marked, F.lit("?")).otherwise(text)

    raw = table(spark, sf, "orders").select(
        (customer % 73 + 17).alias("age"),
        some(key % 11 == 0, F.concat(F.lit("class "), (key % 9).cast("string"))).alias("workclass"),
        key.alias("fnlwgt"),
        F.col("o_orderpriority").alias("education"),
        (key % 16 + 1).alias("education.num"),
        some(key % 17 == 0, F.concat(F.lit("job "), (customer % 15).cast("string"))).alias("occupation"),
        F.when(key % 3 == 0, "Female").otherwise("Male").alias("sex"),
        (key % 5000).alias("capital.gain"),
        (customer % 900).alias("capital.loss"),
        F.when(key % 97 == 0, "many").otherwise((key % 60 + 20).cast("string")).alias("hours.per.week"),
        some(customer % 29 == 0, F.concat(F.lit("land "), (customer % 25).cast("string"))).alias("native.country"),
        F.when(F.col("o_totalprice") > 200_000, ">50K").otherwise("<=50K").alias("income"),
    )
    path = scratch_path(spark, "census")
    writers.write_csv(raw, path)
    cleaned = reports.census_clean(readers.read_csv(spark, path, all_text=True))
    return reports.census_report(cleaned)
