"""Generated tables, one row per row of a test table.

The draws are integer arithmetic, so the SQL beside each query recomputes the table value by value.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sumstone.generators import tables as gen
from sumstone.generators.draws import PRIME, draw_sql
from sumstone.plans.registry import register, table


def _below(row: str, salt: int, n: int) -> str:
    if n < 1_000_000:
        return f"({draw_sql(row, salt)} % {n})"
    return f"(({draw_sql(row, salt)} * 1000 + {draw_sql(row, salt + 500)} % 1000) % {n})"


def _int(row: str, salt: int, low: int, high: int) -> str:
    return f"({_below(row, salt, high - low)} + {low})"


def _decimal(row: str, salt: int, low: float, high: float, digits: int) -> str:
    unit = 10**digits
    return f"({_int(row, salt, round(low * unit), round(high * unit) + 1)} / {float(unit)})"


def _list(values) -> str:
    quoted = [f"'{v}'" if isinstance(v, str) else str(v) for v in values]
    return "[" + ", ".join(quoted) + "]"


def _choice(row: str, salt: int, values) -> str:
    return f"({_list(values)})[({_below(row, salt, len(values))} + 1)::int]"


def _uniform(row: str, salt: int) -> str:
    return f"({draw_sql(row, salt)} / {PRIME}.0::double)"


def _weighted(row: str, salt: int, weights) -> str:
    reached, cases = 0.0, []
    items = list(weights.items())
    for value, weight in items[:-1]:
        reached += weight
        shown = f"'{value}'" if isinstance(value, str) else value
        cases.append(f"WHEN {_uniform(row, salt)} < {round(reached, 9)}::double THEN {shown}")
    last = items[-1][0]
    shown = f"'{last}'" if isinstance(last, str) else last
    return f"(CASE {' '.join(cases)} ELSE {shown} END)"


def _normal(row: str, salt: int, mean: float, deviation: float) -> str:
    radius = f"sqrt(-2.0::double * ln(({draw_sql(row, salt)} + 1) / {PRIME}.0::double))"
    return f"({mean}::double + {deviation}::double * {radius} * cos(2.0::double * pi() * {_uniform(row, salt + 500)}))"


_K = "o_orderkey"
_EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"


@register(
    "gen_sales_orders",
    "G1",
    f"""
    SELECT {_K} + 1000 AS order_id, {_EPOCH} + ({_K} * 60 + 1640995200) * INTERVAL 1 SECOND AS order_date,
           {_choice(_K, 1, gen.REGIONS)} AS region, {_choice(_K, 2, gen.CATEGORIES)} AS category,
           cast({_int(_K, 3, 100, 10000)} AS int) AS sales, cast({_int(_K, 4, 1, 20)} AS int) AS quantity,
           {_decimal(_K, 5, 0.0, 0.5, 2)} AS discount, {_choice(_K, 6, gen.STATUSES)} AS status
    FROM orders
    """,
)
def gen_sales_orders(spark, sf):
    return gen.sales_orders(table(spark, sf, "orders"), _K)


@register(
    "gen_events_wide",
    "G2",
    f"""
    SELECT {_choice(_K, 1, gen.COUNTRIES)} AS country, {_choice(_K, 2, gen.CHANNELS)} AS channel,
           {_int(_K, 3, 100000, 999999)} AS user_id, {_int(_K, 4, 10000000, 99999999)} AS order_id,
           {_decimal(_K, 5, 0.99, 1999.99, 2)} AS revenue,
           DATE '2023-01-01' + cast({_below(_K, 6, 1313)} AS int) AS event_date,
           {_choice(_K, 7, gen.EVENT_TYPES)} AS event_type, {_choice(_K, 8, gen.DEVICES)} AS device,
           {_choice(_K, 9, gen.CURRENCIES)} AS currency, cast({_int(_K, 10, 1, 10)} AS int) AS quantity,
           {_decimal(_K, 11, 5.0, 3600.0, 1)} AS session_duration_sec,
           {_uniform(_K, 12)} < 0.3::double AS is_new_customer,
           CASE WHEN {_uniform(_K, 13)} < 0.4::double THEN {_decimal(_K, 14, 0.0, 50.0, 1)} ELSE 0.0::double END
             AS discount_pct
    FROM orders
    """,
)
def gen_events_wide(spark, sf):
    return gen.events_wide(table(spark, sf, "orders"), _K)


@register(
    "gen_events_narrow",
    "G3",
    f"""
    SELECT DATE '2024-01-01' + cast({_below(_K, 1, 762)} AS int) AS event_date,
           {_choice(_K, 2, gen.SIX_COUNTRIES)} AS country, {_choice(_K, 3, gen.FOUR_CHANNELS)} AS channel,
           {_int(_K, 4, 1, 200000)} AS user_id, {_int(_K, 5, 1, 900000)} AS order_id,
           CASE WHEN {_uniform(_K, 6)} < 0.15::double THEN 0.0::double ELSE
             round(-30.0::double * (ln(({draw_sql(_K, 7)} + 1) / {PRIME}.0::double)
                                  + ln(({draw_sql(_K, 507)} + 1) / {PRIME}.0::double)), 2) END AS revenue
    FROM orders
    """,
)
def gen_events_narrow(spark, sf):
    return gen.events_narrow(table(spark, sf, "orders"), _K)


@register(
    "gen_region_sales",
    "G4",
    f"""
    SELECT {_choice(_K, 1, gen.TRADE_REGIONS)} AS region, {_uniform(_K, 2)} * 100.0::double AS price,
           {_below(_K, 3, 10)} AS qty
    FROM orders
    """,
)
def gen_region_sales(spark, sf):
    return gen.region_sales(table(spark, sf, "orders"), _K)


@register(
    "gen_category_sales",
    "G5",
    f"""
    SELECT {_choice(_K, 1, gen.SALES_CATEGORIES)} AS category, {_choice(_K, 2, gen.SALES_REGIONS)} AS region,
           round({_normal(_K, 3, 500.0, 100.0)}, 6) AS sales
    FROM orders
    """,
)
def gen_category_sales(spark, sf):
    drawn = gen.category_sales(table(spark, sf, "orders"), _K)
    return drawn.withColumn("sales", F.round("sales", 6))


@register(
    "gen_micro",
    "G6 P8",
    f"""
    SELECT cast({_below(_K, 1, 200000)} AS int) AS id, {_choice(_K, 2, gen.MICRO_CATEGORIES)} AS cat,
           cast(round(cast({_normal(_K, 3, 100.0, 15.0)} AS real), 2) AS real) AS val,
           {_EPOCH} + ({_below(_K, 4, 864000)} + 1725000000) * INTERVAL 1 SECOND AS ts,
           {_choice(_K, 5, gen.MICRO_TEXTS)} AS txt, weight
    FROM orders JOIN (SELECT c_custkey AS k, cast(c_custkey % 17 AS real) AS weight FROM customer)
      ON o_custkey = k
    """,
)
def gen_micro(spark, sf):
    """The micro table, its value rounded, joined to the weights of the customers."""
    orders = table(spark, sf, "orders")
    drawn = gen.micro(orders, _K, extra=["o_custkey"])
    weights = gen.micro_dimension(table(spark, sf, "customer"), "c_custkey")
    weights = weights.withColumnRenamed("id", "key")
    joined = drawn.join(weights, drawn["o_custkey"] == weights["key"])
    return joined.withColumn("val", F.round("val", 2)).drop("o_custkey", "key")


@register(
    "gen_dim_category",
    "G7 P19 P22",
    f"""
    SELECT c_custkey + 1000 AS "CategoryID",
           ({_list(gen.SPIRIT_TYPES)})[(c_custkey % 15 + 1)::int] || ' TYPE-' || (c_custkey // 15 + 1)
             AS "CategoryName", TIMESTAMP '2025-01-01' + (c_custkey % 86400) * INTERVAL 1 SECOND AS "Inserted"
    FROM customer
    """,
)
def gen_dim_category(spark, sf):
    return gen.dim_category(table(spark, sf, "customer"), "c_custkey")


def _city(i: int) -> str:
    return f"({_list([c[i] for c in gen.CITIES])})[((c_custkey + 2000) % 10 + 1)::int]"


@register(
    "gen_dim_store",
    "G7 P19 P22",
    f"""
    SELECT c_custkey + 2000 AS "StoreID",
           'Store #' || (c_custkey + 2000) || ' - ' || {_city(0)} AS "StoreName",
           (((c_custkey + 2000) * 17) % 9000 + 100) || ' Main St' AS "Address",
           {_city(0)} AS "City", cast({_city(2)} AS bigint) AS "ZipCode", {_city(1)} AS "County",
           printf('POINT(%.4f %.4f)', {_city(3)}::double, {_city(4)}::double) AS "StoreLocation",
           TIMESTAMP '2025-01-01' + (c_custkey % 86400) * INTERVAL 1 SECOND AS "Inserted"
    FROM customer
    """,
)
def gen_dim_store(spark, sf):
    return gen.dim_store(table(spark, sf, "customer"), "c_custkey")


@register(
    "gen_dim_vendor",
    "G7 P19 P22",
    f"""
    SELECT s_suppkey + 500 AS "VendorID",
           ({_list(gen.VENDOR_NAMES)})[(s_suppkey % 12 + 1)::int] || ' #' || (s_suppkey + 1) AS "VendorName",
           TIMESTAMP '2025-01-01' + (s_suppkey % 86400) * INTERVAL 1 SECOND AS "Inserted"
    FROM supplier
    """,
)
def gen_dim_vendor(spark, sf):
    return gen.dim_vendor(table(spark, sf, "supplier"), "s_suppkey")


@register(
    "gen_dim_item",
    "G7 P19",
    f"""
    SELECT p_partkey + 100000 AS "ItemID", '{gen.ITEM_LABEL}' || (p_partkey + 100000) AS "ItemName",
           TIMESTAMP '2025-01-01' + (p_partkey % 86400) * INTERVAL 1 SECOND AS "Inserted"
    FROM part
    """,
)
def gen_dim_item(spark, sf):
    return gen.dim_item(table(spark, sf, "part"), "p_partkey")


_DAY = f"(DATE '2012-01-01' + cast({_below(_K, 1, gen.CALENDAR_DAYS)} AS int))"
_RETAIL = f"(({_int(_K, 8, 250, 12001)} * 3 + 1) // 2)"
_BOTTLES = _int(_K, 9, 1, 96)
_LITRES = f"({_choice(_K, 7, gen.BOTTLE_VOLUMES)} * {_BOTTLES} / 1000.0::double)"


@register(
    "gen_fact_sales",
    "G9 P9 P19",
    f"""
    SELECT {_K} AS "ID", printf('INV-%010d', {_K}) AS "InvoiceItemNumber",
           cast(strftime({_DAY}, '%Y%m%d') AS int) AS "DateID",
           cast({_int(_K, 2, 2000, 4500)} AS int) AS "StoreID",
           cast({_int(_K, 3, 1000, 1300)} AS int) AS "CategoryID",
           cast({_int(_K, 4, 500, 1100)} AS int) AS "VendorID",
           cast({_int(_K, 5, 100000, 150000)} AS int) AS "ItemID",
           {_choice(_K, 6, gen.PACKS)} AS "Pack", {_choice(_K, 7, gen.BOTTLE_VOLUMES)} AS "BottleVolumeMl",
           {_int(_K, 8, 250, 12001)} / 100.0::double AS "StateBottleCost",
           {_RETAIL} / 100.0::double AS "StateBottleRetail", cast({_BOTTLES} AS int) AS "BottlesSold",
           {_RETAIL} * {_BOTTLES} / 100.0::double AS "SaleDollars", {_LITRES} AS "VolumeSoldLiters",
           round({_LITRES} * {gen.GALLONS_PER_LITRE}::double, 4) AS "VolumeSoldGallons",
           cast(year({_DAY}) AS int) AS "PartitionKeyYear",
           TIMESTAMP '2025-01-01' + ({_K} % 86400) * INTERVAL 1 SECOND AS "Inserted"
    FROM orders
    """,
)
def gen_fact_sales(spark, sf):
    return gen.fact_sales(table(spark, sf, "orders"), _K)


_MONTH = f"(CASE WHEN {_uniform(_K, 1)} < 0.35::double THEN 6 ELSE {_int(_K, 2, 1, 13)} END)"
_MONTH_DAY = _int(_K, 3, 1, 29)


@register(
    "gen_traffic",
    "G10 P20 P21",
    f"""
    SELECT TIMESTAMP '2024-01-01 00:00:00'
             + ((({_MONTH} - 1) * 28 + ({_MONTH_DAY} - 1)) * 86400 + {_below(_K, 4, 86400)}) * INTERVAL 1 SECOND
             AS timestamp,
           2024 AS year, cast({_MONTH} AS int) AS month, cast({_MONTH_DAY} AS int) AS day,
           (10::bigint << 24) | {_below(_K, 5, 16500000)} AS src, {_int(_K, 6, 1, 4200000000)} AS dst,
           cast({_int(_K, 7, 1024, 65536)} AS int) AS src_port, {_weighted(_K, 8, gen.PORT_WEIGHTS)} AS dst_port,
           {_weighted(_K, 9, gen.PROTOCOL_WEIGHTS)} AS protocol, {_weighted(_K, 10, gen.ACTION_WEIGHTS)} AS act,
           CASE WHEN {_uniform(_K, 11)} < 0.3::double THEN 0 ELSE {_int(_K, 12, 60, 1500000)} END AS byt
    FROM orders
    """,
)
def gen_traffic(spark, sf):
    return gen.traffic(table(spark, sf, "orders"), _K)
