"""Declared schemas: reading with one skips the job that would look for it in the files."""

from __future__ import annotations

# Tables of the TPC-H-like test data.
TABLES: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}

# Inputs of the reports in ``sumstone.plans.reports``.
SALES_ORDERS = (
    "order_id bigint, order_date timestamp_ntz, region string, category string, sales int, "
    "quantity int, discount double, status string"
)
EVENTS_WIDE = (
    "country string, channel string, user_id bigint, order_id bigint, revenue double, "
    "event_date date, event_type string, device string, currency string, quantity int, "
    "session_duration_sec double, is_new_customer boolean, discount_pct double"
)
EVENTS_NARROW = (
    "event_date date, country string, channel string, user_id bigint, order_id bigint, "
    "revenue double"
)
REGION_SALES = "region string, price double, qty bigint"
CATEGORY_SALES = "category string, region string, sales double"
MICRO = "id int, cat string, val float, ts timestamp_ntz, txt string"
TRAFFIC = (
    "timestamp timestamp_ntz, year int, month smallint, day smallint, src bigint, dst bigint, "
    "src_port int, dst_port int, protocol string, act string, byt bigint"
)
# The column ``Inserted`` of these files is left out on purpose: no report uses it.
FACT_SALES = (
    "ID bigint, InvoiceItemNumber string, DateID int, StoreID int, CategoryID int, VendorID int, "
    "ItemID int, Pack int, BottleVolumeMl int, StateBottleCost double, StateBottleRetail double, "
    "BottlesSold int, SaleDollars double, VolumeSoldLiters double, VolumeSoldGallons double, "
    "PartitionKeyYear int"
)
DIM_CATEGORY = "CategoryID bigint, CategoryName string"
DIM_VENDOR = "VendorID bigint, VendorName string"
DIM_ITEM = "ItemID bigint, ItemName string"
DIM_STORE = (
    "StoreID bigint, StoreName string, Address string, City string, ZipCode bigint, "
    "County string, StoreLocation string"
)
CENSUS_NUMERIC = [
    "age", "fnlwgt", "education_num", "capital_gain", "capital_loss", "hours_per_week",
]
