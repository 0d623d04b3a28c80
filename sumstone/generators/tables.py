"""The input tables of the reports, generated from a frame of row numbers.

Each function takes a frame and the name of an integer column with distinct row numbers (see
``row_numbers``), so a table can be as long as the frame is, and is computed without any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sumstone.functions.calendar import date_key
from sumstone.functions.scalar import (
    fixed_decimals,
    labelled,
    pack_ipv4,
    padded_code,
    pick,
    timestamp_from_seconds,
    year_of_date_key,
)
from sumstone.generators.draws import (
    below,
    choice,
    decimal,
    gamma_two,
    integer,
    normal,
    uniform,
    weighted,
)

# The value domains of the input tables.
REGIONS = ["north", "south", "east", "west"]
REGIONS_CAPITALISED = ["North", "South", "East", "West"]
CATEGORIES = ["electronics", "clothing", "furniture", "food", "sports"]
STATUSES = ["completed", "returned", "pending", "cancelled"]
COUNTRIES = [
    "US", "GB", "DE", "FR", "JP", "CA", "AU", "IN", "BR", "MX",
    "IT", "ES", "NL", "SE", "KR", "CN", "RU", "ZA", "AR", "SG",
    "CH", "NO", "DK", "FI", "AT", "BE", "PT", "NZ", "IE", "PL",
    "TR", "TH", "ID", "MY", "PH", "VN", "CO", "CL", "PE", "EG",
    "NG", "KE", "AE", "SA", "IL", "HK", "TW", "CZ", "RO", "GR",
]
CHANNELS = [
    "direct", "social", "email", "organic", "paid_search", "referral", "affiliate", "display",
]
EVENT_TYPES = [
    "purchase", "refund", "view", "add_to_cart", "checkout", "wishlist_add", "review_submit",
    "account_create",
]
DEVICES = ["mobile", "desktop", "tablet"]
CURRENCIES = ["USD", "EUR", "GBP", "JPY", "CAD", "AUD", "INR"]
SIX_COUNTRIES = ["US", "UK", "DE", "FR", "IN", "JP"]
FOUR_CHANNELS = ["search", "social", "email", "direct"]
TRADE_REGIONS = ["US", "EU", "APAC", "LATAM", "MEA"]
SALES_CATEGORIES = ["A", "B", "C", "D"]
SALES_REGIONS = ["NA", "EU", "APAC"]
MICRO_CATEGORIES = ["a", "b", "c", "d", "e", "f"]
MICRO_TEXTS = ["alpha", "beta", "gamma", "delta", "epsilon"]
SPIRIT_TYPES = [
    "VODKA", "STRAIGHT BOURBON WHISKIES", "CANADIAN WHISKIES", "TEQUILA", "SPICED RUM",
    "AMERICAN COCKTAILS", "FLAVORED VODKA", "BLENDED WHISKIES",
    "PUERTO RICO & VIRGIN ISLANDS RUM", "IRISH WHISKIES", "SCOTCH WHISKIES", "IMPORTED VODKA",
    "PEPPERMINT SCHNAPPS", "TENNESSEE WHISKEY", "GIN",
]
VENDOR_NAMES = [
    "Diageo Americas", "Sazerac Co., Inc.", "Pernod Ricard USA", "Heaven Hill Brands",
    "Jim Beam Brands", "Luxco Inc", "Proximo Spirits", "Bacardi USA Inc", "Fifth Generation Inc",
    "Campari Group", "Brown-Forman Corporation", "E & J Gallo Winery",
]
# city, county, zip code, longitude, latitude
CITIES = [
    ("Des Moines", "Polk", 50309, -93.6091, 41.6005),
    ("Cedar Rapids", "Linn", 52401, -91.6656, 41.9779),
    ("Davenport", "Scott", 52801, -90.5776, 41.5236),
    ("Sioux City", "Woodbury", 51101, -96.4003, 42.4999),
    ("Iowa City", "Johnson", 52240, -91.5302, 41.6611),
    ("Waterloo", "Black Hawk", 50701, -92.3426, 42.4928),
    ("Ames", "Story", 50010, -93.6208, 42.0308),
    ("Dubuque", "Dubuque", 52001, -90.6646, 42.5006),
    ("Council Bluffs", "Pottawattamie", 51501, -95.8608, 41.2619),
    ("Ankeny", "Dallas", 50021, -93.6022, 41.7297),
]
ITEM_LABEL = "Iowa Liquor Item #"
PACKS = [6, 12, 24]
BOTTLE_VOLUMES = [50, 200, 375, 750, 1000, 1750]
GALLONS_PER_LITRE = 0.264172
PORT_WEIGHTS = {
    80: 0.34, 443: 0.50, 53: 0.05, 22: 0.03, 25: 0.02,
    3389: 0.01, 8080: 0.02, 8443: 0.02, 3306: 0.005, 110: 0.005,
}
PROTOCOL_WEIGHTS = {"TCP": 0.80, "UDP": 0.19, "ICMP": 0.01}
ACTION_WEIGHTS = {"ALLOW": 0.75, "BLOCK": 0.15, "DROP": 0.10}

_DAY = 86_400
_START_2022 = 1_640_995_200  # 2022-01-01 in seconds since 1970
_START_MICRO = 1_725_000_000
FIRST_CATEGORY, CATEGORY_COUNT = 1_000, 300
FIRST_STORE, STORE_COUNT = 2_000, 2_500
FIRST_VENDOR, VENDOR_COUNT = 500, 600
FIRST_ITEM, ITEM_COUNT = 100_000, 50_000
CALENDAR_DAYS = 5_479  # 2012-01-01 … 2026-12-31


def sales_orders(
    ids: DataFrame, id: str = "id", first_order: int = 1_000, capitalised: bool = False
) -> DataFrame:
    """Sales orders, one per minute from 2022-01-01 on."""
    n = F.col(id).cast("bigint")
    return ids.select(
        (n + first_order).alias("order_id"),
        timestamp_from_seconds(n * 60 + _START_2022).alias("order_date"),
        choice(n, 1, REGIONS_CAPITALISED if capitalised else REGIONS).alias("region"),
        choice(n, 2, CATEGORIES).alias("category"),
        integer(n, 3, 100, 10_000).cast("int").alias("sales"),
        integer(n, 4, 1, 20).cast("int").alias("quantity"),
        decimal(n, 5, 0.0, 0.5, 2).alias("discount"),
        choice(n, 6, STATUSES).alias("status"),
    )


def events_wide(ids: DataFrame, id: str = "id") -> DataFrame:
    """Customer events with 13 columns, dated 2023-01-01 … 2026-08-05."""
    n = F.col(id).cast("bigint")
    day = F.expr("DATE'2023-01-01'")
    return ids.select(
        choice(n, 1, COUNTRIES).alias("country"),
        choice(n, 2, CHANNELS).alias("channel"),
        integer(n, 3, 100_000, 999_999).alias("user_id"),
        integer(n, 4, 10_000_000, 99_999_999).alias("order_id"),
        decimal(n, 5, 0.99, 1_999.99, 2).alias("revenue"),
        F.date_add(day, below(n, 6, 1_313).cast("int")).alias("event_date"),
        choice(n, 7, EVENT_TYPES).alias("event_type"),
        choice(n, 8, DEVICES).alias("device"),
        choice(n, 9, CURRENCIES).alias("currency"),
        integer(n, 10, 1, 10).cast("int").alias("quantity"),
        decimal(n, 11, 5.0, 3_600.0, 1).alias("session_duration_sec"),
        (uniform(n, 12) < 0.3).alias("is_new_customer"),
        F.when(uniform(n, 13) < 0.4, decimal(n, 14, 0.0, 50.0, 1))
        .otherwise(F.lit(0.0))
        .alias("discount_pct"),
    )


def events_narrow(ids: DataFrame, id: str = "id") -> DataFrame:
    """Events with 6 columns; revenue is gamma distributed and zero for 15 % of the rows."""
    n = F.col(id).cast("bigint")
    day = F.expr("DATE'2024-01-01'")
    return ids.select(
        F.date_add(day, below(n, 1, 762).cast("int")).alias("event_date"),
        choice(n, 2, SIX_COUNTRIES).alias("country"),
        choice(n, 3, FOUR_CHANNELS).alias("channel"),
        integer(n, 4, 1, 200_000).alias("user_id"),
        integer(n, 5, 1, 900_000).alias("order_id"),
        F.when(uniform(n, 6) < 0.15, F.lit(0.0))
        .otherwise(F.round(gamma_two(n, 7, 30.0), 2))
        .alias("revenue"),
    )


def region_sales(ids: DataFrame, id: str = "id") -> DataFrame:
    """Region, price and quantity."""
    n = F.col(id).cast("bigint")
    return ids.select(
        choice(n, 1, TRADE_REGIONS).alias("region"),
        (uniform(n, 2) * 100.0).alias("price"),
        below(n, 3, 10).alias("qty"),
    )


def category_sales(ids: DataFrame, id: str = "id") -> DataFrame:
    """Category, region and normally distributed sales."""
    n = F.col(id).cast("bigint")
    return ids.select(
        choice(n, 1, SALES_CATEGORIES).alias("category"),
        choice(n, 2, SALES_REGIONS).alias("region"),
        normal(n, 3, 500.0, 100.0).alias("sales"),
    )


def micro(ids: DataFrame, id: str = "id", extra: Sequence[str] = ()) -> DataFrame:
    """Keys, categories, 32-bit values, times on a one-second grid over ten days, short texts.

    ``extra`` columns of the input are kept.
    """
    n = F.col(id).cast("bigint")
    return ids.select(
        below(n, 1, 200_000).cast("int").alias("id"),
        choice(n, 2, MICRO_CATEGORIES).alias("cat"),
        normal(n, 3, 100.0, 15.0).cast("float").alias("val"),
        timestamp_from_seconds(below(n, 4, _DAY * 10) + _START_MICRO).alias("ts"),
        choice(n, 5, MICRO_TEXTS).alias("txt"),
        *extra,
    )


def micro_dimension(ids: DataFrame, id: str = "id") -> DataFrame:
    """Weight per key."""
    n = F.col(id)
    return ids.select(n.cast("int").alias("id"), (n % 17).cast("float").alias("weight"))


def inserted(n: Column) -> Column:
    """Load time of a generated row: the seconds of one day in turn, without zone."""
    start = F.to_timestamp_ntz(F.lit("2025-01-01 00:00:00"))
    return (start + F.make_dt_interval(secs=n % 86_400)).alias("Inserted")


def dim_category(ids: DataFrame, id: str = "id") -> DataFrame:
    n = F.col(id).cast("bigint")
    group = F.floor(n / len(SPIRIT_TYPES)) + 1
    return ids.select(
        (n + FIRST_CATEGORY).alias("CategoryID"),
        labelled(pick(SPIRIT_TYPES, n), " TYPE-", group).alias("CategoryName"),
        inserted(n),
    )


def dim_store(ids: DataFrame, id: str = "id") -> DataFrame:
    n = F.col(id).cast("bigint")
    store = n + FIRST_STORE
    city, county, code, longitude, latitude = (
        pick([c[i] for c in CITIES], store) for i in range(5)
    )
    point = labelled(
        "POINT(", fixed_decimals(longitude, 4), " ", fixed_decimals(latitude, 4), ")"
    )
    return ids.select(
        store.alias("StoreID"),
        labelled("Store #", store, " - ", city).alias("StoreName"),
        labelled((store * 17) % 9000 + 100, " Main St").alias("Address"),
        city.alias("City"),
        code.cast("bigint").alias("ZipCode"),
        county.alias("County"),
        point.alias("StoreLocation"),
        inserted(n),
    )


def dim_vendor(ids: DataFrame, id: str = "id") -> DataFrame:
    n = F.col(id).cast("bigint")
    return ids.select(
        (n + FIRST_VENDOR).alias("VendorID"),
        labelled(pick(VENDOR_NAMES, n), " #", n + 1).alias("VendorName"),
        inserted(n),
    )


def dim_item(ids: DataFrame, id: str = "id") -> DataFrame:
    n = F.col(id).cast("bigint")
    item = n + FIRST_ITEM
    name = labelled(ITEM_LABEL, item).alias("ItemName")
    return ids.select(item.alias("ItemID"), name, inserted(n))


def fact_sales(ids: DataFrame, id: str = "id") -> DataFrame:
    """Sales facts with foreign keys into the dimensions above and the 2012-2026 calendar."""
    n = F.col(id).cast("bigint")
    day = F.date_add(F.expr("DATE'2012-01-01'"), below(n, 1, CALENDAR_DAYS).cast("int"))
    # Amounts are drawn in cents and halves of cents, so that every product is exact.
    cost_cents = integer(n, 8, 250, 12_001)
    retail_cents = F.floor((cost_cents * 3 + 1) / 2)
    millilitres = choice(n, 7, BOTTLE_VOLUMES)
    bottles = integer(n, 9, 1, 96)
    litres = (millilitres * bottles) / F.lit(1000.0)
    drawn = ids.select(
        n.alias("ID"),
        padded_code("INV-", n).alias("InvoiceItemNumber"),
        date_key(day).alias("DateID"),
        integer(n, 2, FIRST_STORE, FIRST_STORE + STORE_COUNT).cast("int").alias("StoreID"),
        integer(n, 3, FIRST_CATEGORY, FIRST_CATEGORY + CATEGORY_COUNT)
        .cast("int")
        .alias("CategoryID"),
        integer(n, 4, FIRST_VENDOR, FIRST_VENDOR + VENDOR_COUNT).cast("int").alias("VendorID"),
        integer(n, 5, FIRST_ITEM, FIRST_ITEM + ITEM_COUNT).cast("int").alias("ItemID"),
        choice(n, 6, PACKS).alias("Pack"),
        millilitres.alias("BottleVolumeMl"),
        (cost_cents / F.lit(100.0)).alias("StateBottleCost"),
        (retail_cents / F.lit(100.0)).alias("StateBottleRetail"),
        bottles.cast("int").alias("BottlesSold"),
        (retail_cents * bottles / F.lit(100.0)).alias("SaleDollars"),
        litres.alias("VolumeSoldLiters"),
        F.round(litres * F.lit(GALLONS_PER_LITRE), 4).alias("VolumeSoldGallons"),
    )
    dated = drawn.withColumn("PartitionKeyYear", year_of_date_key(F.col("DateID")))
    return dated.withColumn("Inserted", inserted(F.col("ID")))


def traffic(ids: DataFrame, id: str = "id", year: int = 2024) -> DataFrame:
    """Firewall log: a third of the rows moved to June, weighted ports, protocols and actions.

    Months are laid out with 28 days each, so ``month`` is not the month of ``timestamp``.
    """
    n = F.col(id).cast("bigint")
    drawn = ids.select(
        n.alias("_n"),
        F.when(uniform(n, 1) < 0.35, F.lit(6)).otherwise(integer(n, 2, 1, 13)).alias("_month"),
        integer(n, 3, 1, 29).alias("_day"),
    )
    n = F.col("_n")
    days = (F.col("_month") - 1) * 28 + (F.col("_day") - 1)
    start = F.expr(f"TIMESTAMP_NTZ'{year:04d}-01-01 00:00:00'")
    seconds = days * _DAY + below(n, 4, _DAY)
    return drawn.select(
        (start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).alias("timestamp"),
        F.lit(year).alias("year"),
        F.col("_month").cast("int").alias("month"),
        F.col("_day").cast("int").alias("day"),
        pack_ipv4(10, below(n, 5, 16_500_000)).alias("src"),
        integer(n, 6, 1, 4_200_000_000).alias("dst"),
        integer(n, 7, 1_024, 65_536).cast("int").alias("src_port"),
        weighted(n, 8, PORT_WEIGHTS).alias("dst_port"),
        weighted(n, 9, PROTOCOL_WEIGHTS).alias("protocol"),
        weighted(n, 10, ACTION_WEIGHTS).alias("act"),
        F.when(uniform(n, 11) < 0.30, F.lit(0).cast("bigint"))
        .otherwise(integer(n, 12, 60, 1_500_000))
        .alias("byt"),
    )
