"""The everyday reports, as functions of their input frames.

Column names are those of the input schemas in ``sumstone.sources.schemas``.  Money columns are
added exactly (see ``sumstone.functions.exact``), so a report gives the same digits on every run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sumstone.functions.exact import (
    exact_mean,
    exact_sum,
    high_part,
    joined_parts,
    low_part,
    scaled,
)
from sumstone.functions.scalar import (
    affine_score,
    bytes_to_gib,
    bytes_to_mib,
    contains_flag,
    modulo_bucket,
    net_of_rate,
    product,
    two_way_flag,
)
from sumstone.operators import aggregate as agg
from sumstone.operators.clean import clean_table
from sumstone.operators.filters import all_of, among, on_or_after
from sumstone.operators.joins import in_top, lookup, star_join, within_keys
from sumstone.operators.ordered import ordinal_rank, small_or_lazy
from sumstone.operators.pivot import crosstab, pivot_mean
from sumstone.operators.quantiles import box_stats
from sumstone.operators.setops import append_summary, stack
from sumstone.operators.timeseries import resample, rolling_mean, tumbling
from sumstone.sources.schemas import CENSUS_NUMERIC
from sumstone.sources.writers import to_rows

TWO_HOURS = dt.timedelta(hours=2)
FIVE_MINUTES = dt.timedelta(minutes=5)


# --- events ---------------------------------------------------------------------------------


def top_channels(
    events: DataFrame,
    since: dt.date | str,
    countries: Sequence[str],
    k: int = 10,
    null_as_value: bool = False,
    dense_ids: bool = False,
) -> DataFrame:
    """Distinct users, orders and revenue by country and channel; the ``k`` best by revenue.

    ``dense_ids`` counts users with bitmaps, for user numbers that fill their range.
    """
    kept = events.filter(
        all_of(
            on_or_after(events, "event_date", since),
            among("country", countries),
            F.col("revenue") > 0,
        )
    )
    keys = ["country", "channel"]
    if dense_ids and not null_as_value:
        units = scaled(F.col("revenue"), 2)
        sums = {
            "orders": F.count("order_id"),
            "_high": F.sum(high_part(units)),
            "_low": F.sum(low_part(units)),
        }
        report = agg.grouped_with_dense_ids(kept, keys, "user_id", "users", sums)
        revenue = joined_parts(F.col("_high"), F.col("_low"), 2).alias("revenue")
        report = report.select(*keys, "users", "orders", revenue)
    else:
        report = agg.grouped(
            kept,
            keys,
            {
                "users": agg.distinct_count("user_id", null_as_value),
                "orders": F.count("order_id"),
                "revenue": exact_sum(F.col("revenue")),
            },
        )
    return agg.top_k(report, "revenue", k, keys)


# --- sales ----------------------------------------------------------------------------------


def revenue_by(
    sales: DataFrame, key: str = "region", price: str = "price", qty: str = "qty", scale: int = 6
) -> DataFrame:
    """Sum of price times quantity where positive, by key, largest first."""
    revenue = product(price, qty)
    report = agg.grouped(
        sales.filter(revenue > 0), [key], {"revenue": exact_sum(revenue, scale)}
    )
    return report.orderBy(*agg.descending("revenue"), *agg.ascending(key))


def mean_by(
    sales: DataFrame, key: str = "category", measure: str = "sales", out: str = "mean_sales"
) -> DataFrame:
    """Mean of a measure by key."""
    return agg.grouped(sales, [key], {out: F.avg(measure)})


def with_net_revenue(
    orders: DataFrame,
    sales: str = "sales",
    quantity: str = "quantity",
    rate: float = 0.075,
    threshold: float = 50_000,
) -> DataFrame:
    """Adds ``net_revenue`` and the flag ``order_flag`` (high above the threshold, else low)."""
    net = net_of_rate(product(sales, quantity).cast("double"), rate)
    return orders.withColumn("net_revenue", net).withColumn(
        "order_flag", two_way_flag(F.col("net_revenue") > threshold, "high", "low")
    )


def net_revenue_by(
    orders: DataFrame, keys: Sequence[str] = ("region",), scale: int = 3, **columns: Any
) -> DataFrame:
    """Sum of net revenue by key(s), in key order."""
    flagged = with_net_revenue(orders, **columns)
    report = agg.grouped(flagged, keys, {"net_revenue": exact_sum(F.col("net_revenue"), scale)})
    return report.orderBy(*agg.ascending(*keys))


def star_report(
    sales: DataFrame,
    category: DataFrame,
    date: DataFrame,
    store: DataFrame,
    vendor: DataFrame,
    item: DataFrame,
    from_year: int = 2022,
) -> DataFrame:
    """Sales by year, county, store, vendor, category and item from ``from_year`` on, sorted.

    Facts outside the calendar's keys are skipped in the scan (a calendar of at most 10,000 days is
    broadcast, so they don't move to meet it), the others aggregated by their integer keys; names are
    attached to the aggregated rows, so the large shuffle carries numbers only.  As a dimension may
    give one name to several keys, or repeat a key, the sums are added up once more by name, which
    is the same as grouping the joined facts by name.
    """
    dates = date.filter(F.col("CalendarYear") >= from_year).select("DateID", "CalendarYear")
    dates = small_or_lazy(dates)
    ids = ["StoreID", "VendorID", "CategoryID", "ItemID"]
    dims = [
        (store.select("StoreID", "County", "StoreName"), "StoreID"),
        (vendor.select("VendorID", "VendorName"), "VendorID"),
        (category.select("CategoryID", "CategoryName"), "CategoryID"),
        (item.select("ItemID", "ItemName"), "ItemID"),
    ]
    sums = {
        "total_sales": F.sum(scaled(F.col("SaleDollars"), 2)),
        "bottles_sold": F.sum("BottlesSold"),
        "volume_liters": F.sum(scaled(F.col("VolumeSoldLiters"), 4)),
        "_retail": F.sum(scaled(F.col("StateBottleRetail"), 2)),
        "_retails": F.count("StateBottleRetail"),
        "_cost": F.sum(scaled(F.col("StateBottleCost"), 2)),
        "_costs": F.count("StateBottleCost"),
        "transactions": F.count("ID"),
    }
    facts = within_keys(sales, dates, "DateID", "DateID")
    facts = star_join(facts, [(dates, "DateID", "DateID")])
    totals = agg.grouped(facts, ["CalendarYear", *ids], sums)
    named = star_join(totals, [(dim, key, key) for dim, key in dims])
    keys = ["CalendarYear", "County", "StoreName", "VendorName", "CategoryName", "ItemName"]
    named = agg.grouped(named, keys, {c: F.sum(c) for c in sums})
    report = named.select(
        *keys,
        (F.col("total_sales") / 100.0).alias("total_sales"),
        "bottles_sold",
        (F.col("volume_liters") / 10_000.0).alias("volume_liters"),
        F.try_divide(F.col("_retail") / 100.0, F.col("_retails")).alias("avg_retail"),
        F.try_divide(F.col("_cost") / 100.0, F.col("_costs")).alias("avg_cost"),
        "transactions",
    )
    return agg.mixed_sort(
        report, [(k, True) for k in keys] + [("total_sales", False), ("bottles_sold", False)]
    )


def star_summary(
    joined: DataFrame,
    keys: Sequence[str],
    aggregates: dict[str, Column],
    largest_first: Sequence[str],
) -> DataFrame:
    """Aggregates by many keys, sorted by the keys ascending and some measures descending."""
    report = agg.grouped(joined, keys, aggregates)
    return agg.mixed_sort(report, [(k, True) for k in keys] + [(m, False) for m in largest_first])


def top_stores(sales: DataFrame, store: DataFrame, k: int = 5) -> DataFrame:
    """Stores with the highest sales: transactions, dollars, litres."""
    joined = star_join(sales, [(store.select("StoreID", "StoreName", "City"), "StoreID", "StoreID")])
    report = agg.grouped(
        joined,
        ["StoreName", "City"],
        {
            "total_transactions": F.count("ID"),
            "total_sales_dollars": exact_sum(F.col("SaleDollars")),
            "total_liters": exact_sum(F.col("VolumeSoldLiters"), 4),
        },
    )
    return agg.top_k(report, "total_sales_dollars", k, ["StoreName", "City"])


def top_categories(sales: DataFrame, category: DataFrame, k: int = 5) -> DataFrame:
    """Categories with the highest sales, figures rounded to cents."""
    joined = star_join(
        sales, [(category.select("CategoryID", "CategoryName"), "CategoryID", "CategoryID")]
    )
    report = agg.grouped(
        joined,
        ["CategoryName"],
        {
            "tx_count": F.count("ID"),
            "total_sales": F.round(exact_sum(F.col("SaleDollars")), 2),
            "avg_retail_price": F.round(exact_mean(F.col("StateBottleRetail")), 2),
        },
    )
    return agg.top_k(report, "total_sales", k, ["CategoryName"])


# --- traffic --------------------------------------------------------------------------------


def monthly_traffic(traffic: DataFrame) -> DataFrame:
    """Volume in GB by the stored year and month, latest first."""
    report = agg.grouped(
        traffic, ["year", "month"], {"total_gb": F.round(bytes_to_gib(F.sum("byt")), 2)}
    )
    return report.orderBy(*agg.descending("year", "month"))


def top_rejected(
    traffic: DataFrame, actions: Sequence[str] = ("REJECT", "BLOCK", "DROP"), k: int = 10
) -> DataFrame:
    """Source and destination pairs with the largest rejected volume in MB."""
    report = agg.grouped(
        traffic.filter(among("act", actions)),
        ["src", "dst"],
        {"total_mb": F.round(bytes_to_mib(F.sum("byt")), 2)},
    )
    return agg.top_k(report, "total_mb", k, ["src", "dst"])


def executive_dashboard(
    traffic: DataFrame, actions: Sequence[str] = ("REJECT", "BLOCK", "DROP")
) -> dict[str, list[dict[str, Any]]]:
    """Both traffic reports as lists of dicts, ready to be sent as JSON: ten pairs, and a row a month."""
    return {
        "top_rejects": to_rows(top_rejected(traffic, actions)),
        "monthly_traffic": to_rows(monthly_traffic(traffic)),
    }


def traffic_validation(traffic: DataFrame) -> DataFrame:
    """Rows, first and last year, distinct sources and destinations: one row."""
    facts = agg.grouped(
        traffic,
        [],
        {"rows": agg.rows(), "min_year": F.min("year"), "max_year": F.max("year")},
    )
    distinct = {"unique_sources": "src", "unique_destinations": "dst"}
    return facts.withColumns(agg.distinct_counts(traffic, distinct))


def monthly_bytes(traffic: DataFrame) -> DataFrame:
    """Bytes by year and month, in order."""
    report = agg.grouped(traffic, ["year", "month"], {"total_bytes": F.sum("byt")})
    return report.orderBy(*agg.ascending("year", "month"))


# --- census ---------------------------------------------------------------------------------


def census_clean(census: DataFrame) -> DataFrame:
    """``?`` → NULL in every column, incomplete rows dropped, numeric columns cast."""
    return clean_table(census, "?", CENSUS_NUMERIC)


def income_crosstab(
    cleaned: DataFrame, by: str, incomes: Sequence[str] | None = None
) -> DataFrame:
    """Rows per category and income class, one column per class (those in the data by default)."""
    return crosstab(cleaned, by, "income", incomes)


def top_workclasses(cleaned: DataFrame, k: int = 7) -> DataFrame:
    return agg.value_counts(cleaned, "workclass", k)


def top_occupations(cleaned: DataFrame, income: str = ">50K", k: int = 10) -> DataFrame:
    return agg.value_counts(cleaned.filter(F.col("income") == income), "occupation", k)


def workclass_by_income(cleaned: DataFrame, k: int = 7) -> DataFrame:
    """Rows per workclass and income for the ``k`` most frequent workclasses."""
    top = top_workclasses(cleaned, k)
    return agg.histogram(in_top(cleaned, top, "workclass"), ["workclass", "income"])


def income_boxes(cleaned: DataFrame, measure: str) -> DataFrame:
    """Box-plot statistics of a measure (hours, age) by income class."""
    return box_stats(cleaned, ["income"], measure)


def census_report(cleaned: DataFrame, incomes: Sequence[str] = ("<=50K", ">50K")) -> DataFrame:
    """All figures of the census analysis in one long table: ``report, category, income, figure, value``.

    Income counts, cross-tabs of education and sex by income, the seven most frequent workclasses, the ten most
    frequent occupations of the higher income, workclasses by income, and boxes of hours and age.
    """
    columns = ["report", "category", "income", "figure", "value"]

    def long(df: DataFrame, report: str, **named: Column) -> DataFrame:
        wide = df.select(
            F.lit(report).alias("report"),
            *[named.get(c, F.lit(None).cast("string")).alias(c) for c in columns[1:4]],
            named["value"].cast("double").alias("value"),
        )
        return wide.filter(F.col("value").isNotNull())

    n = F.col("count")
    incomes_found = agg.histogram(cleaned, ["income"])
    parts = [long(incomes_found, "incomes", income=F.col("income"), value=n)]
    for by in ("education", "sex"):
        table = income_crosstab(cleaned, by, incomes).unpivot(by, list(incomes), "income", "n")
        parts.append(long(table, f"{by} by income", category=F.col(by), income=F.col("income"), value=F.col("n")))
    top = top_workclasses(cleaned)
    parts.append(long(top, "top workclasses", category=F.col("workclass"), value=n))
    jobs = top_occupations(cleaned, incomes[-1])
    parts.append(long(jobs, "top occupations", category=F.col("occupation"), value=n))
    hue = workclass_by_income(cleaned)
    parts.append(
        long(hue, "workclass by income", category=F.col("workclass"), income=F.col("income"), value=n)
    )
    figures = ["n", "q1", "median", "q3", "whisker_low", "whisker_high", "outliers"]
    for measure in ("hours_per_week", "age"):
        boxes = income_boxes(cleaned, measure)
        boxes = boxes.select("income", *[F.col(c).cast("double").alias(c) for c in figures])
        boxes = boxes.unpivot("income", figures, "figure", "value")
        parts.append(
            long(boxes, f"{measure} box", income=F.col("income"), figure=F.col("figure"), value=F.col("value"))
        )
    return stack(parts)


# --- micro tests ----------------------------------------------------------------------------


def filter_and_score(
    df: DataFrame,
    value: str = "val",
    category: str = "cat",
    above: float = 110,
    categories: Sequence[str] = ("c", "d"),
) -> DataFrame:
    kept = df.filter(all_of(F.col(value) > above, among(category, categories)))
    return kept.withColumn("score", affine_score(F.col(value), 100, 1.2))


def group_statistics(
    df: DataFrame, key: str = "cat", value: str = "val", id: str = "id"
) -> DataFrame:
    """Mean, sample standard deviation, rows and distinct ids by key."""
    return agg.grouped(
        df,
        [key],
        {
            "mean_val": F.avg(value),
            "std_val": agg.sample_std(value),
            "n": agg.rows(),
            "nuniq": agg.distinct_count(id),
        },
    )


def with_weight(df: DataFrame, dim: DataFrame, key: str = "id") -> DataFrame:
    """Left join to a dimension that must be unique by key."""
    return lookup(df, dim, [key])


def rolling_and_rank(
    df: DataFrame, tie_key: str, ts: str = "ts", value: str = "val", id: str = "id"
) -> DataFrame:
    """Two-hour rolling mean over all rows and the ordinal rank of each value within its id."""
    ranked = ordinal_rank(df, [id], value, tie_key, "rank_in_id")
    return rolling_mean(ranked, ts, value, TWO_HOURS, "roll")


def text_flag(df: DataFrame, column: str = "txt", needle: str = "A") -> DataFrame:
    return df.select(contains_flag(F.col(column), needle).alias(column))


def five_minute_means(
    df: DataFrame, ts: str = "ts", value: str = "val", dense: bool = False
) -> DataFrame:
    """Mean per five minutes; ``dense`` adds the empty buckets."""
    means = {value: F.avg(value)}
    if dense:
        return resample(df, ts, FIVE_MINUTES, means, bucket=ts)
    return tumbling(df, ts, FIVE_MINUTES, means, bucket=ts)


def bucket_pivot(
    df: DataFrame, key: str = "cat", id: str = "id", value: str = "val", buckets: int = 8
) -> DataFrame:
    """Mean by key and id bucket, one column per bucket."""
    return pivot_mean(df, key, modulo_bucket(F.col(id), buckets), range(buckets), value)


# --- result tables --------------------------------------------------------------------------


def results_summary(runs: DataFrame, suffix: str = "_AVG") -> DataFrame:
    """Run measurements followed by one row of averages per engine."""
    return append_summary(
        runs,
        "engine",
        {
            "time": F.round(F.avg("time"), 2),
            "peak_ram_gb": F.round(F.avg("peak_ram_gb"), 2),
            "peak_cpu_pct": F.round(F.avg("peak_cpu_pct"), 0),
            "rows": F.floor(F.avg("rows")),
        },
        suffix,
    )
