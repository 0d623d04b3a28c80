"""NULLs, ties, empty input and failures on hand-made frames."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from shared import plan_text, rows_of
from sumstone.functions.exact import exact_mean, exact_sum
from sumstone.operators import aggregate as agg
from sumstone.operators import checks, clean, filters, joins, setops
from sumstone.operators.pivot import crosstab
from sumstone.operators.quantiles import box_stats, quantiles_by
from sumstone.plans import reports
from sumstone.sources import writers


@pytest.fixture
def sample(spark):
    rows = [("a", 1, 1.5), ("a", None, 2.25), ("a", 1, None), (None, 2, 4.0), ("b", None, None)]
    return spark.createDataFrame(rows, "k string, u int, v double")


def test_null_is_a_group_unless_dropped(sample):
    kept = agg.grouped(sample, ["k"], {"n": agg.rows()})
    assert rows_of(kept) == rows_of(sample.sparkSession.createDataFrame(
        [("a", 3), ("b", 1), (None, 1)], "k string, n long"))
    dropped = agg.grouped(sample, ["k"], {"n": agg.rows()}, drop_null_keys=True)
    assert sorted(r.k for r in dropped.collect()) == ["a", "b"]


def test_counts_and_distinct_counts(sample):
    out = agg.grouped(
        sample,
        ["k"],
        {
            "n": F.count("u"),
            "d": agg.distinct_count("u"),
            "dn": agg.distinct_count("u", null_as_value=True),
        },
    )
    found = {r.k: (r.n, r.d, r.dn) for r in out.collect()}
    assert found == {"a": (2, 1, 2), None: (1, 1, 1), "b": (0, 0, 1)}


def test_sum_mean_std_of_nothing_is_null(sample):
    out = agg.grouped(
        sample,
        ["k"],
        {
            "s": exact_sum(F.col("v")),
            "narrow": exact_sum(F.col("v"), wide=False),
            "m": exact_mean(F.col("v")),
            "std": agg.sample_std("v"),
        },
    )
    found = {r.k: (r.s, r.narrow, r.m) for r in out.collect()}
    assert found == {"a": (3.75, 3.75, 1.875), None: (4.0, 4.0, 4.0), "b": (None, None, None)}
    assert {r.k: r.std for r in out.collect()}[None] is None


def test_exact_sum_of_large_negative_and_many_values(spark):
    df = spark.range(100_000).select(
        ((F.col("id") * 982_451_653) % 10**11 - 5 * 10**10).alias("cents")
    )
    wanted = df.agg(F.sum("cents")).first()[0]
    found = df.agg(exact_sum(F.col("cents") / 100)).first()[0]
    assert found == wanted / 100
    assert df.repartition(7).agg(exact_sum(F.col("cents") / 100)).first()[0] == found


def test_top_k_breaks_ties_by_key_and_ignores_null(spark):
    df = spark.createDataFrame([("c",), ("b",), ("a",), ("a",), (None,), (None,), (None,)], "x string")
    assert [tuple(r) for r in agg.value_counts(df, "x", 2).collect()] == [("a", 2), ("b", 1)]
    assert len(agg.value_counts(df, "x").collect()) == 3
    assert agg.distinct_values(df, "x").count() == 4


def test_nulls_sort_last_both_ways(spark):
    df = spark.createDataFrame([(1, 1.0), (None, 2.0), (1, None), (2, 3.0)], "a int, b double")
    found = [tuple(r) for r in agg.mixed_sort(df, [("a", True), ("b", False)]).collect()]
    assert found == [(1, 1.0), (1, None), (2, 3.0), (None, 2.0)]


def test_crosstab_missing_is_null_or_filled(spark):
    df = spark.createDataFrame([("x", "p"), ("x", "p"), ("y", "q"), ("y", "z")], "a string, b string")
    rows = crosstab(df, "a", "b", ["p", "q"], rest="others").collect()
    assert {r.a: (r.p, r.q, r.others) for r in rows} == {"x": (2, None, None), "y": (None, 1, 1)}
    filled = {r.a: (r.p, r.q) for r in crosstab(df, "a", "b", ["p", "q"], 0, "others").collect()}
    assert filled == {"x": (2, 0), "y": (0, 1)}
    assert crosstab(df, "a", "b").columns == ["a", "p", "q", "z"]
    with pytest.raises(Exception, match="category not listed: z"):
        crosstab(df, "a", "b", ["p", "q"]).collect()
    numbers = df.selectExpr("a", "if(b = 'z', NULL, ascii(b)) AS n")
    assert crosstab(numbers, "a", "n", [112, 113]).columns == ["a", "112", "113"]
    assert crosstab(numbers, "a", "n").columns == ["a", "112", "113"]


def test_crosstab_keeps_the_category_named_null(spark):
    rows = [("x", "null"), ("x", "null"), ("x", None), ("y", None), ("y", "{b}"), ("z", None)]
    out = crosstab(spark.createDataFrame(rows, "a string, b string"), "a", "b")
    assert out.columns == ["a", "null", "{b}"]
    assert {tuple(r) for r in out.collect()} == {("x", 2, None), ("y", None, 1), ("z", None, None)}
    numbers = spark.createDataFrame([("x", 9), ("x", 10), ("x", None)], "a string, n int")
    assert crosstab(numbers, "a", "n").columns == ["a", "9", "10"]
    assert crosstab(numbers.filter("n IS NULL"), "a", "n").columns == ["a"]


def test_sums_lose_no_digit(spark):
    small = spark.range(1000).select(F.lit(0.004).alias("v"))
    assert small.agg(exact_sum(F.col("v"))).first()[0] == pytest.approx(4.0, rel=1e-12)
    odd = spark.createDataFrame([(1e13,), (0.25,), (float("nan"),)], "v double")
    assert odd.filter("v > 1 AND NOT isnan(v)").agg(exact_sum(F.col("v"), 6)).first()[0] == 1e13
    assert str(odd.agg(exact_sum(F.col("v"))).first()[0]) == "nan"
    endless = spark.createDataFrame([(float("inf"),), (1.0,)], "v double")
    assert endless.agg(exact_sum(F.col("v"), wide=False)).first()[0] == float("inf")


def test_cleaning_dotted_names_markers_and_bad_numbers(spark):
    df = spark.createDataFrame(
        [("1", "x"), ("?", "y"), ("2", "?"), ("no", "z")], "`hours.per.week` string, job string"
    )
    cleaned = clean.clean_table(df, "?", ["hours_per_week"])
    assert rows_of(cleaned) == [(1, "x"), (None, "z")]
    assert clean.rows_before_after(df).first().asDict() == {"rows_before": 4, "rows_after": 2}
    with pytest.raises(ValueError):
        clean.plain_names(spark.createDataFrame([(1, 2)], "`a.b` int, a_b int"))


def test_without_marker_drops_null_as_sql_does(spark):
    df = spark.createDataFrame([("a",), ("?",), (None,)], "x string")
    assert rows_of(clean.without_marker(df, ["x"])) == [("a",)]


def test_lookup_keeps_left_rows_and_refuses_duplicates(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, x string")
    right = spark.createDataFrame([(1, 1.0), (3, 3.0), (None, 9.0)], "id bigint, w double")
    assert rows_of(joins.lookup(left, right, ["id"]).select("x", "w")) == [
        ("a", 1.0), ("b", None), ("c", None)]
    twice = right.unionByName(right)
    with pytest.raises(joins.DuplicateKeyError):
        joins.lookup(left, twice, ["id"])


def test_hot_key_lookup_equals_lookup(spark):
    left = spark.range(5_000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None)
        .otherwise(F.col("id")).alias("k"),
        F.col("id").alias("n"),
    )
    right = spark.range(0, 4_000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    right = right.unionByName(spark.createDataFrame([(7, 70)], "k long, w long"))
    plain = joins.lookup(left, right, ["k"]).select("k", "n", "w")
    split = joins.hot_key_lookup(left, right, ["k"]).select("k", "n", "w")
    assert setops.frames_equal(plain, split)


def test_hot_key_lookup_moves_no_row_to_few_labels(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = spark.range(1_000).select((F.col("id") % 2).alias("k"), F.col("id").alias("n"))
    right = spark.createDataFrame([(0, "a"), (2, "c")], "k long, w string").distinct()
    found = joins.hot_key_lookup(left, right, ["k"])
    assert "Exchange hashpartitioning" not in plan_text(found)
    assert found.filter("w = 'a'").count() == 500 and found.count() == 1_000


def test_in_top_and_orphans(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "k string, n int")
    top = agg.value_counts(df, "k", 1)
    assert rows_of(joins.in_top(df, top, "k").select("k", "n")) == [("a", 1), ("a", 2)]
    dim = spark.createDataFrame([("a",), ("b",)], "key string")
    assert rows_of(joins.orphans(df, dim, "k", "key")) == [("c", 4)]


def test_union_and_summary(spark):
    runs = spark.createDataFrame(
        [("x", 1.004, 2.0, 50.0, 10), ("x", 2.0, 4.0, 70.0, 11)],
        "engine string, time double, peak_ram_gb double, peak_cpu_pct double, rows long",
    )
    found = reports.results_summary(runs).filter("engine = 'x_AVG'").first()
    assert tuple(found) == ("x_AVG", 1.5, 3.0, 60.0, 10)
    stats = agg.run_statistics(runs, "engine", "time").first()
    assert (stats.best, stats.runs, round(stats.median, 3)) == (1.004, 2, 1.502)


def test_differences_count_copies_and_round(spark):
    a = spark.createDataFrame([(1, 0.1), (1, 0.1), (2, None)], "i int, x double")
    b = spark.createDataFrame([(1, 0.1000001), (2, None)], "i int, x double")
    assert not setops.frames_equal(a, b)
    assert rows_of(setops.differences(a, b, digits=3)) == [(1, 0.1, 1)]
    assert setops.difference_count(a, a).first()[0] == 0
    with pytest.raises(ValueError):
        setops.differences(a, b.withColumnRenamed("x", "y"))


def test_ratio_to_baseline(spark):
    df = spark.createDataFrame([("base", 8.0), ("fast", 2.0), ("zero", 0.0)], "e string, t double")
    found = {r.e: r.ratio for r in agg.ratio_to_baseline(df, "e", "base", "t", "ratio").collect()}
    assert found == {"base": 1.0, "fast": 4.0, "zero": None}


def test_quantiles_of_one_row_and_of_nulls(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", None), (None, 1.0), (None, 2.0)], "k string, v double")
    for accuracy in (10_000, 10):
        found = quantiles_by(df, ["k"], "v", {"m": 0.5}, accuracy=accuracy)
        assert {r.k: r.m for r in found.collect()} == {"a": 5.0, "b": None, None: 1.5}


def test_box_of_values_with_an_outlier(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 5, 100]], "k string, v double")
    box = box_stats(df, ["k"], "v").first()
    assert (box.q1, box.median, box.q3) == (2.25, 3.5, 4.75)
    assert (box.whisker_low, box.whisker_high, box.outliers, box.n) == (1.0, 5.0, 1, 6)


def test_filter_helpers(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "it's", 1.0), (dt.date(2023, 12, 31), "b", 2.0)],
        "d date, s string, x double",
    )
    assert df.filter(filters.on_or_after(df, "d", "2024-01-01")).count() == 1
    assert df.filter(filters.from_year(df, "d", 2024)).count() == 1
    kept = filters.keep(df, "s = {s} AND d >= {d} AND x < {x}",
                        {"s": "it's", "d": dt.date(2024, 1, 1), "x": 1.5})
    assert kept.count() == 1


def test_reports_on_empty_input(spark):
    empty = spark.createDataFrame([], "event_date date, country string, channel string, "
                                      "user_id long, order_id long, revenue double")
    assert reports.top_channels(empty, "2024-01-01", ["US"]).collect() == []
    assert exact_sum(F.col("revenue")) is not None
    assert empty.agg(exact_sum(F.col("revenue"))).first()[0] is None


def test_row_count_checks(spark):
    df = spark.range(3)
    assert checks.require_rows(df, 3) is df
    with pytest.raises(checks.RowCountError):
        checks.require_rows(df, 4)


def test_results_for_the_client(spark):
    df = spark.range(5)
    assert writers.to_rows(df)[0] == {"id": 0}
    assert writers.to_pandas(df).shape == (5, 1)
    assert writers.to_arrow(df).num_rows == 5
    assert sum(r.id for r in writers.iterate(df)) == 10



def test_micro_reports(spark):
    ts = dt.datetime(2024, 1, 1)
    rows = [(i, "abcdef"[i % 6], 100.0 + i, ts + dt.timedelta(minutes=i), "alpha") for i in range(40)]
    df = spark.createDataFrame(rows, "id int, cat string, val float, ts timestamp_ntz, txt string")
    scored = reports.filter_and_score(df)
    assert {r.cat for r in scored.collect()} == {"c", "d"}
    assert all(math.isclose(r.score, (r.val - 100) * 1.2) for r in scored.collect())
    assert reports.group_statistics(df).count() == 6
    assert reports.text_flag(df).first().txt == 1
    assert reports.five_minute_means(df).count() == 8
    assert reports.bucket_pivot(df).columns == ["cat", *map(str, range(8))]
    both = reports.rolling_and_rank(df, "ts")
    assert {"roll", "rank_in_id"} <= set(both.columns)


def test_distinct_ids_by_bitmap(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", 40_000), ("a", -5), ("a", None), (None, 32_768), ("b", None)],
        "k string, u long",
    )
    exact = agg.grouped(df, ["k"], {"users": agg.distinct_count("u"), "n": F.count("u")})
    dense = agg.grouped_with_dense_ids(df, ["k"], "u", "users", {"n": F.count("u")})
    assert rows_of(dense) == rows_of(exact)
    assert agg.grouped_with_dense_ids(df.limit(0), [], "u", "users", {}).first().users == 0
