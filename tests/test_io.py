"""CSV, Parquet and Arrow files in awkward shapes."""

from __future__ import annotations

import datetime as dt
import glob
import os

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shared import SF_DIR, plan_text, rows_of
from sumstone import scratch_path
from sumstone.operators import checks
from sumstone.plans.catalog import QUERIES
from sumstone.plans.registry import table
from sumstone.sources import arrow_ipc, readers, writers


def test_csv_quotes_blanks_and_bad_numbers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,day\n1,"x, y",2024-01-02\n2,,2024-02-03\nno,z,\n')
    found = readers.read_csv(
        spark, str(tmp_path / "a.csv"), schema="id string, name string, day date"
    )
    found = found.withColumn("id", F.col("id").try_cast("bigint"))
    assert rows_of(found) == sorted(
        [(1, "x, y", dt.date(2024, 1, 2)), (2, None, dt.date(2024, 2, 3)), (None, "z", None)],
        key=repr,
    )
    inferred = readers.read_csv(spark, str(tmp_path / "a.csv"))
    assert dict(inferred.dtypes)["day"] == "date"
    assert all(t == "string" for _, t in readers.read_csv(spark, str(tmp_path), all_text=True).dtypes)


def test_csv_marker_reads_as_null_and_number(spark, tmp_path):
    (tmp_path / "c.csv").write_text("age,job\n39,a\n?,b\n41,?\n")
    found = readers.read_csv(spark, str(tmp_path / "c.csv"), null_marker="?")
    assert dict(found.dtypes)["age"] == "int"
    assert rows_of(found.na.drop("any")) == [(39, "a")]


def test_csv_view_by_name(spark, tmp_path):
    (tmp_path / "v.csv").write_text("a,b\n1,x\n2,y\n")
    readers.csv_view(spark, "some_csv", str(tmp_path / "v.csv"))
    assert spark.sql("SELECT sum(a) FROM some_csv").first()[0] == 3


def test_csv_append_and_refusal_to_overwrite(spark):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    writers.write_csv(df, path)
    writers.write_csv(df, path, append=True)
    assert readers.read_csv(spark, path).count() == 2
    with pytest.raises(Exception, match="(?i)exists"):
        writers.write_csv(df, path)


def test_parquet_options_take_effect(spark):
    lines = table(spark, SF_DIR, "lineitem")
    sizes = {}
    for codec, level in (("none", None), ("zstd", 1), ("zstd", 19)):
        path = scratch_path(spark, "parquet")
        writers.write_parquet(lines, path, codec, level)
        sizes[codec, level] = writers.folder_bytes(spark, path).first()["bytes"]
        assert readers.read_parquet(spark, path, columns=["l_tax"]).columns == ["l_tax"]
    assert sizes["zstd", 19] < sizes["zstd", 1] < sizes["none", None]
    path = scratch_path(spark, "parquet")
    writers.write_parquet(lines, path, max_rows_per_file=1_000, partition_by=["l_returnflag"])
    footers = checks.parquet_footers(spark, f"{path}/*").collect()
    assert max(r.rows for r in footers) <= 1_000
    assert sum(r.rows for r in footers) == lines.count()
    assert rows_of(spark.read.parquet(path).select("l_returnflag").distinct()) == rows_of(
        lines.select("l_returnflag").distinct()
    )


def test_unsigned_and_32_bit_columns_widen(spark, tmp_path):
    data = pa.table(
        {
            "u8": pa.array([255], pa.uint8()),
            "u16": pa.array([65_535], pa.uint16()),
            "u32": pa.array([4_294_967_295], pa.uint32()),
            "f": pa.array([1.5], pa.float32()),
            "t": pa.array([dt.datetime(2024, 1, 1)], pa.timestamp("us")),
        }
    )
    pq.write_table(data, tmp_path / "u.parquet")
    found = readers.read_parquet(spark, str(tmp_path / "u.parquet"))
    assert [t for _, t in found.dtypes] == ["smallint", "int", "bigint", "float", "timestamp_ntz"]
    assert found.first()[:3] == (255, 65_535, 4_294_967_295)


def test_nanosecond_parquet(spark, conf, tmp_path):
    data = pa.table(
        {
            "id": pa.array([1, 2], pa.int64()),
            "Inserted": pa.array([1_700_000_000_123_456_789, None], pa.timestamp("ns")),
        }
    )
    path = str(tmp_path / "n.parquet")
    pq.write_table(data, path)
    assert rows_of(readers.read_parquet(spark, path, schema="id bigint")) == [(1,), (2,)]
    conf("spark.sql.legacy.parquet.nanosAsLong", "true")
    found = readers.read_parquet_nanos(spark, path, "id bigint, Inserted bigint", ["Inserted"])
    assert dict(found.dtypes)["Inserted"] == "timestamp_ntz"
    values = {r.id: r.Inserted for r in found.collect()}
    assert values == {1: dt.datetime(2023, 11, 14, 22, 13, 20, 123_456), 2: None}


def test_arrow_files_in_many_batches(spark, tmp_path):
    schema = pa.schema(
        [("n", pa.int64()), ("s", pa.string()), ("t", pa.timestamp("ns")), ("x", pa.float32())]
    )
    for part in range(2):
        with pa.ipc.new_file(tmp_path / f"part{part}.arrow", schema) as sink:
            for i in range(25):
                base = part * 1_000 + i * 10
                rows = list(range(base, base + 10))
                sink.write_batch(
                    pa.record_batch(
                        [
                            pa.array(rows, pa.int64()),
                            pa.array([f"s{r}" if r % 7 else None for r in rows]),
                            pa.array([r * 1_000_000_000 for r in rows], pa.timestamp("ns")),
                            pa.array([r / 2 for r in rows], pa.float32()),
                        ],
                        schema=schema,
                    )
                )
    found = arrow_ipc.read_arrow_ipc(spark, str(tmp_path), batches_per_task=4)
    assert dict(found.dtypes) == {"n": "bigint", "s": "string", "t": "timestamp_ntz", "x": "float"}
    assert found.count() == 500
    assert found.agg(F.sum("n"), F.count("s"), F.max("x")).first()[0] == sum(
        p * 1_000 + i for p in range(2) for i in range(250)
    )
    some = arrow_ipc.read_arrow_ipc(spark, str(tmp_path / "part1.arrow"), columns=["x", "n"])
    assert some.columns == ["x", "n"]
    assert some.agg(F.min("n")).first()[0] == 1_000


def test_arrow_write_leaves_whole_files_only(spark, tmp_path):
    df = spark.range(0, 1_000, 1, 4).select("id", F.col("id").cast("string").alias("s"))
    target = tmp_path / "out"
    manifest = arrow_ipc.write_arrow_ipc(df, str(target), rows_per_batch=100)
    assert manifest.agg(F.sum("rows")).first()[0] == 1_000
    files = sorted(p.name for p in target.iterdir() if not p.name.startswith("_"))
    assert files == [f"part-{i:05d}.arrow" for i in range(4)]
    assert pa.ipc.open_file(target / files[0]).num_record_batches >= 3
    with pytest.raises(FileExistsError):
        arrow_ipc.write_arrow_ipc(df.limit(10), str(target))
    assert arrow_ipc.read_arrow_ipc(spark, str(target)).distinct().count() == 1_000


def test_schema_and_profiles(spark):
    events = table(spark, SF_DIR, "events")
    assert [tuple(r) for r in readers.schema_table(events).collect()][1] == (1, "ts", "timestamp_ntz")
    profile = {r.column_name: r for r in checks.column_profile(events).collect()}
    assert profile["value"].data_type == "double"
    assert profile["value"].rows == profile["value"].non_null == events.count()
    described = spark.sql("DESCRIBE QUERY SELECT * FROM {e}", e=events)
    assert described.count() == len(events.columns)


def test_dataset_summary_keeps_files_of_equal_name_apart(spark):
    root = scratch_path(spark, "parquet")
    for name, n in (("a", 3), ("b", 5)):
        spark.range(n).coalesce(1).write.parquet(f"{root}/{name}")
    summary = checks.dataset_summary(spark.read.parquet(f"{root}/a", f"{root}/b"))
    assert sorted(r.rows for r in summary.collect()) == [3, 5]


def test_dataset_summary_has_files_without_rows(spark):
    root = scratch_path(spark, "a b[1]")
    # The first task of a write leaves a file, with a header only, if it has no rows.
    writers.write_csv(spark.range(0, 8, 1, 4).filter("id > 1"), root)
    summary = checks.dataset_summary(readers.read_csv(spark, root.replace("[1]", "?1?"), schema="id bigint"))
    sizes = [os.path.getsize(p) for p in glob.glob(f"{glob.escape(root.removeprefix('file:'))}/part-*")]
    assert sorted(r.rows for r in summary.collect()) == [0, 2, 2, 2]
    assert sum(r.bytes for r in summary.collect()) == sum(sizes)


def test_sizes_of_a_conversion_are_known_with_an_empty_first_task(spark, conf, tmp_path):
    # One row group across several pieces of the file: the first pieces hold no row.
    table(spark, SF_DIR, "lineitem").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    conf("spark.sql.files.maxPartitionBytes", "64k")
    conf("spark.sql.files.openCostInBytes", "0")
    assert QUERIES["csv_to_parquet"](spark, str(tmp_path)).first().sizes_known


def test_local_columns_and_bound_frames(spark):
    df = readers.from_columns(spark, {"a": [1, 2], "b": ["x", None]}, "a int, b string")
    assert readers.query(spark, "SELECT count(b) AS n FROM {t}", t=df).first().n == 1
    readers.register(df, "local_rows")
    assert spark.table("local_rows").count() == 2
    with pytest.raises(ValueError):
        readers.from_columns(spark, {"a": [1], "b": []}, "a int, b int")


ODD_TEXTS = [
    (1, 'say "hi", ok'), (2, "two\nlines"), (3, "a\\b"), (4, ""), (5, None), (6, ' blank '), (7, '"'), (8, ",,"),
]


def test_csv_of_quotes_and_line_breaks_is_read_by_others_too(spark, tmp_path):
    df = spark.createDataFrame(ODD_TEXTS, "a int, t string").coalesce(1)
    writers.write_csv(df, str(tmp_path / "odd"))
    back = readers.read_csv(spark, str(tmp_path / "odd"), schema="a int, t string", multi_line=True)
    assert rows_of(back) == rows_of(df.replace({"": None}, subset=["t"]))
    rows = duckdb.sql(f"SELECT * FROM read_csv('{tmp_path}/odd/*.csv', header = true)").fetchall()
    assert sorted(rows, key=lambda r: r[0]) == [(a, t or None) for a, t in ODD_TEXTS]


def test_csv_columns_go_by_name_and_bad_rows_stop_the_job(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a,c\n1,10,z\n")
    schema = "a int, b int"
    assert rows_of(readers.read_csv(spark, str(tmp_path / "x.csv"), schema=schema)) == [(10, 1)]
    with pytest.raises(ValueError, match="not in the header"):
        readers.read_csv(spark, str(tmp_path / "x.csv"), schema="a int, d int")
    for bad in ("a,b\n1,xx\n", "a,b\n1\n"):
        (tmp_path / "bad.csv").write_text(bad)
        with pytest.raises(Exception, match="MALFORMED|malformed"):
            readers.read_csv(spark, str(tmp_path / "bad.csv"), schema=schema).collect()
        kept = readers.read_csv(spark, str(tmp_path / "bad.csv"), schema=schema, mode="PERMISSIVE")
        assert rows_of(kept) == [(1, None)]


def test_files_are_packed_without_a_shuffle(spark):
    root = scratch_path(spark, "many")
    lines = table(spark, SF_DIR, "lineitem")
    for i, share in enumerate([0.5, 0.2, 0.1, 0.05, 0.05, 0.02, 0.02, 0.02, 0.02, 0.02]):
        lines.sample(share, i).coalesce(1).write.option("header", True).csv(f"{root}/batch_{i}")
    source = f"{root}/batch_*"
    packed = writers.packed_csv(spark, source, 3)
    assert "Exchange" not in plan_text(packed)
    writers.compact_csv(spark, source, f"{root}/out", 3)
    sizes = [os.path.getsize(p) for p in glob.glob(f"{root.removeprefix('file:')}/out/*.csv")]
    assert len(sizes) == 3 and max(sizes) <= 2 * min(sizes)
    back = readers.read_csv(spark, f"{root}/out", all_text=True)
    assert rows_of(back) == rows_of(readers.read_csv(spark, source, all_text=True))


def test_compacted_files_are_bounded(spark):
    root = scratch_path(spark, "large")
    rows = spark.range(20_000)
    writers.write_csv(rows, f"{root}/in", files=5)
    writers.compact_csv(spark, f"{root}/in", f"{root}/out", 2, schema="id bigint", most_bytes=20_000)
    sizes = [os.path.getsize(p) for p in glob.glob(f"{root.removeprefix('file:')}/out/*.csv")]
    assert len(sizes) > 4 and max(sizes) <= 2 * 20_000
    assert rows_of(readers.read_csv(spark, f"{root}/out", schema="id bigint")) == rows_of(rows)


def test_local_columns_meet_a_table_without_a_shuffle(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    labels = readers.from_columns(spark, {"a": [1, 2], "b": ["x", None]}, "a int, b string")
    assert "Exchange hashpartitioning" not in plan_text(spark.range(9).join(labels, F.col("id") == F.col("a")))


def test_conversion_report_has_the_sizes_of_the_files(spark):
    root = scratch_path(spark, "convert")
    writers.write_csv(table(spark, SF_DIR, "orders"), f"{root}/csv")
    report = writers.csv_to_parquet(spark, f"{root}/csv", f"{root}/parquet").first()
    sizes = [
        sum(os.path.getsize(p) for p in glob.glob(f"{root.removeprefix('file:')}/{kind}/part-*"))
        for kind in ("csv", "parquet")
    ]
    assert [report.csv_bytes, report.parquet_bytes] == sizes and report.ratio == sizes[0] / sizes[1]
    assert report.rows == table(spark, SF_DIR, "orders").count()


def test_footer_facts_equal_the_files(spark):
    root = scratch_path(spark, "facts").removeprefix("file:")
    os.makedirs(root)
    first = pa.table({"n": pa.array([3, None, 1], pa.int64()), "t": ["b", "a", None], "x": [0.5, 2.5, None],
                      "d": [dt.date(1970, 1, 3), None, dt.date(1969, 12, 31)], "none": pa.array([None] * 3, pa.int32())})
    second = pa.table({"n": pa.array([9] * 4, pa.int64()), "t": ["z"] * 4, "x": [-1.0] * 4,
                       "d": [dt.date(1971, 1, 1)] * 4, "none": pa.array([7] * 4, pa.int32())})
    pq.write_table(first, f"{root}/one.parquet", row_group_size=2)
    pq.write_table(second, f"{root}/two.parquet", write_statistics=["n", "t", "d", "none"])
    summary = {r.file: r for r in checks.parquet_summary(spark, root).collect()}
    for name, rows in (("one.parquet", 3), ("two.parquet", 4)):
        size = os.path.getsize(f"{root}/{name}")
        assert (summary[name].rows, summary[name]["columns"]) == (rows, 5)
        assert summary[name].size_mb == round(size / 2**20, 2)
    groups = {r.file: (r.row_groups, r.bytes) for r in checks.parquet_footers(spark, root).collect()}
    assert groups["one.parquet"] == (2, os.path.getsize(f"{root}/one.parquet"))
    facts = {r.column_name: r for r in checks.parquet_columns(spark, root).collect()}
    assert (facts["n"].rows, facts["n"].nulls, facts["n"].least, facts["n"].most) == (7, 1, 1.0, 9.0)
    assert (facts["t"].first_text, facts["t"].last_text, facts["t"].least) == ("a", "z", None)
    assert (facts["d"].least, facts["d"].most, facts["d"].data_type) == (-86400.0, 365 * 86400.0, "date32[day]")
    assert (facts["x"].nulls, facts["x"].least) == (None, None)  # one file keeps no statistics of it
    assert (facts["none"].nulls, facts["none"].least, facts["none"].most) == (3, 7.0, 7.0)


def test_a_batch_of_results_is_added_once(spark):
    folder = scratch_path(spark, "results")
    rows = spark.createDataFrame([("a", 1.5), ('quoted "b"', None)], "engine string, time double").repartition(2)
    assert writers.append_once(rows, folder, "2024-01-01")
    assert writers.append_once(rows, folder, "2024-01-02")
    assert not writers.append_once(rows, folder, "2024-01-01")
    back = writers.read_results(spark, folder, "engine string, time double")
    assert rows_of(back) == sorted(2 * [tuple(r) for r in rows.collect()], key=repr)
    left = [p for p in os.listdir(folder.removeprefix("file:")) if not p.startswith(".")]
    assert sorted(left) == ["batch=2024-01-01", "batch=2024-01-02"]
