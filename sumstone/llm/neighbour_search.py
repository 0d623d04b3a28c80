"""Approximate nearest neighbours by multiprobe hashing with p-stable projections."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sumstone.llm.common import freeze

#: Hash tables, projections in each, width of a cell, and buckets that a query visits in each.
TABLES = 4
PROJECTIONS = 12
WIDTH = 3.0
PROBES = 240
#: Indexed vectors, and queries, that one group compares.
BLOCK = 8192
QUERIES = 4096
#: Most vectors in the sample that bounds a query's last place from below, and their share of all.
SAMPLE = 16_384
SHARE = 8

_CELLS = 16  # a cell number has four bits


def usable(vector: Column, dim: int | Column) -> Column:
    """True for a vector of ``dim`` finite components, not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce((F.size(vector) == dim) & finite & some, F.lit(False))


def distinct_vectors(df: DataFrame, key: str, vector: str, keep: int) -> DataFrame:
    """``vid, vector, ids, first``: each vector once, with its ``keep`` smallest keys in order.

    More keys of one vector can never be among a query's nearest, so none is lost; ranks are
    limited before rows move, so a vector with very many keys is not gathered.
    """
    once = df.select(key, vector).distinct()
    rank = F.row_number().over(Window.partitionBy(vector).orderBy(key))
    few = once.withColumn("_rank", rank).filter(F.col("_rank") <= keep)
    ids = F.sort_array(F.collect_list(key)).alias("ids")
    first = F.min(key).alias("first")
    grouped = few.groupBy(F.col(vector).alias("vector")).agg(ids, first)
    return freeze(grouped.withColumn("vid", F.monotonically_increasing_id()), "vectors")


def projections(dim: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Normal directions and offsets of all tables."""
    draw = np.random.default_rng(seed)
    return (
        draw.standard_normal((TABLES, PROJECTIONS, dim + 1)),
        draw.random((TABLES, PROJECTIONS)) * WIDTH,
    )


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Indexed vectors on a unit sphere with one dimension more.

    There the nearest to a query by distance, the query scaled to length 1 and given a 0, is the one
    with the largest inner product.
    """
    x = x / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))
    return np.concatenate([x, rest[:, None]], axis=1)


def cells(x: np.ndarray, directions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where lifted vectors fall in one table, in units of a cell, cell 8 in the middle."""
    return (x @ directions.T + offsets) / WIDTH + _CELLS // 2


def codes(place: np.ndarray) -> np.ndarray:
    """Bucket of each place: its cell numbers side by side."""
    cell = np.clip(np.floor(place), 0, _CELLS - 1).astype(np.int64)
    out = np.zeros(len(cell), np.int64)
    for k in range(PROJECTIONS):
        out = out << 4 | cell[:, k]
    return out


def probes(place: np.ndarray, bucket: np.ndarray, count: int) -> np.ndarray:
    """Buckets that each query visits: positions in ``bucket``, likeliest first.

    A bucket is reached from the query's own by moving some projections across cell borders.  The
    chance that a near vector has moved so falls with the sum of the squared distances to those
    borders, so occupied buckets are visited in ascending order of that sum.
    """
    moved = np.zeros((len(place), len(bucket)), np.float32)
    for k in range(PROJECTIONS):
        cell = (bucket >> 4 * (PROJECTIONS - 1 - k)) & (_CELLS - 1)
        gap = np.zeros((len(place), _CELLS), np.float32)
        for c in range(_CELLS):
            below = c - place[:, k] if c else -np.inf
            above = place[:, k] - (c + 1) if c < _CELLS - 1 else -np.inf
            gap[:, c] = np.maximum(0, np.maximum(below, above)) ** 2
        moved += gap[:, cell]
    if count < len(bucket):
        return np.argpartition(moved, count, axis=1)[:, :count]
    return np.tile(np.arange(len(bucket)), (len(place), 1))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _index_rows(vectors: DataFrame, dim: int, longest: float) -> DataFrame:
    """``table, code, vid, first, vector``: each vector in its bucket of each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions, offsets = projections(dim)
        for batch in batches:
            x = lifted(_matrix(batch.column("vector"), dim), longest)
            for t in range(TABLES):
                code = codes(cells(x, directions[t], offsets[t]))
                columns = [pa.array(np.full(len(x), t, np.int32)), pa.array(code)]
                columns += [batch.column(c) for c in ("vid", "first", "vector")]
                yield pa.RecordBatch.from_arrays(columns, ["table", "code", "vid", "first", "vector"])

    return vectors.select("vid", "first", "vector").mapInArrow(
        run, f"table int, code long, {_kinds(vectors, 'vid', 'first', 'vector')}"
    )


def _kinds(df: DataFrame, *names: str) -> str:
    return ", ".join(f"{n} {df.schema[n].dataType.simpleString()}" for n in names)


def search(
    df: DataFrame, key: str, vector: str, is_query: Column, nearest: int = 20
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest other rows of each query row found.

    Nearness is the largest inner product, in double precision; ties go to the smaller key.  Null
    keys and vectors, zero vectors and those with null or non-finite components take no part, nor
    do those of another length than most rows have; repeated rows count once.

    Every vector is put into a bucket of each table.  The directory of occupied buckets, as long as
    projections can tell cells apart, goes to all tasks; it cuts each table into blocks of about
    ``BLOCK`` vectors, and a bucket larger than a block lies in several, so no bucket is too large.
    Queries visit their likeliest buckets; within a block they are compared with the vectors of
    those buckets, and what reaches a bound on the query's last place, taken from a sample of the
    vectors, is kept, ranked over all tables.  The bound never removes a row that belongs among the
    nearest found.  Equal vectors are searched once.
    """
    spark = df.sparkSession
    df = df.filter(F.col(key).isNotNull())
    lengths = df.groupBy(F.size(vector).alias("n")).count().filter("n > 0")
    common = lengths.orderBy(F.desc("count"), "n").first()
    dim = int(common["n"]) if common else 1
    kept = nearest + 1
    rows = df.select(key, F.col(vector).alias("vector"), is_query.alias("_query"))
    rows = rows.filter(usable(F.col("vector"), dim))
    vectors = distinct_vectors(rows, key, "vector", kept)
    asked = rows.filter("_query").select(F.col(key).alias("query_id"), "vector").distinct()
    asked = freeze(asked.join(vectors.select("vector", "vid"), "vector").select("query_id", "vid"), "asked")

    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") ** 2))
    total, longest = vectors.agg(F.count("vid"), F.max(norm)).first()
    longest = (longest or 1.0) * (1 + 1e-12)
    index = freeze(_index_rows(vectors, dim, longest), "index")
    counts = index.groupBy("table", "code").count().toArrow().sort_by([("table", "ascending"), ("code", "ascending")])
    directory = []
    for t in range(TABLES):
        own = counts.filter(pc.equal(counts.column("table"), t))
        size = own.column("count").to_numpy()
        directory.append((own.column("code").to_numpy(), np.cumsum(size) - size, size))
    wanted = min(SAMPLE, max(1, total // SHARE))
    sample = vectors.orderBy(F.xxhash64("vid")).limit(wanted).select("vector").toArrow()
    fixed = spark.sparkContext.broadcast((directory, _matrix(sample.column("vector"), dim)))

    chunks = max(1, -(-asked.select("vid").distinct().count() // QUERIES))
    hosts = _hosts(index, fixed, chunks)
    guests = _guests(vectors.join(asked.select("vid").distinct(), "vid", "left_semi"), fixed, dim, kept, chunks)
    group = ["table", "block", "chunk"]
    pairs = hosts.groupBy(*group).cogroup(guests.groupBy(*group)).applyInArrow(
        _compare(dim), f"q long, score double, {_kinds(vectors, 'vid', 'first')}"
    )
    best = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "first"))
    found = pairs.distinct().withColumn("_rank", best).filter(F.col("_rank") <= kept)
    found = found.join(vectors.select("vid", "ids"), "vid")
    found = found.select("q", "score", F.explode("ids").alias("vec_id"))
    first = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    found = freeze(found.withColumn("_rank", first).filter(F.col("_rank") <= kept).drop("_rank"), "found")
    listed = asked.join(found, asked["vid"] == found["q"]).filter("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = listed.withColumn("rank", rank).filter(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _hosts(index: DataFrame, fixed, chunks: int) -> DataFrame:
    """Indexed vectors with their block, once for each chunk of the queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directory, _ = fixed.value
        for batch in batches:
            table = batch.column("table").to_numpy()
            code, vid = batch.column("code").to_numpy(), batch.column("vid").to_numpy()
            block = np.zeros(len(batch), np.int64)
            for t in range(TABLES):
                own = table == t
                known, start, size = directory[t]
                at = np.searchsorted(known, code[own])
                # Vectors of a bucket are spread over its places by their numbers.
                spread = (vid[own] * 2654435761 & 0x7FFFFFFF) % size[at]
                block[own] = (start[at] + spread) // BLOCK
            columns = [*batch.columns, pa.array(block)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "block"])

    placed = index.mapInArrow(run, f"{_kinds(index, *index.columns)}, block long")
    return placed.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))


def _guests(queries: DataFrame, fixed, dim: int, kept: int, chunks: int) -> DataFrame:
    """Queries once for each block that they visit, with the buckets and the bound on their score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directory, sample = fixed.value
        directions, offsets = projections(dim)
        for whole in batches:
            for lo in range(0, len(whole), 128):
                batch = whole.slice(lo, 128)
                q = _matrix(batch.column("vector"), dim)
                bound = np.full(len(q), -np.inf)
                if len(sample) > kept:
                    close = q @ sample.T
                    bound = np.partition(close, len(sample) - kept, axis=1)[:, len(sample) - kept]
                    bound = bound - 1e-9 * np.abs(bound) - 1e-12
                unit = q / np.sqrt((q * q).sum(axis=1))[:, None]
                unit = np.concatenate([unit, np.zeros((len(q), 1))], axis=1)
                for t in range(TABLES):
                    known, start, size = directory[t]
                    visit = probes(cells(unit, directions[t], offsets[t]), known, PROBES)
                    row = np.repeat(np.arange(len(q)), visit.shape[1])
                    at = visit.ravel()
                    spans = (start[at] + size[at] - 1) // BLOCK - start[at] // BLOCK + 1
                    row, at = np.repeat(row, spans), np.repeat(at, spans)
                    step = np.arange(len(at)) - np.repeat(np.cumsum(spans) - spans, spans)
                    block = start[at] // BLOCK + step
                    order = np.lexsort((block, row))
                    row, block, at = row[order], block[order], at[order]
                    new = np.ones(len(row), bool)
                    new[1:] = (row[1:] != row[:-1]) | (block[1:] != block[:-1])
                    first = np.flatnonzero(new)
                    ends = np.append(first, len(row)).astype(np.int32)
                    pick = pa.array(row[first])
                    columns = [
                        pa.array(np.full(len(first), t, np.int32)), pa.array(block[first]),
                        batch.column("vid").take(pick), batch.column("vector").take(pick),
                        pa.array(bound[row[first]]), pa.ListArray.from_arrays(ends, known[at]),
                    ]
                    names = ["table", "block", "vid", "vector", "bound", "visits"]
                    yield pa.RecordBatch.from_arrays(columns, names)

    kind = queries.schema["vector"].dataType.simpleString()
    schema = f"table int, block long, vid long, vector {kind}, bound double, visits array<long>"
    placed = queries.select("vid", "vector").mapInArrow(run, schema)
    return placed.withColumn("chunk", F.pmod(F.xxhash64("vid"), F.lit(chunks)).cast("int"))


def _compare(dim: int):
    """Function of one block: its buckets against the queries that visit them."""

    def run(hosts: pa.Table, guests: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        first = hosts.column("first").combine_chunks()
        if len(hosts) and len(guests):
            x, q = _matrix(hosts.column("vector"), dim), _matrix(guests.column("vector"), dim)
            vid, asked = hosts.column("vid").to_numpy(), guests.column("vid").to_numpy()
            bound = guests.column("bound").to_numpy()
            code = hosts.column("code").to_numpy()
            visits = guests.column("visits").combine_chunks()
            goal = visits.flatten().to_numpy()
            who = np.repeat(np.arange(len(q)), np.diff(visits.offsets.to_numpy()))
            order, by_goal = np.argsort(code, kind="stable"), np.argsort(goal, kind="stable")
            code, goal, who = code[order], goal[by_goal], who[by_goal]
            for c in np.unique(code):
                own = order[np.searchsorted(code, c) : np.searchsorted(code, c, "right")]
                at = who[np.searchsorted(goal, c) : np.searchsorted(goal, c, "right")]
                for lo in range(0, len(own), 1024):
                    some = own[lo : lo + 1024]
                    i, j = np.nonzero(q[at] @ x[some].T >= bound[at][:, None])
                    score = (q[at[i]] * x[some[j]]).sum(axis=1)
                    out.append((asked[at[i]], score, vid[some[j]], some[j]))
        none = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))
        q, score, vid, row = (np.concatenate(c) for c in zip(none, *out))
        columns = [pa.array(q), pa.array(score), pa.array(vid), first.take(pa.array(row))]
        return pa.table(columns, ["q", "score", "vid", "first"])

    return run
