"""Helpers of the operators: frozen intermediate tables, positions in groups, byte buffers."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sumstone.session import remove_folder, scratch_path

#: White space of the word rule ``[^\x20\x09-\x0D]+``.
SPACES = (9, 10, 11, 12, 13, 32)
WORD = r"[^\x20\x09-\x0D]+"


def freeze(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and return the written rows.

    Cuts the lineage so that a lost executor costs a read, and fixes values that depend on how rows
    were dealt to tasks.
    """
    return _written(df, scratch_path(df.sparkSession, label))


@contextmanager
def frozen(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``freeze`` for one block: the written rows are removed behind it.

    What is read from them has to be frozen or collected in the block.
    """
    path = scratch_path(df.sparkSession, label)
    yield _written(df, path)
    remove_folder(df.sparkSession, path)


#: With it Spark removes a query's shuffle files at its end; else they stay until the driver happens
#: to collect its garbage, and the files of many queries in a row are on disk at once.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(_TIDY, None)
    spark.conf.set(_TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_TIDY)
        else:
            spark.conf.set(_TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def row_places() -> tuple[Column, Column]:
    """The task and the place in it of each row; to be frozen before use."""
    place = F.monotonically_increasing_id()
    return F.shiftright(place, 33).alias("_part"), place.alias("_seq")


def offsets_by_part(parts: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """``parts`` (one row per key and ``_part``) with ``_before``: the amounts of earlier parts."""
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("_before", F.coalesce(F.sum(amount).over(earlier), F.lit(0)))


def held_out(doc_id: Column) -> Column:
    """True where the crc32 of the id as text leaves no remainder by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def worker_state(name: str, large: bool = False) -> dict:
    """A dict that lives as long as the Python worker, whatever task asks for it.

    Of ``large`` ones only the last that was asked for is kept: a worker that serves several stages
    does not hold the tables of all of them.
    """
    module = sys.modules.setdefault("_sumstone_worker", types.ModuleType("_sumstone_worker"))
    states = module.__dict__.setdefault("states", {})
    if large:
        for other in [k for k, (_, big) in states.items() if big and k != name]:
            del states[other]
    return states.setdefault(name, ({}, large))[0]


def give_back() -> None:
    """Return memory that earlier batches and stages freed to the system.

    A worker shares its executor's memory with a JVM; what its allocators keep for later is missing
    there.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column of a new batch; null counts as empty."""
    give_back()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offs


def row_ranges(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` units; a larger row stands alone."""
    ends = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield lo, hi
        lo = hi


def joined(data: np.ndarray, offs: np.ndarray, lo: int, hi: int, gap: bytes):
    """Rows ``lo`` to ``hi`` with ``gap`` before each and after the last, their starts and ends."""
    raw = data.tobytes() if len(data) < 1 << 16 else data
    rows = [bytes(raw[offs[i] : offs[i + 1]]) for i in range(lo, hi)]
    buffer = np.frombuffer(gap + gap.join(rows) + gap, np.uint8)
    sizes = offs[lo + 1 : hi + 1] - offs[lo:hi]
    starts = np.cumsum(sizes + len(gap)) - sizes
    return buffer, starts, starts + sizes


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (xor-shift and multiply rounds)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


_BASE = 0x2545F4914F6CDD1D


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, kept by the worker."""
    state = worker_state("powers")
    if len(state.get("up", ())) < n:
        n = max(n, 1 << 16)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out = np.ones(n, np.uint64)
            filled = 1
            while filled < n:  # doubling: each pass extends what is there
                step = np.uint64(pow(base, filled, 1 << 64))
                more = min(filled, n - filled)
                with np.errstate(over="ignore"):
                    out[filled : filled + more] = out[:more] * step
                filled += more
            state[key] = out
    return state["up"], state["down"]


def range_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges; equal bytes give equal hashes wherever they stand."""
    up, down = _powers(len(buffer) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * up[: len(buffer)], out=sums[1:])
        value = (sums[ends] - sums[starts]) * down[starts]
        return mixed(value ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))


def _table(values) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


def lower_ascii(buffer: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes as they are."""
    return buffer + ((buffer >= 65) & (buffer <= 90)).astype(np.uint8) * np.uint8(32)


def word_ranges(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a buffer that begins and ends with white space."""
    inside = ~_table(SPACES)[buffer]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    return edges[0::2], edges[1::2]
