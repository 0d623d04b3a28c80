"""Counts of 64-bit keys under minimal perfect hashes, one per part of the keys.

A part's hash has levels of bits: a key that falls on a bit alone stays there, the others go on to
the next, smaller level.  The number of bits before a key's is its place, so ``n`` keys have the
places 0 to ``n - 1``, at about three bits a key.  The keys themselves are kept in order of their
places: any other key is told apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow.fs import FileType
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sumstone.llm.common import freeze, mixed
from sumstone.llm.wavelet import full_uri, open_store
from sumstone.session import scratch_path

#: Parts of the keys, whatever their number.
PARTS = 64
#: Vectors that are added at once.
FAN = 16


def _slots(keys: np.ndarray, level: int, words: int) -> np.ndarray:
    salt = np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) & 0xFFFFFFFFFFFFFFFF)
    with np.errstate(over="ignore"):
        return (mixed(mixed(keys.astype(np.uint64) + salt) ^ salt) % np.uint64(64 * words)).astype(np.int64)


def build(keys: np.ndarray) -> list[np.ndarray]:
    """The levels (64-bit words) of a minimal perfect hash of distinct keys."""
    levels: list[np.ndarray] = []
    while len(keys):
        words = len(keys) * 2 // 64 + 1
        slots = _slots(keys, len(levels), words)
        alone = np.bincount(slots, minlength=64 * words) == 1
        levels.append(np.packbits(alone, bitorder="little").view("<u8"))
        keys = keys[~alone[slots]]
    return levels


class MinimalHash:
    """Places of keys by the levels of ``build``."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.before = []
        total = 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.before.append(total + np.cumsum(ones) - ones)
            total += int(ones.sum())
        self.size = total

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; -1 or any place for a key that was not built in."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (words, before) in enumerate(zip(self.levels, self.before)):
            if not len(open_):
                break
            slots = _slots(keys[open_], level, len(words))
            word, bit = slots >> 6, (slots & 63).astype(np.uint64)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[hit]] = (before[word] + np.bitwise_count(below))[hit]
            open_ = open_[~hit]
        return out


def _blob(levels: list[np.ndarray]) -> tuple[bytes, list[int]]:
    return b"".join(w.tobytes() for w in levels), [len(w) for w in levels]


def _levels(blob: bytes, sizes: list[int]) -> list[np.ndarray]:
    return np.split(np.frombuffer(blob, "<u8"), np.cumsum(sizes)[:-1]) if sizes else []


class Part:
    """One part of the table: the hash, its verified keys, and columns of values by place."""

    def __init__(self, row: dict) -> None:
        self.hash = MinimalHash(_levels(row["levels"], row["sizes"]))
        self.keys = np.frombuffer(row["keys"], "<i8")
        self.values = {
            name: np.frombuffer(blob, "<i8") for name, blob in row.items()
            if isinstance(blob, bytes) and name not in ("levels", "keys")
        }

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The places of keys, -1 for one that is not in the table."""
        out = self.hash.places(keys)
        known = out >= 0
        known[known] = self.keys[out[known]] == keys[known]
        return np.where(known, out, -1)


#: A part without keys has no file.
EMPTY = {"levels": b"", "sizes": [], "keys": b""}


class PartFiles:
    """Parts read from the frozen table when first asked for; the least used go beyond a size."""

    def __init__(self, uri: str, most: int = 16_000_000) -> None:
        self.uri, self.most = uri, most
        self.held: dict[int, Part] = {}

    def __getitem__(self, part: int) -> Part:
        found = self.held.pop(part, None)
        if found is None:
            store, base = open_store(f"{self.uri}/part={part}")
            rows = [EMPTY]
            if store.get_file_info(base).type != FileType.NotFound:
                rows = ds.dataset(base, filesystem=store, format="parquet").to_table().to_pylist()
            found = Part(rows[0])
            while self.held and sum(len(p.keys) for p in self.held.values()) + len(found.keys) > self.most:
                del self.held[next(iter(self.held))]
        self.held[part] = found
        return found

    def look_up(self, parts: np.ndarray, keys: np.ndarray, names: list[str]) -> list[np.ndarray]:
        """Values of keys, all zero for a key that is not in the table."""
        out = [np.zeros(len(keys), np.int64) for _ in names]
        order = np.argsort(parts, kind="stable")
        told, first = np.unique(parts[order], return_index=True)
        for part, rows in zip(told.tolist(), np.split(order, first[1:]) if len(told) else ()):
            found = self[part]
            places = found.places(keys[rows])
            known = places >= 0
            if not known.any():
                continue
            for column, name in zip(out, names):
                column[rows[known]] = found.values[name][places[known]]
        return out


def write_hashes(tallies: DataFrame, label: str) -> tuple[DataFrame, str]:
    """One row a part with its minimal perfect hash over all distinct keys of ``tallies``.

    ``tallies`` has ``part`` and ``keys`` (packed 64-bit).  Keys are made distinct in a shuffle by
    key; a part gathers its share of the distinct keys, whose number is bounded by the pairs of ids.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("keys").to_pylist()):
                keys = np.frombuffer(blob, "<i8")
                for lo in range(0, len(keys), 1 << 20):
                    some = keys[lo : lo + (1 << 20)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), part, np.int32)), pa.array(some)], ["part", "key"]
                    )

    def gather(table: pa.Table) -> pa.Table:
        keys = np.sort(table.column("key").to_numpy())
        levels = build(keys)
        places = MinimalHash(levels).places(keys)
        ordered = np.empty_like(keys)
        ordered[places] = keys
        blob, sizes = _blob(levels)
        columns = [
            pa.array([table.column("part")[0].as_py()], pa.int32()), pa.array([blob], pa.binary()),
            pa.array([sizes], pa.list_(pa.int64())), pa.array([ordered.tobytes()], pa.binary()),
        ]
        return pa.Table.from_arrays(columns, ["part", "levels", "sizes", "keys"])

    keys = tallies.select("part", "keys").mapInArrow(unpack, "part int, key long").distinct()
    rows = keys.groupBy("part").applyInArrow(
        gather, "part int, levels binary, sizes array<long>, keys binary"
    )
    return write_parts(rows, label)


def write_parts(rows: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``rows`` written by part, and the full address of the folder."""
    spark = rows.sparkSession
    folder = scratch_path(spark, label)
    rows.write.partitionBy("part").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder), full_uri(spark, folder)


def dense_sums(tallies: DataFrame, hashes: str) -> DataFrame:
    """``part, sums``: the counts of ``tallies`` as one dense vector a part, by place.

    ``tallies`` has ``task, part, keys, counts`` with one row a task and part.  Each row becomes a
    vector under the part's hash; vectors are added in a tree, ``FAN`` at once, so no task holds
    more than that however many tasks there were.
    """

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = PartFiles(hashes)
        for batch in batches:
            for row in batch.to_pylist():
                part = files[row["part"]]
                keys, counts = np.frombuffer(row["keys"], "<i8"), np.frombuffer(row["counts"], "<i8")
                vector = np.zeros(part.hash.size, np.int64)
                vector[part.places(keys)] = counts
                columns = [
                    pa.array([row["part"]], pa.int32()), pa.array([row["task"]], pa.int64()),
                    pa.array([vector.tobytes()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "slot", "sums"])

    def add(table: pa.Table) -> pa.Table:
        vector = sum(np.frombuffer(v, "<i8") for v in table.column("sums").to_pylist())
        columns = [
            table.column("part")[:1], table.column("slot")[:1], pa.array([vector.tobytes()], pa.binary())
        ]
        return pa.Table.from_arrays(columns, ["part", "slot", "sums"])

    schema = "part int, slot long, sums binary"
    vectors = tallies.select("task", "part", "keys", "counts").mapInArrow(dense, schema)
    widest = tallies.agg(F.max("task")).first()[0]
    while widest:
        vectors = vectors.withColumn("slot", F.floor(F.col("slot") / FAN).cast("long"))
        vectors = vectors.groupBy("part", "slot").applyInArrow(add, schema)
        widest //= FAN
    return vectors.select("part", "sums")


def with_sums(tallies: DataFrame, hashes: DataFrame, uri: str, label: str) -> DataFrame:
    """The rows of ``hashes`` with the total count of each key by place (``sums``)."""
    return hashes.join(freeze(dense_sums(tallies, uri), label), "part")
