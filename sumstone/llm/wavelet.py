"""Token-ID files: one wavelet matrix per shard, with rank and select from the compressed file."""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sumstone.llm.common import freeze, give_back, offsets_by_part, row_ranges
from sumstone.llm.tokens import encode

MAGIC = b"WAVEMAT1"
#: Tokens of one shard file, about.
SHARD = 1 << 20
#: Bits between two entries of a rank directory.
BLOCK = 512

#: Bytes of text that are encoded together.
_TEXT = 1 << 22


def build(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """The file of the documents whose ids follow each other in ``ids``.

    Level by level, from the highest bit down, the bits of all ids are stored as one plane, and the
    ids are dealt anew: those with a 0 first, each half in its order.  A header names the number of
    zeros of each plane and where the planes lie; each plane is compressed by itself, with the
    number of ones before every ``BLOCK`` bits beside it.
    """
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    row = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    press = zstandard.ZstdCompressor(level=1).compress
    blobs, zeros = [press(lengths.astype("<i8").tobytes())], []
    for level in range(bits - 1, -1, -1):
        one = ((row >> level) & 1).astype(bool)
        plane = np.packbits(one, bitorder="little")
        low = np.compress(~one, row)
        zeros.append(len(low))
        row = np.concatenate([low, np.compress(one, row)])
        counts = np.bitwise_count(np.pad(plane, (0, -len(plane) % (BLOCK // 8))))
        counts = counts.reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.int64)
        ranks = np.concatenate([[0], np.cumsum(counts)]).astype("<u4")
        blobs += [press(plane.tobytes()), press(ranks.tobytes())]
    ends = np.cumsum([len(b) for b in blobs]).tolist()
    header = {"n": len(ids), "docs": len(lengths), "bits": bits, "zeros": zeros, "ends": ends}
    head = json.dumps(header).encode()
    return MAGIC + struct.pack("<I", len(head)) + head + b"".join(blobs)


class WaveletMatrix:
    """Reads one file; planes are decompressed when first needed."""

    def __init__(self, file: bytes):
        if file[:8] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        (size,) = struct.unpack("<I", file[8:12])
        self.header = json.loads(file[12 : 12 + size])
        self.bits, self.zeros, self.n = (self.header[k] for k in ("bits", "zeros", "n"))
        self._file, self._base = file, 12 + size
        self._planes: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _blob(self, i: int) -> bytes:
        ends = [0, *self.header["ends"]]
        part = self._file[self._base + ends[i] : self._base + ends[i + 1]]
        return zstandard.ZstdDecompressor().decompress(part)

    def lengths(self) -> np.ndarray:
        """Ids of each document, with the end id."""
        return np.frombuffer(self._blob(0), "<i8")

    def _plane(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        if level not in self._planes:
            plane = np.frombuffer(self._blob(1 + 2 * level), np.uint8)
            self._planes[level] = (plane, np.frombuffer(self._blob(2 + 2 * level), "<u4"))
        return self._planes[level]

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        plane, ranks = self._plane(level)
        block = i // BLOCK
        count, byte = int(ranks[block]), block * BLOCK // 8
        count += int(np.bitwise_count(plane[byte : i // 8]).sum())
        return count + (int(plane[i // 8]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else count

    def _bit(self, level: int, i: int) -> int:
        return int(self._plane(level)[0][i // 8]) >> (i % 8) & 1

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.bits):
            ones = self._ones(level, i)
            one = self._bit(level, i)
            i = self.zeros[level] + ones if one else i - ones
            value = value << 1 | one
        return value

    def _span(self, symbol: int, end: int) -> tuple[int, int]:
        """Where the ids equal to ``symbol`` among the first ``end`` lie after the last level."""
        lo, hi = 0, end
        for level in range(self.bits):
            a, b = self._ones(level, lo), self._ones(level, hi)
            if symbol >> (self.bits - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, symbol: int, end: int) -> int:
        """How often ``symbol`` occurs among the first ``end`` ids."""
        if symbol >> self.bits:
            return 0
        lo, hi = self._span(symbol, end)
        return hi - lo

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def _select_bit(self, level: int, one: int, k: int) -> int:
        """Place of the ``k``-th (from 0) bit of the given value in a plane."""
        plane, ranks = self._plane(level)
        starts = np.minimum(np.arange(len(ranks)) * BLOCK, self.n)
        before = ranks.astype(np.int64) if one else starts - ranks
        block = int(np.searchsorted(before, k, "right")) - 1
        byte = block * BLOCK // 8
        own = np.unpackbits(plane[byte : byte + BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(own == one)[k - int(before[block])])

    def select(self, symbol: int, k: int) -> int:
        """Place of the ``k``-th occurrence (from 0) of ``symbol``."""
        if symbol >> self.bits or not 0 <= k < self.count(symbol):
            raise IndexError(k)
        i = self._span(symbol, self.n)[0] + k
        for level in range(self.bits - 1, -1, -1):
            one = symbol >> (self.bits - 1 - level) & 1
            i = self._select_bit(level, one, i - self.zeros[level] if one else i)
        return i

    def ids(self) -> np.ndarray:
        """All ids, from the lowest plane up: each level undoes one dealing."""
        row = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for level in range(self.bits - 1, -1, -1):
            bits = np.unpackbits(self._plane(level)[0], count=self.n, bitorder="little")
            one = bits.view(bool)
            back = np.empty_like(row)
            back[np.flatnonzero(~one)] = row[: self.zeros[level]]
            back[np.flatnonzero(one)] = row[self.zeros[level] :]
            row = back | (bits.astype(row.dtype) << (self.bits - 1 - level))
        return row.astype("<u4")


def full_uri(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the session's default file system."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return where.getFileSystem(conf).makeQualified(where).toString()


def open_store(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a Hadoop URI; its names of the S3 scheme are S3."""
    for other in ("s3a://", "s3n://"):
        if uri.startswith(other):
            uri = "s3://" + uri[len(other) :]
    return arrow_fs.FileSystem.from_uri(uri)


def write_shards(
    docs: DataFrame, key: str, text: str, tokenizer: str, end: int, folder: str, shard: int = SHARD
) -> DataFrame:
    """Encode all documents in ascending order of ``key`` and write them as shard files.

    Returns the manifest, one row a file: ``_part``, ``shard``, ``file``, ``keys`` (of its documents,
    in order), ``tokens`` and ``start`` (ids of all documents before the file).  Null keys come
    first, equal keys in order of their texts; a null text is empty.  A file holds whole documents,
    about ``shard`` tokens or one longer document.  Each attempt of a task writes files under new
    names; the manifest, published once, lists those of the attempts that counted, so a lost
    executor leaves at most unlisted files.
    """
    spark = docs.sparkSession
    target = full_uri(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(target)
        store.create_dir(base, recursive=True)
        keys: list = []
        rows: list[np.ndarray] = []
        tokens, number = 0, 0

        def emit() -> pa.RecordBatch:
            nonlocal tokens, number
            name = f"{uuid.uuid4().hex}.wave"
            file = build(np.concatenate(rows), np.array([len(r) for r in rows], np.int64))
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(file)
            columns = [pa.array([x]) for x in (number, name)]
            columns += [pa.array([list(keys)], pa.list_(kind)), pa.array([tokens])]
            rows.clear()
            keys.clear()
            number, tokens = number + 1, 0
            return pa.RecordBatch.from_arrays(columns, ["shard", "file", "keys", "tokens"])

        for batch in batches:
            kind = batch.schema.field(key).type
            give_back()
            sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy()
            for lo, hi in row_ranges(sizes, _TEXT):
                ids, bounds = encode(tokenizer, batch.column(text).slice(lo, hi - lo), end)
                names = batch.column(key).slice(lo, hi - lo).to_pylist()
                for name, a, b in zip(names, bounds[:-1], bounds[1:]):
                    rows.append(ids[a:b])
                    keys.append(name)
                    tokens += int(b - a)
                    if tokens >= shard:
                        yield emit()
        if rows:
            yield emit()

    # The second range column splits equal keys by their texts.
    tie = F.xxhash64(text)
    ordered = docs.select(key, text).repartitionByRange(F.col(key).asc_nulls_first(), tie)
    ordered = ordered.sortWithinPartitions(F.col(key).asc_nulls_first(), tie, text)
    schema = f"shard long, file string, keys array<{docs.schema[key].dataType.simpleString()}>, tokens long"
    written = ordered.mapInArrow(run, schema).withColumn("_part", F.spark_partition_id())
    written = freeze(written, "wave-manifest")
    by_part = written.groupBy("_part").agg(F.sum("tokens").alias("_tokens"))
    # One row a part, so the running sum over all parts is over a table as long as the task list.
    by_part = offsets_by_part(by_part.withColumn("_all", F.lit(0)), ["_all"], "_tokens")
    own = offsets_by_part(
        written.select(F.col("shard"), "tokens", F.col("_part").alias("_task"))
        .withColumn("_part", F.col("shard")), ["_task"], "tokens",
    )
    own = own.select(F.col("_task").alias("_part"), "shard", F.col("_before").alias("_in_part"))
    placed = written.join(by_part.select("_part", "_before"), "_part").join(own, ["_part", "shard"])
    return placed.withColumn("start", F.col("_before") + F.col("_in_part")).drop(
        "_before", "_in_part"
    )


def _files(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """The manifest with the bytes of each of its files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wave").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("file"), "content").join(manifest, "file")


def read_shards(spark: SparkSession, manifest: DataFrame, folder: str, key: str) -> DataFrame:
    """Documents read back from the files: ``key, start, n_tokens, ids`` (ids as in the files)."""
    kind = manifest.schema["keys"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                one = batch.slice(row, 1)
                matrix = WaveletMatrix(one.column("content")[0].as_py())
                ids, lengths = matrix.ids(), matrix.lengths()
                ends = np.cumsum(lengths)
                parts = [ids[e - n : e].tobytes() for e, n in zip(ends, lengths)]
                columns = [
                    one.column("keys").flatten(),
                    pa.array(one.column("start")[0].as_py() + ends - lengths),
                    pa.array(lengths),
                    pa.array(parts, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [key, "start", "n_tokens", "ids"])

    files = _files(spark, manifest, folder).select("content", "keys", "start")
    return files.mapInArrow(run, f"{key} {kind}, start long, n_tokens long, ids binary")


def find_token(
    spark: SparkSession, manifest: DataFrame, folder: str, token: int, key: str
) -> DataFrame:
    """Every occurrence of a token by select, without decoding: ``key, place`` (in its document)."""
    kind = manifest.schema["keys"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                matrix = WaveletMatrix(batch.column("content")[row].as_py())
                places = [matrix.select(token, k) for k in range(matrix.count(token))]
                ends = np.cumsum(matrix.lengths())
                doc = np.searchsorted(ends, places, "right")
                starts = ends - matrix.lengths()
                columns = [
                    batch.column("keys").slice(row, 1).flatten().take(pa.array(doc, pa.int64())),
                    pa.array(np.array(places, np.int64) - starts[doc], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [key, "place"])

    files = _files(spark, manifest, folder).select("content", "keys")
    return files.mapInArrow(run, f"{key} {kind}, place long")

