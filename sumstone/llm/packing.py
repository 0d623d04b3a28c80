"""Packing of documents into training sequences, balanced by estimated cost."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sumstone.llm.common import give_back, row_ranges
from sumstone.llm.tokens import encode

#: Tokens that are packed together.
GROUP = 2_000_000
#: Words whose ids a worker keeps.
WORDS = 250_000
#: Bytes of text that are encoded together.
_TEXT = 1 << 21


def rooms_for(tokens: int, capacity: int) -> np.ndarray:
    """Sizes of the sequences for ``tokens``: full ones, and powers of two for the rest."""
    rest = tokens % capacity
    powers = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.array([capacity] * (tokens // capacity) + powers, np.int64)


def place(
    lengths: np.ndarray, capacity: int, linear: float, quadratic: float
) -> dict[str, np.ndarray]:
    """Pieces of documents of the given lengths and their places.

    The cost of a piece is ``linear * n + quadratic * n * n``: attention stays within a piece.  A
    document longer than a sequence fills whole sequences first.  What is left is taken in
    descending order, and goes to the cheapest sequence with room for it; if none has room, to the
    cheapest that has any, as far as it fits, and on.  Ties go to the earlier document and
    sequence.  The sequences hold exactly the given tokens, so no token is padding.
    """
    full, rest = lengths // capacity, lengths % capacity
    doc = np.repeat(np.arange(len(lengths)), full)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(full) - full, full)) * capacity
    pieces = [
        (doc, start, np.full(len(doc), capacity), np.arange(len(doc)), np.zeros(len(doc), np.int64))
    ]
    size = rooms_for(int(rest.sum()), capacity)
    room, cost = size.copy(), np.zeros(len(size))
    placed: list[tuple[int, int, int, int, int]] = []
    for d in np.argsort(-rest, kind="stable"):
        left = int(rest[d])
        while left:
            fits = room >= left
            open_ = fits if fits.any() else room > 0
            s = int(np.where(open_, cost, np.inf).argmin())
            n = min(left, int(room[s]))
            placed.append((d, lengths[d] - left, n, len(doc) + s, size[s] - room[s]))
            room[s] -= n
            cost[s] += linear * n + quadratic * n * n
            left -= n
    if placed:
        pieces.append(tuple(np.array(column, np.int64) for column in zip(*placed)))
    names = ("doc", "start", "length", "sequence", "offset")
    return {name: np.concatenate(c) for name, c in zip(names, zip(*pieces))}


def pack(
    docs: DataFrame,
    key: str,
    text: str,
    tokenizer: str,
    end: int,
    capacity: int = 1024,
    linear: float = 1.0,
    quadratic: float = 1 / 1024,
    group: int = GROUP,
    words: int = WORDS,
) -> DataFrame:
    """Pieces of all documents: ``key, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit token ids; each id of a document and its ``end`` lies
    in exactly one piece.  ``capacity`` is a power of two, and so is every sequence length, so
    nothing is padded.  Each task packs the documents that it reads in groups of about ``group``
    tokens (a worker keeps the ids of ``words`` words), so no row moves between tasks, however documents are distributed, and memory is bounded
    by a group and the longest text.  A null text is empty and packs its end id alone; repeated rows
    are packed once each; an empty table gives an empty result.  ``sequence_id`` is unique, not
    gapless.
    """
    if capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 32
        held: list[np.ndarray] = []
        keys: list = []
        tokens = 0

        def emit() -> pa.RecordBatch:
            nonlocal sequence, tokens
            lengths = np.array([len(x) for x in held], np.int64)
            p = place(lengths, capacity, linear, quadratic)
            ids = [held[d][s : s + n].tobytes() for d, s, n in zip(p["doc"], p["start"], p["length"])]
            columns = [
                pa.array([keys[d] for d in p["doc"]], schema.field(key).type),
                pa.array(p["start"]),
                pa.array(p["length"]),
                pa.array(ids, pa.binary()),
                pa.array(lengths[p["doc"]]),
                pa.array(p["sequence"] + sequence),
                pa.array(p["offset"]),
            ]
            sequence += int(p["sequence"].max()) + 1
            held.clear()
            keys.clear()
            tokens = 0
            return pa.RecordBatch.from_arrays(columns, schema.names)

        schema = None
        for batch in batches:
            if schema is None:
                schema = pa.schema(
                    [
                        batch.schema.field(key),
                        ("start", pa.int64()),
                        ("length", pa.int64()),
                        ("ids", pa.binary()),
                        ("doc_tokens", pa.int64()),
                        ("sequence_id", pa.int64()),
                        ("offset", pa.int64()),
                    ]
                )
            give_back()
            sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy()
            for lo, hi in row_ranges(sizes, _TEXT):
                texts = batch.column(text).slice(lo, hi - lo).to_pylist()
                ids, bounds = encode(tokenizer, texts, end, words)
                names = batch.column(key).slice(lo, hi - lo).to_pylist()
                for name, a, b in zip(names, bounds[:-1], bounds[1:]):
                    held.append(ids[a:b])
                    keys.append(name)
                    tokens += int(b - a)
                    if tokens >= group:
                        yield emit()
        if held:
            yield emit()

    columns = StructType([docs.schema[key]])
    for name, kind in (
        ("start", "long"), ("length", "long"), ("ids", "binary"), ("doc_tokens", "long"),
        ("sequence_id", "long"), ("offset", "long"),
    ):
        columns = columns.add(name, kind)
    return docs.select(F.col(key), F.col(text)).mapInArrow(run, columns)
