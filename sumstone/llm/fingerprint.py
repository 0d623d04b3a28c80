"""Document fingerprints: invertible Bloom lookup tables of paragraph digests.

Two tables of one size subtract cell by cell; paragraphs that both versions hold cancel out, and
peeling recovers those that only one holds.  Where that fails the tables are too small for the
difference, and larger ones are built.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from sumstone.llm.common import joined, mixed, range_hashes, row_ranges, text_bytes

#: Cells of a fingerprint, and of the first attempt at a difference; a multiple of 3.
CELLS = 12

_CHUNK = 1 << 20
_CHECK = np.uint64(0x5BD1E995A3C59AC3)
_SEEDS = [np.uint64(s) for s in (0x1B873593, 0xCC9E2D51, 0x85EBCA6B)]


def paragraphs(data: np.ndarray, offs: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Row (from 0) and digest of each paragraph of the rows ``lo`` to ``hi``.

    A paragraph ends at a line break, and within a line after a full stop, an exclamation or a
    question mark that a space follows.  Of equal paragraphs in a text the second, third and so on
    get digests of their own.
    """
    buffer, _, ends = joined(data, offs, lo, hi, b"\n")
    apart = buffer == 10
    stop = (buffer == 46) | (buffer == 33) | (buffer == 63)
    stop[:-1] &= buffer[1:] == 32
    first = np.flatnonzero(~apart[1:] & (apart[:-1] | stop[:-1])) + 1
    last = np.flatnonzero(~apart[:-1] & (apart[1:] | stop[:-1])) + 1
    digest = range_hashes(buffer, first, last)
    row = np.searchsorted(ends, first, "right")
    order = np.lexsort((digest, row))
    row, digest = row[order], digest[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (digest[1:] != digest[:-1])
    places = np.arange(len(row))
    nth = (places - np.maximum.accumulate(np.where(new, places, 0))).astype(np.uint64)
    with np.errstate(over="ignore"):
        return row, mixed(digest + nth * np.uint64(0x9E3779B97F4A7C15))


def _cells(row: np.ndarray, item: np.ndarray, cells: int) -> Iterator[np.ndarray]:
    """The three cells of each item, one in each third of its row's table."""
    third = np.uint64(cells // 3)
    for k, seed in enumerate(_SEEDS):
        yield row * cells + k * int(third) + (mixed(item ^ seed) % third).astype(np.int64)


class Tables:
    """One table a row: counts, and exclusive-or sums of the items and of their check values."""

    def __init__(self, row: np.ndarray, item: np.ndarray, rows: int, cells: int):
        self.cells, self.rows = cells, rows
        self.count = np.zeros(rows * cells, np.int64)
        self.item = np.zeros(rows * cells, np.uint64)
        self.check = np.zeros(rows * cells, np.uint64)
        self.put(row, item, np.ones(len(row), np.int64))

    def put(self, row: np.ndarray, item: np.ndarray, times: np.ndarray) -> None:
        check = mixed(item ^ _CHECK)
        for cell in _cells(row, item, self.cells):
            np.add.at(self.count, cell, times)
            np.bitwise_xor.at(self.item, cell, item)
            np.bitwise_xor.at(self.check, cell, check)

    def less(self, other: Tables) -> Tables:
        out = Tables(np.zeros(0, np.int64), np.zeros(0, np.uint64), self.rows, self.cells)
        out.count = self.count - other.count
        out.item = self.item ^ other.item
        out.check = self.check ^ other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Items taken out of each row by sign, and whether nothing is left in it."""
        more = np.zeros(self.rows, np.int64)
        fewer = np.zeros(self.rows, np.int64)
        while True:
            alone = np.flatnonzero(np.abs(self.count) == 1)
            alone = alone[self.check[alone] == mixed(self.item[alone] ^ _CHECK)]
            if not len(alone):
                break
            row, item, sign = alone // self.cells, self.item[alone], self.count[alone]
            order = np.lexsort((item, row))  # an item may stand alone in several cells
            row, item, sign = row[order], item[order], sign[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
            row, item, sign = row[new], item[new], sign[new]
            self.put(row, item, -sign)
            more += np.bincount(row[sign > 0], minlength=self.rows)
            fewer += np.bincount(row[sign < 0], minlength=self.rows)
        left = (self.count != 0) | (self.item != 0)
        return more, fewer, ~left.reshape(self.rows, self.cells).any(axis=1)

    def text(self, sizes: np.ndarray) -> list[str]:
        """Each table as a string: number of paragraphs, counts, items, check values."""
        shape = (self.rows, self.cells)
        packed = np.concatenate(
            [
                sizes.astype("<u4").view(np.uint8).reshape(self.rows, 4),
                self.count.astype("<u4").reshape(shape).view(np.uint8).reshape(self.rows, -1),
                self.item.astype("<u8").reshape(shape).view(np.uint8).reshape(self.rows, -1),
                self.check.astype("<u4").reshape(shape).view(np.uint8).reshape(self.rows, -1),
            ],
            axis=1,
        )
        return [base64.b64encode(r.tobytes()).decode() for r in packed]


def likeness(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], rows: int
) -> np.ndarray:
    """Share of the paragraphs of both versions that both hold, row by row; 1 if none has any.

    Only what peeling recovers is counted; rows that cannot be peeled are tried again with twice
    the cells.
    """
    out = np.ones(rows)
    open_rows, cells = np.arange(rows), CELLS
    size = np.bincount(a[0], minlength=rows)
    while len(open_rows):
        number = np.full(rows, -1)
        number[open_rows] = np.arange(len(open_rows))
        tables = []
        for row, item in (a, b):
            keep = number[row] >= 0
            tables.append(Tables(number[row[keep]], item[keep], len(open_rows), cells))
        more, fewer, done = tables[0].less(tables[1]).peel()
        n = size[open_rows]
        out[open_rows[done]] = ((n - more) / np.maximum(n + fewer, 1))[done]
        out[open_rows[done & (n + fewer == 0)]] = 1.0
        open_rows, cells = open_rows[~done], 2 * cells
    return out


def compare_versions(
    df: DataFrame, prints: dict[str, str], pairs: dict[str, tuple[str, str]], carry: list[str]
) -> DataFrame:
    """The columns ``carry`` of ``df``, fingerprints of text columns, and likenesses of two of them.

    ``prints`` maps a new column to the text column whose fingerprint it gets, ``pairs`` a new column
    to the two text columns whose tables are compared.  Whole texts count; a null text is empty, and
    two texts without paragraphs are alike.  Equal texts have equal fingerprints.  Rows stay where
    they are; memory is bounded by a few megabytes of text, or one longer row.
    """
    texts = list(dict.fromkeys([*prints.values(), *(t for p in pairs.values() for t in p)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = {t: text_bytes(batch.column(t)) for t in texts}
            sizes = sum(np.diff(offs) for _, offs in given.values())
            for lo, hi in row_ranges(sizes, _CHUNK):
                items = {t: paragraphs(*given[t], lo, hi) for t in texts}
                columns = [batch.column(c).slice(lo, hi - lo) for c in carry]
                for t in prints.values():
                    row, item = items[t]
                    table = Tables(row, item, hi - lo, CELLS)
                    columns.append(pa.array(table.text(np.bincount(row, minlength=hi - lo)), pa.string()))
                for s, t in pairs.values():
                    columns.append(pa.array(likeness(items[s], items[t], hi - lo)))
                yield pa.RecordBatch.from_arrays(columns, [*carry, *prints, *pairs])

    schema = StructType(list(df.select(*carry).schema.fields))
    for name in prints:
        schema = schema.add(name, "string")
    for name in pairs:
        schema = schema.add(name, "double")
    return df.select(*dict.fromkeys([*carry, *texts])).mapInArrow(run, schema)
