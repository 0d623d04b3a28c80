"""Runs of words that repeat with a period, found in tiles and stitched.

A run is a stretch with smallest period ``q`` and a length of at least ``least`` words and ``times``
periods that cannot be extended.  Periods are dealt to octaves ``[P, 2P)``; in each octave a document
is exploded into tiles of ``6P`` words, one around every boundary ``b`` that is a multiple of ``P``.
A run of three periods holds two whole periods behind some boundary, so the ``P`` words there come
again ``q`` words later: tiles without such an echo of their hashed words are put aside at once.  The
others are solved one by one: Z-functions of the words behind and before the boundary give how far
each period reaches.  Next tiles overlap in more than a period, so the fragments of one run overlap,
too: they are shuffled by document and period and stitched, while two runs with one period never
overlap in a whole period.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from sumstone.llm.common import freeze, mixed, row_ranges

#: A run: first word, number of words, period.
Run = tuple[int, int, int]
#: A part of a run as one or more tiles see it: period, first word, word after the last.
Fragment = tuple[int, int, int]

#: Step of the tiles of the smallest octaves.
BASE = 8
#: Bytes of text that are solved together.
_TEXT = 1 << 21
_FRAGMENTS = pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))


def z_function(s: list) -> list[int]:
    """For each place, how many values from there on equal those from the start on."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    lo = hi = 0
    for i in range(1, n):
        k = min(z[i - lo], hi - i) if i < hi else 0
        if i + k >= hi:
            while i + k < n and s[k] == s[i + k]:
                k += 1
            lo, hi = i, i + k
        z[i] = k
    return z


def _divisors(q: int) -> list[int]:
    """``q`` over each of its prime factors."""
    out, rest, r = [], q, 2
    while r * r <= rest:
        if rest % r == 0:
            out.append(q // r)
            while rest % r == 0:
                rest //= r
        r += 1
    return out + [q // rest] * (rest > 1)


def solve_tile(words: list, at: int, step: int, periods: list[int]) -> list[Fragment]:
    """Fragments with two whole primitive periods behind the boundary ``at`` of one tile."""
    behind = words[at:]
    right = z_function(behind)
    found = [
        q for q in periods
        if q < len(behind) and right[q] >= q and all(right[p] < q - p for p in _divisors(q))
    ]
    if not found:
        return []
    before = words[:at][::-1]
    reach = min(len(words), at + 2 * step)
    left = z_function([*before, None, *words[:reach][::-1]])
    out = []
    for q in found:
        back = left[len(before) + 1 + reach - at - q] if at + q <= reach else 0
        out.append((q, at - back, at + q + right[q]))
    return out


def _echoes(grams: np.ndarray, step: int, low: bool) -> tuple[np.ndarray, np.ndarray]:
    """Boundaries (multiples of ``step``) whose gram comes again at a distance of the octave."""
    n = len(grams)
    rows = np.append(grams, np.zeros(-n % step, np.uint64)).reshape(-1, step)
    if low:
        row, distance = np.nonzero(rows[:, 1:] == rows[:, :1])
        distance += 1
    else:
        row, distance = np.nonzero(rows[1:] == rows[:-1, :1])
        distance += step
    real = row * step + distance < n
    return row[real] * step, distance[real]


def fragments(docs: list[list], least: int, times: int) -> list[list[Fragment]]:
    """Fragments of the runs of each document (a list of words), joined over neighbouring tiles."""
    sizes = np.array([len(d) for d in docs], np.int64)
    out: list[list[Fragment]] = [[] for _ in docs]
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(docs)))}
    total = int(sizes.sum())
    codes = np.fromiter(map(vocabulary.__getitem__, chain.from_iterable(docs)), np.int64, total)
    del vocabulary
    # A value that stands nowhere else follows each document, so that no gram spans two of them.
    owner = np.repeat(np.arange(len(docs)), sizes + 1)
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = starts + sizes
    words = np.empty(total + len(docs), np.int64)
    words[ends] = -1 - np.arange(len(docs))
    words[np.delete(np.arange(len(words)), ends)] = codes
    place = np.arange(len(words))
    grams = mixed(words.astype(np.uint64) + np.uint64(1))

    def doubled(grams: np.ndarray, width: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed(grams[:-width] * np.uint64(3) + mixed(grams[width:]))

    width = 1
    while width < BASE and len(grams) > width:
        grams = doubled(grams, width)
        width *= 2
    if width < BASE:
        return out
    place = place[: len(grams)]
    step, low = BASE, True
    while True:
        kept = sizes[owner[place]] >= max(least, times * (1 if low else step))
        grams, place = grams[kept], place[kept]
        if len(grams) < 2 * step:
            return out
        bounds, periods = _echoes(grams, step, low)
        tiles, first = np.unique(bounds, return_index=True)
        last: dict[tuple[int, int], Fragment] = {}
        for b, told in zip(place[tiles].tolist(), np.split(periods, first[1:]) if len(tiles) else ()):
            d = int(owner[b])
            lo, hi = max(b - step, int(starts[d])), min(b + 5 * step, int(ends[d]))
            for q, start, end in solve_tile(words[lo:hi].tolist(), b - lo, step, told.tolist()):
                start, end = start + lo - int(starts[d]), end + lo - int(starts[d])
                held = last.get((d, q))
                if held is not None and start + q <= held[2]:
                    last[d, q] = (q, held[1], max(end, held[2]))
                    continue
                if held is not None:
                    out[d].append(held)
                last[d, q] = (q, start, end)
        for (d, _), held in last.items():
            out[d].append(held)
        if low:
            low = False
            continue
        if len(grams) <= step:
            return out
        grams = doubled(grams, step)
        place = place[: len(grams)]
        step *= 2


def stitch(parts: DataFrame, row: str, least: int, times: int) -> DataFrame:
    """``row`` and its ``runs``, ordered by start and period, from fragments of any tiles.

    ``parts`` has ``row, period, start, end``.  A stretch that a shorter period fills as well is left
    out: the shorter one has the same bounds.
    """
    ordered = Window.partitionBy(row, "period").orderBy("start", "end")
    reach = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = (reach.isNull() | (F.col("start") + F.col("period") > reach)).cast("long")
    numbered = parts.withColumn("_opens", opens)
    whole = F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = numbered.withColumn("_run", whole).groupBy(row, "period", "_run").agg(
        F.min("start").alias("start"), F.max("end").alias("end")
    )
    length = F.col("end") - F.col("start")
    runs = runs.filter((length >= least) & (length >= times * F.col("period")))
    runs = runs.groupBy(row, "start", "end").agg(F.min("period").alias("period"))
    told = F.struct("start", length.alias("length"), "period")
    return runs.groupBy(row).agg(F.sort_array(F.collect_list(told)).alias("runs"))


def collapse(words: list, runs: list[Run]) -> list:
    """The words that no run holds behind its first period."""
    drop = bytearray(len(words))
    for start, length, period in runs:
        drop[start + period : start + length] = b"\1" * (length - period)
    return [w for w, gone in zip(words, drop) if not gone] if runs else words


def with_runs(
    docs: DataFrame,
    text: str,
    carried: list[str],
    finish: Callable[[list[bytes], list[Run]], tuple],
    finished: StructType,
    edit: Callable[[tuple, list[bytes]], list[bytes]] | None = None,
    least: int = 24,
    times: int = 3,
) -> DataFrame:
    """``carried`` columns of each row, and what ``finish`` tells of its words and their runs.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text; ``edit`` may change them, given the carried
    values.  ``finish(words, runs)`` returns the values of the columns ``finished``.  Each task solves
    the tiles of the documents it reads; of documents with a fragment the words are kept in a frozen
    table, and only the fragments are shuffled.  A null or empty text has no words; repeated rows are
    told apart by a frozen row number and each has its own runs; an empty table gives an empty
    result.  Memory is bounded by a batch of rows and the longest text.
    """
    if times < 3 or least < 3 * BASE:
        raise ValueError("runs need three periods and 24 words at least")
    given = [docs.schema[c] for c in carried]
    inner = [f"_{i}" for i in range(len(carried))]
    done = [f"_done{i}" for i in range(len(finished))]

    def arrow_types(batch: pa.RecordBatch) -> list[pa.DataType]:
        return [batch.schema.field(n).type for n in inner]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("_text")), 0).to_numpy()
            for lo, hi in row_ranges(sizes, _TEXT):
                part = batch.slice(lo, hi - lo)
                docs_ = [t.split() if t else [] for t in part.column("_text").cast(pa.binary()).to_pylist()]
                if edit is not None:
                    names = zip(*[part.column(n).to_pylist() for n in inner]) if inner else [()] * len(docs_)
                    docs_ = [edit(n, w) for n, w in zip(names, docs_)]
                found = fragments(docs_, least, times)
                told = [None if f else finish(w, []) for w, f in zip(docs_, found)]
                held = [b" ".join(w).decode() if f else None for w, f in zip(docs_, found)]
                found = [[{"period": q, "start": s, "end": e} for q, s, e in f] for f in found]
                columns = [part.column(n) for n in inner]
                columns += [pa.array([t and t[i] for t in told], kind) for i, kind in enumerate(kinds)]
                columns += [pa.array(held, pa.string()), pa.array(found, _FRAGMENTS)]
                yield pa.RecordBatch.from_arrays(columns, [*inner, *done, "_words", "_parts"])

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.encode().split(b" ") for w in batch.column("_words").to_pylist()]
            runs = [
                [(r["start"], r["length"], r["period"]) for r in told or ()]
                for told in batch.column("runs").to_pylist()
            ]
            told = [finish(w, r) for w, r in zip(words, runs)]
            columns = [batch.column(n) for n in inner]
            columns += [pa.array([t[i] for t in told], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, [*inner, *done])

    kinds = [{"long": pa.int64(), "string": pa.string()}[f.dataType.typeName()] for f in finished]
    base = StructType()
    for name, field in [*zip(inner, given), *zip(done, finished)]:
        base = base.add(name, field.dataType)
    part = StructType().add("period", "long").add("start", "long").add("end", "long")
    table = docs.select(*[F.col(c).alias(n) for c, n in zip(carried, inner)], F.col(text).alias("_text"))
    both = StructType([*base.fields]).add("_words", "string").add("_parts", ArrayType(part))
    solved = table.mapInArrow(solve, both).withColumn("_row", F.monotonically_increasing_id())
    solved = freeze(solved, "tiles")
    open_ = solved.filter(F.col("_words").isNotNull())
    runs = stitch(open_.select("_row", F.inline("_parts")), "_row", least, times)
    joined = open_.select(*inner, "_words", "_row").join(runs, "_row", "left")
    ended = joined.select(*inner, "_words", "runs").mapInArrow(end, base)
    closed = solved.filter(F.col("_words").isNull()).select(*inner, *done)
    out = closed.unionByName(ended)
    return out.select(
        *[F.col(n).alias(c) for n, c in zip(inner, carried)],
        *[F.col(n).alias(f.name) for n, f in zip(done, finished)],
    )
