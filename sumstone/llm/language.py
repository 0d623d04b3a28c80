"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sumstone.llm.common import (
    give_back,
    joined,
    lower_ascii,
    row_ranges,
    text_bytes,
    worker_state,
)

#: Longest context, in bytes.
ORDER = 3
#: Symbols of the context trees: all bytes, upper-case ASCII letters as lower-case ones.
SYMBOLS = 256
#: Training documents per language, about: the bound of the sample that is counted.
SAMPLE = 3000
UNDETERMINED = "und"

_CHUNK = 1 << 20
_PAD = b" " * ORDER


def sampled(docs: DataFrame, lang: str, key: Column, per_language: int) -> DataFrame:
    """About ``per_language`` rows of each language, chosen by the hash of ``key``; all if fewer."""
    totals = {r[0]: r[1] for r in docs.groupBy(lang).count().collect()}  # one row a language
    keep = F.lit(False)
    draw = F.pmod(F.xxhash64(key), F.lit(1 << 30))
    for name, total in totals.items():
        share = int((1 << 30) * min(1.0, per_language / total))
        keep = F.when(F.col(lang) == name, draw < share).otherwise(keep)
    return docs.filter(keep)


def gram_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang, gram, n``: how often each run of ``ORDER + 1`` lower-cased bytes occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_bytes(batch.column("text"))
            names = np.array(batch.column("lang").to_pylist(), dtype=object)
            for lo, hi in row_ranges(np.diff(offs), _CHUNK):
                buffer, starts, ends = joined(data, offs, lo, hi, _PAD)
                low = lower_ascii(buffer).astype(np.uint32)
                grams = (low[:-3] << 24) | (low[1:-2] << 16) | (low[2:-1] << 8) | low[3:]
                for name in set(names[lo:hi]):
                    pick = np.flatnonzero(names[lo:hi] == name)
                    own = np.concatenate([grams[starts[i] - 3 : ends[i] - 3] for i in pick])
                    value, n = np.unique(own, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(value)), pa.array(value.astype(np.int64)), pa.array(n)],
                        ["lang", "gram", "n"],
                    )

    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    counted = rows.mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, text: str, lang: str, key: Column, per_language: int = SAMPLE) -> dict:
    """Frozen context statistics of each language, learned from a bounded sample of ``docs``.

    Rows without text or language teach nothing.  The sample bounds what reaches the driver: the
    distinct byte runs of about ``per_language`` documents a language.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    seen = gram_counts(sampled(known, lang, key, per_language), text, lang).toArrow()
    names = np.array(seen.column("lang").to_pylist(), dtype=object)
    grams = seen.column("gram").to_numpy().astype(np.int64)
    n = seen.column("n").to_numpy().astype(np.int64)
    languages = sorted(set(names))
    counts = []
    for name in languages:
        own = np.flatnonzero(names == name)
        own = own[np.argsort(grams[own])]
        counts.append((grams[own].astype(np.uint32), n[own]))
    symbol = lower_ascii(np.arange(SYMBOLS, dtype=np.uint8)).astype(np.uint32)
    return {"languages": languages, "symbol": symbol, "counts": counts}


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of ``keys``, the sum of their ``counts``, and how many rows each has."""
    value, back = np.unique(keys, return_inverse=True)
    return value, np.bincount(back, weights=counts, minlength=len(value)), np.bincount(back)


def code_lengths(grams: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Bits to code a symbol, by the counts of one language; from the empty context upwards.

    Orders are blended downwards: a symbol that a context has seen costs its share of the context's
    count plus the number of its distinct symbols; any other costs the escape, whose share is that
    number of distinct symbols, and then what the next shorter context asks.  Below the empty
    context all bytes are alike.  Each order holds what was seen and nothing else: its contexts, in
    order, with the bits of their escapes, and its runs of context and symbol with their bits.
    """
    levels = []
    for order in range(ORDER + 1):
        mask = np.uint32((1 << 8 * (order + 1)) - 1)
        runs, n, _ = _sums(grams & mask, counts)
        contexts, total, kinds = _sums(runs >> np.uint32(8), n)
        room = total + kinds
        escapes = np.log2(room / kinds)
        bits = np.log2(room[np.searchsorted(contexts, runs >> np.uint32(8))] / n)
        levels.append((contexts, escapes, runs, bits))
    return levels


def cost_table(model: dict) -> list[list[tuple[np.ndarray, ...]]]:
    """Code lengths of each language; they take memory for the runs that it has seen."""
    table = [code_lengths(grams, counts) for grams, counts in model["counts"]]
    give_back()
    return table


def _places(known: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where in ``asked`` values of ``known`` stand, and their places in ``known``."""
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    found = np.flatnonzero(known[at] == asked)
    return found, at[found]


def gram_costs(levels: list[tuple[np.ndarray, ...]], grams: np.ndarray) -> np.ndarray:
    """Bits of the last byte of each run of ``ORDER + 1`` bytes after those before it."""
    cost = np.full(len(grams), math.log2(SYMBOLS))
    for order, (contexts, escapes, runs, bits) in enumerate(levels):
        own = grams & np.uint32((1 << 8 * (order + 1)) - 1)
        found, at = _places(contexts, own >> np.uint32(8))
        cost[found] += escapes[at]
        found, at = _places(runs, own)
        cost[found] = bits[at]
    return cost


def text_costs(
    table: list[list[tuple[np.ndarray, ...]]], symbol: np.ndarray, data: np.ndarray, offs: np.ndarray
) -> np.ndarray:
    """Code length in bits of each whole text under each language."""
    out = np.zeros((len(offs) - 1, len(table)))
    for lo, hi in row_ranges(np.diff(offs), _CHUNK):
        buffer, starts, ends = joined(data, offs, lo, hi, _PAD)
        full = np.flatnonzero(ends > starts)
        if not len(full):
            continue
        s = symbol[buffer]
        grams = (s[:-3] << 24) | (s[1:-2] << 16) | (s[2:-1] << 8) | s[3:]
        distinct, place = np.unique(grams, return_inverse=True)
        bounds = np.stack([starts[full] - 3, ends[full] - 3], axis=1).ravel()
        for k, levels in enumerate(table):
            bits = np.append(gram_costs(levels, distinct)[place], 0.0)
            out[lo + full, k] = np.add.reduceat(bits, bounds)[::2]
    return out


def identify(docs: DataFrame, text: str, model: dict, carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``docs`` (all if not given) with ``lang_pred`` and ``score``.

    The predicted language codes the whole text in the fewest bits; ``score`` is its share of the
    probability that the code lengths imply.  Ties go to the first language by name.  A null text,
    an empty one and one without a letter get ``und`` and 0, and so does every text if nothing was
    learned.  Columns of these names that ``docs`` already has are replaced.
    """
    carry = [c for c in carry or docs.columns if c not in ("lang_pred", "score")]
    if not model["languages"]:
        return docs.select(*carry).withColumns(
            {"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)}
        )
    frozen = docs.sparkSession.sparkContext.broadcast(model)
    version = uuid.uuid4().hex

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state("language", large=True)
        if version not in state:
            state.clear()
            state[version] = cost_table(frozen.value)
        names = np.array([*frozen.value["languages"], UNDETERMINED], dtype=object)
        for batch in batches:
            data, offs = text_bytes(batch.column(text))
            bits = text_costs(state[version], frozen.value["symbol"], data, offs)
            least = bits.min(axis=1, keepdims=True)
            lettered = batch.column("_lettered").to_numpy(zero_copy_only=False).astype(bool)
            best = np.where(lettered, bits.argmin(axis=1), -1)
            share = np.where(lettered, 1.0 / np.exp2(least - bits).sum(axis=1), 0.0)
            columns = [batch.column(c) for c in carry]
            columns += [pa.array(names[best], pa.string()), pa.array(share)]
            yield pa.RecordBatch.from_arrays(columns, [*carry, "lang_pred", "score"])

    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_lettered")
    given = docs.select(*dict.fromkeys([*carry, text]), lettered)
    schema = StructType(list(docs.select(*carry).schema.fields))
    return given.mapInArrow(score, schema.add("lang_pred", "string").add("score", "double"))
