"""Exact Jaccard join of word shingles by signature trees.

Documents with one set of shingles are one class.  A forest of signature trees is planted over the
classes: the shingles of a set are dealt to so many hash classes that, if two sets are similar
enough, at least one hash class holds the same shingles in both.  Classes that agree in one meet in
one tree; in it, nodes carry the OR of their members' token bitmaps and the range of their sizes,
and a traversal of node pairs leaves out those that cannot overlap enough.  What remains is
compared shingle by shingle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sumstone.llm.common import (
    freeze,
    frozen,
    joined,
    lower_ascii,
    mixed,
    range_hashes,
    row_ranges,
    text_bytes,
    word_ranges,
    worker_state,
)
from sumstone.llm.graph import components

#: Shingles in one tree, about; a larger family of candidates is cut.
TREE = 1 << 21
#: Bits of a token bitmap, and children of a node.
BITS = 2048
FANOUT = 16
#: Chance that a pair at the threshold shares no hash class that counts.
MISS = 1e-10

#: Most shingles that a hash class must hold to count, and what that may cost in signatures.
MOST_LEAST = 6
EFFORT = 1.2
#: Bits of the filter that keeps most texts without a candidate from being moved.
FILTER = 1 << 26
#: Commonest shingles of large families that are kept in memory, at most.
COMMON = 1 << 18

_CHUNK = 1 << 20


def shingles(
    data: np.ndarray, offs: np.ndarray, lo: int, hi: int, words: int
) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingles of the rows ``lo`` to ``hi`` and their bounds by row."""
    buffer, _, ends = joined(data, offs, lo, hi, b" ")
    buffer = lower_ascii(buffer)
    first, last = word_ranges(buffer)
    word = range_hashes(buffer, first, last)
    row = np.searchsorted(ends, first, "right")
    count = np.bincount(row, minlength=hi - lo)
    begin = np.cumsum(count) - count
    out: list[np.ndarray] = []
    with np.errstate(over="ignore"):
        whole = np.zeros(max(0, len(word) - words + 1), np.uint64)
        for k in range(words):
            whole = (whole + word[k : k + len(whole)]) * np.uint64(0x9FB21C651E98DF25)
            whole ^= whole >> np.uint64(28)
        whole = mixed(whole)
        for n, at in zip(count, begin):
            if n >= words:
                out.append(np.unique(whole[at : at + n - words + 1]))
            elif n:
                short = np.uint64(n)
                for h in word[at : at + n]:
                    short = (short + h) * np.uint64(0xD1342543DE82EF95)
                    short ^= short >> np.uint64(29)
                out.append(mixed(np.array([short])))
            else:
                out.append(np.zeros(0, np.uint64))
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in out])])
    return np.concatenate(out) if out else np.zeros(0, np.uint64), bounds


def digest(hashes: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that tell sets apart."""
    with np.errstate(over="ignore"):
        a = mixed(hashes ^ np.uint64(0x51)).sum(dtype=np.uint64)
        b = mixed(hashes + np.uint64(0xA7C15)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _step(num: int, den: int) -> float:
    """Logarithm of the ratio of bracket borders: the cube of the least ratio of similar sizes, or
    less where that would make brackets wide."""
    return min(3 * math.log(den / num), math.log(1.4))


def bracket_plan(number: int, num: int, den: int) -> tuple[int, int, int]:
    """``_bracket_plan``, worked out once a worker."""
    known = worker_state("brackets")
    key = (number, num, den, MISS, MOST_LEAST, EFFORT)
    if key not in known:
        known[key] = _bracket_plan(number, num, den)
    return known[key]


def _bracket_plan(number: int, num: int, den: int) -> tuple[int, int, int]:
    """Hash classes of a size bracket, how often shingles are dealt to them, and how many shingles a
    class must hold to count.

    Two sets of a bracket that link differ in ``d`` shingles at most.  Each of ``m`` classes stays
    clear of them with the chance ``(1 - 1/m)^d``, and then holds the same shingles in both sets.
    A class with few shingles says little: sets that only share a passage agree in it, too.  So the
    largest least content is taken for which signatures cost at most ``EFFORT`` times what they cost
    without one, at a chance of at most ``MISS`` that a pair at the threshold shares none that count.
    Small sets are dealt anew until that holds; with more classes than differences one is clear for
    certain.
    """
    step = _step(num, den)
    most = math.floor(math.exp(step * (number + 1))) + 1
    fewest = max(1, math.floor(math.exp(step * number)) * num // den)
    differ = 2 * most * (den - num) // (den + num)

    def rounds(m: int, least: int) -> int:
        poor = sum(
            math.comb(fewest, k) * (1 / m) ** k * (1 - 1 / m) ** (fewest - k) for k in range(least)
        )
        lost = (1 - (1 - 1 / m) ** differ * max(0.0, 1 - poor)) ** m
        if m > differ:
            lost = min(lost, m * poor)
        return math.ceil(math.log(MISS) / math.log(min(max(lost, 1e-300), 1 - 1e-12)))

    options = sorted({max(1, round((differ + 1) * k / 24)) for k in range(2, 25)})
    plans = [
        (m * often, m, int(often), least)
        for least in range(1, min(MOST_LEAST, fewest) + 1)
        for m in options
        if (often := rounds(m, least)) < 40
    ]
    if not plans:  # sets of one or two shingles
        return differ + 1, 40, 1
    bound = EFFORT * min(p[0] for p in plans if p[3] == 1) if any(p[3] == 1 for p in plans) else math.inf
    cost, classes, often, least = max(
        (p for p in plans if p[0] <= bound), key=lambda p: (p[3], -p[0])
    )
    return classes, often, least


def brackets(size: int, num: int, den: int) -> list[int]:
    """Numbers of the size brackets in which a set of ``size`` meets others.

    A set meets those of its own bracket, and those of the next one if it is large enough for the
    smallest there.
    """
    step = _step(num, den)
    own = int(math.log(size) / step + 1e-9)
    least = math.floor(math.exp(step * (own + 1))) - 1
    return [own, own + 1] if size * den >= num * least else [own]


def signatures(hashes: np.ndarray, num: int, den: int) -> np.ndarray:
    """Digests of the hash classes of a set that count, in each bracket in which it meets others."""
    out = []
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32)
    for number in brackets(len(hashes), num, den):
        classes, often, least = bracket_plan(number, num, den)
        for turn in range(often):
            deal = mixed(hashes + np.uint64(turn * 0x9E3779B9 + 1)) % np.uint64(classes)
            deal = deal.astype(np.int64)
            held = np.bincount(deal, minlength=classes)
            sums = [np.bincount(deal, weights=h.astype(np.float64), minlength=classes) for h in (low, high)]
            full = np.flatnonzero(held >= least)
            with np.errstate(over="ignore"):
                sig = sums[0][full].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
                sig = mixed(sig ^ sums[1][full].astype(np.uint64))
                place = (number << 44) + (turn << 32) + full
                out.append(mixed(sig + place.astype(np.uint64) * np.uint64(0x165667B19E3779F9)))
    return np.unique(np.concatenate(out)).view(np.int64) if out else np.zeros(0, np.int64)


def class_rows(
    docs: DataFrame, key: str, text: str, words: int, num: int, den: int, signed: bool
) -> DataFrame:
    """``key, n, d1, d2`` of each whole text, and its signatures ``sigs`` if they are asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("similarity", large=True)  # tables of earlier stages go
        for batch in batches:
            data, offs = text_bytes(batch.column(text))
            for lo, hi in row_ranges(np.diff(offs), _CHUNK):
                values, bounds = shingles(data, offs, lo, hi, words)
                sets = [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
                pairs = np.array([digest(s) for s in sets], np.int64).reshape(-1, 2)
                used = sets if signed else []
                sigs = [signatures(s, num, den) if len(s) else np.zeros(0, np.int64) for s in used]
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sigs])]).astype(np.int32)
                columns = [
                    batch.column(key).slice(lo, hi - lo),
                    pa.array(np.diff(bounds)),
                    pa.array(pairs[:, 0]),
                    pa.array(pairs[:, 1]),
                ]
                if signed:
                    columns.append(pa.ListArray.from_arrays(ends, np.concatenate(sigs)))
                names = [key, "n", "d1", "d2", "sigs"]
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    schema = f"{key} {docs.schema[key].dataType.simpleString()}, n long, d1 long, d2 long"
    return docs.select(key, text).mapInArrow(run, schema + ", sigs array<long>" * signed)


class _Tree:
    """Sets in order of size, their bitmaps, and the nodes above them."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i][:4].tobytes()))
        self.sets = [sets[i] for i in self.order]
        maps = np.zeros((len(sets), BITS // 64), np.uint64)
        for i, s in enumerate(self.sets):
            bit = (s & np.uint64(BITS - 1)).astype(np.int64)
            flags = np.zeros(BITS, bool)
            flags[bit] = True
            maps[i] = np.packbits(flags, bitorder="little").view(np.uint64)
        size = np.array([len(s) for s in self.sets], np.int64)
        spare = size - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        self.levels = [(maps, size, size, spare)]
        while len(self.levels[-1][0]) > FANOUT:
            maps, least, most, spare = self.levels[-1]
            cuts = np.arange(0, len(maps), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(maps, cuts, axis=0),
                    np.minimum.reduceat(least, cuts),
                    np.maximum.reduceat(most, cuts),
                    np.maximum.reduceat(spare, cuts),
                )
            )

    def possible(self, level: int, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
        """Whether a member of ``a`` and one of ``b`` may overlap enough to link.

        They share at most the bits that both bitmaps have, and of the shingles beyond one a bit as
        many as the fuller bitmap hides; and no more than the smaller of them holds.
        """
        maps, least, most, spare = self.levels[level]
        common = np.bitwise_count(maps[a] & maps[b]).sum(axis=1, dtype=np.int64)
        overlap = np.minimum(common + np.minimum(spare[a], spare[b]), np.minimum(most[a], most[b]))
        return overlap * (num + den) >= num * (least[a] + least[b])


def _linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * den >= num * (len(a) + len(b) - both)


def tree_roots(
    sets: list[np.ndarray], num: int, den: int, root: np.ndarray, centre: int = 0
) -> np.ndarray:
    """Root of each set after joining all that link; ``root`` holds what is joined already.

    Links between sets that are joined already would tell nothing new and are not looked for.
    """
    tree = _Tree(sets)
    place = np.empty(len(sets), np.int64)
    place[tree.order] = np.arange(len(sets))
    _, first = np.unique(root, return_index=True)
    renamed = dict(zip(root[first].tolist(), first.tolist()))
    root = np.array([place[renamed[r]] for r in root.tolist()])[tree.order]

    def try_pairs(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal root
        keep = (root[a] != root[b]) & (a != b)
        a, b = a[keep], b[keep]
        keep = tree.possible(0, a, b, num, den)
        for i, j in zip(a[keep].tolist(), b[keep].tolist()):
            if root[i] != root[j] and _linked(tree.sets[i], tree.sets[j], num, den):
                root = np.where(root == max(root[i], root[j]), min(root[i], root[j]), root)

    everyone = np.arange(len(sets))
    try_pairs(np.full(len(sets), place[centre]), everyone)

    def descend(level: int, a: np.ndarray, b: np.ndarray) -> None:
        keep = tree.possible(level, a, b, num, den)
        a, b = a[keep], b[keep]
        if level == 0:
            try_pairs(a, b)
            return
        cuts = np.arange(0, len(root), FANOUT**level)
        low, high = np.minimum.reduceat(root, cuts), np.maximum.reduceat(root, cuts)
        apart = (low[a] != high[a]) | (low[b] != high[b]) | (low[a] != low[b])
        a, b = a[apart], b[apart]
        below, child = len(tree.levels[level - 1][0]), np.arange(FANOUT)
        for at in range(0, len(a), 64):  # many node pairs at once
            x = (a[at : at + 64, None] * FANOUT + child)[:, :, None]
            y = (b[at : at + 64, None] * FANOUT + child)[:, None, :]
            x, y = (v.ravel() for v in np.broadcast_arrays(x, y))
            once = (x <= y) & (y < below)
            descend(level - 1, x[once], y[once])

    top = len(tree.levels) - 1
    nodes = np.arange(len(tree.levels[top][0]))
    x, y = np.repeat(nodes, len(nodes)), np.tile(nodes, len(nodes))
    descend(top, x[x <= y], y[x <= y])
    back = np.empty(len(sets), np.int64)
    back[tree.order] = np.array(tree.order)[root]
    return back


def _plant(words: int, num: int, den: int, text: str):
    """Function of one tree: rows ``node, joined, text`` to ``node, root`` of those that link."""

    def run(tree: pa.Table) -> pa.Table:
        worker_state("similarity", large=True)  # tables of earlier stages go
        data, offs = text_bytes(tree.column(text))
        sets = []
        for lo, hi in row_ranges(np.diff(offs), _CHUNK):
            values, bounds = shingles(data, offs, lo, hi, words)
            sets += [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        node = tree.column("node").to_numpy()
        known = tree.column("joined").to_numpy()
        root = tree_roots(sets, num, den, known, int(node.argmin()))
        return pa.table({"node": node, "root": node[root]})

    return run


def near_groups(
    docs: DataFrame, key: str, text: str, words: int, num: int, den: int, tree: int = TREE
) -> DataFrame:
    """``key, n_shingles, component_id``: groups of documents that links connect.

    Two documents link when ``den`` times the shingles they share is at least ``num`` times those
    that either has.  ``component_id`` is the smallest key of a group.  A document without words is
    linked with nothing; a null text has none.  Repeated rows and equal texts are one class and are
    not compared with each other.  Null keys take part, but are never a group's smallest key unless
    it has no other.  No pairs are returned and no group is held whole by a task: candidates are
    joined by the smallest member of each hash class, large families of candidates are parted by
    their rarest shingles, what is still large is cut into trees of about ``tree`` shingles, and only
    members that are not yet joined visit the other trees.
    """
    # Signatures are worth more disk than the second reading of the texts that they cost here.
    rows = freeze(class_rows(docs, key, text, words, num, den, False), "shingles")
    signed = class_rows(docs, key, text, words, num, den, True)
    classes = signed.filter("n > 0").groupBy("d1", "d2", "n").agg(
        F.min(key).alias("_first"), F.first("sigs").alias("sigs")
    )
    with frozen(classes.withColumn("node", F.monotonically_increasing_id()), "signed") as signed:
        classes = freeze(signed.drop("sigs"), "classes")
        stars = _stars(signed.select("node", F.explode("sigs").alias("sig")))
        family = components(stars, "node", "centre").withColumnRenamed("root", "family")
    members = freeze(_with_trees(classes.join(family, "node"), tree), "families")
    crowded = members.filter("trees > 1")
    crowd = None
    if crowded.limit(1).count():
        crowd = freeze(_texts_of(docs, crowded, key, text, words), "crowd")
        met = _rarest(crowd, text, words, num, den)
        family = components(_stars(met), "node", "centre").withColumnRenamed("root", "family")
        parted = _with_trees(crowded.drop("family", "trees").join(family, "node"), tree)
        members = freeze(members.filter("trees = 1").unionByName(parted), "parted")

    plant = _plant(words, num, den, text)
    own_tree = F.pmod(F.xxhash64("node"), F.col("trees"))
    everywhere = F.sequence(F.lit(0).cast("long"), F.col("trees") - 1)
    spots = F.when(F.col("node") == F.col("family"), everywhere).otherwise(F.array(own_tree))
    texts = _texts_of(docs, members, key, text, words)
    placed = texts.select("family", F.explode(spots).alias("tree"), "node", text)
    placed = placed.withColumn("joined", F.col("node"))
    links = placed.groupBy("family", "tree").applyInArrow(plant, "node long, root long")
    links = freeze(links.filter("node <> root"), "links")

    crowded = members.filter("trees > 1").select("node", "family", "trees")
    if crowd is not None and crowded.limit(1).count():
        crowd = crowd.select("node", text).join(crowded, "node")
        links = links.unionByName(_visits(crowd, links, plant, text, tree))
    roots = components(links, "node", "root")

    named = classes.join(roots, "node", "left").select(
        "d1", "d2", "n", "_first", F.coalesce("root", "node").alias("root")
    )
    least = named.groupBy("root").agg(F.min("_first").alias("component_id"))
    named = freeze(named.join(least, "root").select("d1", "d2", "n", "component_id"), "named")
    out = rows.select(key, "n", "d1", "d2").join(named, ["d1", "d2", "n"], "left")
    # Without shingles a document is its own group.
    found = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col(key))
    return out.select(key, F.col("n").alias("n_shingles"), found.alias("component_id"))


def _stars(met: DataFrame) -> DataFrame:
    """``node, centre``: who shares a signature, and the smallest node that has it.

    Rows ``node, sig`` move once: a count of each signature and a join would move them twice.
    """
    centre = F.min("node").over(Window.partitionBy("sig"))
    stars = met.withColumn("centre", centre).filter("node <> centre")
    return stars.select("node", "centre").distinct()


def _with_trees(members: DataFrame, tree: int) -> DataFrame:
    """``members`` with the number of trees that the shingles of their family need."""
    weight = members.groupBy("family").agg(F.sum("n").alias("_w"))
    trees = F.ceil(F.col("_w") / tree).cast("long").alias("trees")
    return members.join(weight.select("family", trees), "family")


def _rarest(crowd: DataFrame, text: str, words: int, num: int, den: int) -> DataFrame:
    """``node, sig``: the rarest shingles of each set, so many that sets which link share one.

    Sets of ``n`` shingles that link share ``n * num / den`` at least.  In any one order of all
    shingles the smallest that they share is then among the first ``n - n * num / den + 1`` of
    both.  Common shingles come last in it, so sets that only share a passage do not meet.
    """
    common, counts = _common(crowd, text, words)
    shared = crowd.sparkSession.sparkContext.broadcast((common, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("similarity", large=True)  # tables of earlier stages go
        common, counts = shared.value
        for batch in batches:
            data, offs = text_bytes(batch.column(text))
            node = batch.column("node").to_numpy()
            family = mixed(batch.column("family").to_numpy().view(np.uint64))
            for lo, hi in row_ranges(np.diff(offs), _CHUNK):
                values, bounds = shingles(data, offs, lo, hi, words)
                rank = np.zeros(len(values), np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, values), len(common) - 1)
                    rank = np.where(common[at] == values, counts[at], 0)
                sigs = [np.zeros(0, np.uint64)]
                for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]), lo):
                    first = (b - a) - -(-(b - a) * num // den) + 1
                    rarest = np.argsort(rank[a:b], kind="stable")[:first]
                    sigs.append(mixed(values[a:b][rarest] ^ family[i]))
                nodes = np.repeat(node[lo:hi], [len(s) for s in sigs[1:]])
                sig = np.concatenate(sigs).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(sig)], ["node", "sig"])

    return crowd.select("node", "family", text).mapInArrow(run, "node long, sig long")


def _common(crowd: DataFrame, text: str, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles that many sets hold, ``COMMON`` at most, and about how many sets do.

    Each task counts what comes again within about a megabyte of texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("similarity", large=True)  # tables of earlier stages go
        for batch in batches:
            data, offs = text_bytes(batch.column(text))
            for lo, hi in row_ranges(np.diff(offs), _CHUNK):
                values, counts = np.unique(shingles(data, offs, lo, hi, words)[0], return_counts=True)
                again = counts > 1
                columns = [pa.array(values[again].view(np.int64)), pa.array(counts[again])]
                yield pa.RecordBatch.from_arrays(columns, ["shingle", "c"])

    counted = crowd.select(text).mapInArrow(run, "shingle long, c long")
    counted = counted.groupBy("shingle").agg(F.sum("c").alias("c"))
    level = F.floor(F.log2("c")).alias("level")
    with frozen(counted, "counted") as counted:
        held, least = 0, 64
        for row in sorted(counted.groupBy(level).count().collect(), reverse=True):  # 64 at most
            held += row["count"]
            if held > COMMON:
                break
            least = row["level"]
        found = counted.filter(level >= least).toArrow()
    common = found.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(common)
    return common[order], found.column("c").to_numpy()[order]


def _texts_of(docs: DataFrame, members: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """One text for each member class, found by its digest among the rows with a first key.

    Digests are computed before anything is joined, so that rows which share a key do not meet each
    other's classes, and rows of one class become one before they move.  Keys are looked up in the
    same function: with one before it, each task would take two workers and their memory.
    """
    shared = _key_bitmap(members.select("_first"))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("similarity", large=True)  # tables of earlier stages go
        for batch in batches:
            maybe = _in_bitmap(shared.value, batch.column("_hash").to_numpy())
            given = batch.column(text).filter(pa.array(maybe))
            data, offs = text_bytes(given)
            for lo, hi in row_ranges(np.diff(offs), _CHUNK):
                values, bounds = shingles(data, offs, lo, hi, words)
                sets = [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
                pairs = np.array([digest(s) for s in sets], np.int64).reshape(-1, 2)
                columns = [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(np.diff(bounds))]
                columns.append(given.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays(columns, ["d1", "d2", "n", text])

    hashed = docs.select(F.xxhash64(key).alias("_hash"), text)
    found = hashed.mapInArrow(told, f"d1 long, d2 long, n long, {text} string")
    found = found.groupBy("d1", "d2", "n").agg(F.first(text).alias(text))
    found = found.join(members.select("node", "family", "trees", "d1", "d2", "n"), ["d1", "d2", "n"])
    return found.select("node", "family", "trees", text)


def _key_bitmap(keys: DataFrame):
    """One bit a key in a bitmap of fixed size, built where the keys are; to be read by tasks."""
    bit = F.pmod(F.xxhash64(*keys.columns), F.lit(FILTER))
    flag = F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 32).cast("int"))
    word = keys.select(F.shiftright(bit, 5).alias("w"), flag.alias("b"))
    words = word.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()  # at most FILTER / 32 rows
    bitmap = np.zeros(FILTER // 32, np.uint32)
    bitmap[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return keys.sparkSession.sparkContext.broadcast(bitmap)


def _in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes.astype(np.int64) % FILTER
    return bitmap[at >> 5] >> (at & 31).astype(np.uint32) & 1 == 1


def key_filter(keys: DataFrame):
    """Function of a key's hash: false only if the key is not among ``keys``.

    With very many keys the bitmap lets more through; the join after it decides.
    """
    shared = _key_bitmap(keys)

    @F.pandas_udf("boolean")
    def maybe(hashes: pd.Series) -> pd.Series:
        return pd.Series(_in_bitmap(shared.value, hashes.to_numpy(np.int64)))

    return maybe


def _visits(crowd: DataFrame, links: DataFrame, plant, text: str, tree: int) -> DataFrame:
    """Links between the trees of a family: who is not in its largest group visits each other tree.

    What is known of a family has one row for each with over ``tree`` shingles and is broadcast: to
    meet it by family would bring all trees of a family to one task.
    """
    roots = components(links, "node", "root").withColumnRenamed("root", "joined")
    crowd = crowd.join(roots, "node", "left").withColumn("joined", F.coalesce("joined", "node"))
    home = F.pmod(F.xxhash64("node"), F.col("trees"))
    crowd = freeze(crowd.withColumn("home", home), "crowd-joined")
    sizes = crowd.groupBy("family", "joined").count()
    largest = sizes.groupBy("family").agg(F.max_by("joined", F.struct("count", "joined")).alias("largest"))
    guests = crowd.join(F.broadcast(largest), "family").filter("joined <> largest").drop("largest")
    load = guests.groupBy("family").agg(F.sum(F.length(text)).alias("_chars"))
    blocks = F.ceil(F.col("_chars") / (4 * tree)).cast("long").alias("blocks")
    load = F.broadcast(load.select("family", F.greatest(blocks, F.lit(1)).alias("blocks")))
    columns = ["family", "tree", "block", "node", "joined", text]
    hosts = crowd.join(load, "family").select(
        "family", F.col("home").alias("tree"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        "node", "joined", text,
    )
    others = F.array_remove(F.sequence(F.lit(0).cast("long"), F.col("trees") - 1), F.col("home"))
    visits = guests.join(load, "family").select(
        "family", F.explode(others).alias("tree"),
        F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).alias("block"),
        "node", "joined", text,
    )
    met = hosts.select(*columns).unionByName(visits.select(*columns))
    found = met.groupBy("family", "tree", "block").applyInArrow(plant, "node long, root long")
    return found.filter("node <> root")
