"""Mixing of sources to target weights by entropy balancing.  DataFrame functions only."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sumstone.llm.common import WORD, freeze, offsets_by_part, row_places

#: A target stops at this many times its source's size, and so does a document.
LIMIT = 3.0
#: Size classes per doubling, for the documents that may take up what rounding left over.
CLASSES = 8
NEWTON_STEPS = 100


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, source: str, size: str, limit: float = LIMIT) -> DataFrame:
    """``source, source_size, target``: one row a source.

    Sources in code point order, null last, weigh 1, 2, 3 and again; they share the total size by
    weight.  A target stops at ``limit`` times its source's size and the excess goes to the others by
    weight, until none is above: in order of how soon they fill up, a source is full if the level
    that the fuller ones leave would lift it over its limit.
    """
    totals = sized.groupBy(source).agg(F.sum(size).cast("double").alias("source_size"))
    ranked = totals.withColumns(
        {
            "_weight": ((F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1) % 3 + 1)
            .cast("double"),
            "_full": F.col("source_size") * limit,
            "_all": F.sum("source_size").over(Window.partitionBy()),
        }
    )
    by_need = Window.orderBy(F.col("_full") / F.col("_weight"), F.col(source).asc_nulls_last())
    earlier = by_need.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (F.col("_all") - F.coalesce(F.sum("_full").over(earlier), F.lit(0.0))) / (
        F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(earlier), F.lit(0.0))
    )
    filled = ranked.withColumn("_capped", F.col("_full") <= F.col("_weight") * level)
    open_weight = F.sum(F.when(~F.col("_capped"), F.col("_weight"))).over(whole)
    spent = F.coalesce(F.sum(F.when(F.col("_capped"), F.col("_full"))).over(whole), F.lit(0.0))
    share = F.col("_weight") * (F.col("_all") - spent) / open_weight
    target = F.when(F.col("_capped"), F.col("_full")).otherwise(share)
    return filled.select(source, F.col("source_size").cast("long").alias("source_size"), target.alias("target"))


def entropy_balance(
    cells: DataFrame, margins: list[str], tokens: str, targets: list[np.ndarray]
) -> list[np.ndarray]:
    """Multipliers of the margins: each cell's rate is the exponential of the sum of its own.

    ``cells`` has a row for each combination of margin values, given by their number from 0, with
    its tokens.  Among all rates that meet ``targets[m][v]``, the tokens that value ``v`` of margin
    ``m`` shall have, these stay nearest to 1 in relative entropy.  The convex dual, the sum of
    tokens times rate less the sum of multiplier times target, is solved by Newton steps: each is
    one aggregation over the cells that returns a slope for each margin value and a curvature for
    each pair of them, so the driver sees margin values, never documents.
    """
    edges = np.concatenate([[0], np.cumsum([len(t) for t in targets])]).astype(int)
    aim = np.concatenate(targets) if targets else np.zeros(0)
    dual = np.zeros(len(aim))
    places = [F.col(m) + int(e) for m, e in zip(margins, edges)]
    scale = max(1.0, float(np.abs(aim).max(initial=0.0)))
    for _ in range(NEWTON_STEPS):
        values = F.array(*[F.lit(float(x)) for x in dual])
        rate = F.exp(sum((F.element_at(values, p + 1) for p in places), F.lit(0.0)))
        pair = F.explode(F.array(*[F.struct(a.alias("i"), b.alias("j")) for a in places for b in places]))
        sums = (
            cells.select((F.col(tokens) * rate).alias("_tokens"), pair.alias("_pair"))
            .groupBy("_pair.i", "_pair.j").agg(F.sum("_tokens").alias("h")).collect()
        )
        curve = {(r["i"], r["j"]): r["h"] for r in sums}
        diagonal = np.array([curve.get((k, k), 0.0) for k in range(len(aim))])
        slope = np.where(diagonal > 0, aim - diagonal, 0.0)
        if np.abs(slope).max(initial=0.0) <= 1e-9 * scale:
            break
        if len(margins) == 1:  # margin values of one kind share no cell
            step = slope / np.where(diagonal > 0, diagonal, 1.0)
        else:
            full = np.zeros((len(aim), len(aim)))
            for (i, j), h in curve.items():
                full[i, j] = h
            step = np.linalg.lstsq(full, slope, rcond=1e-12)[0]
        dual += np.clip(step, -2.0, 2.0)
    return [dual[a:b] for a, b in zip(edges[:-1], edges[1:])]


def source_rates(sized: DataFrame, source: str, size: str, limit: float = LIMIT) -> DataFrame:
    """``source_targets`` with the rate of each source's documents."""
    targets = source_targets(sized, source, size, limit)
    place = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    cells = freeze(targets.withColumn("_value", place), "mix-sources")
    aim = {r[0]: r[1] for r in cells.select("_value", "target").collect()}  # one row a source
    aims = np.array([aim[k] for k in range(len(aim))])
    (dual,) = entropy_balance(cells, ["_value"], "source_size", [aims]) if len(aims) else ([],)
    values = F.array(*[F.lit(float(x)) for x in dual]).cast("array<double>")
    rate = F.least(F.exp(F.element_at(values, F.col("_value") + 1)), F.lit(limit))
    rates = cells.select(source, "source_size", "target", rate.alias("_rate"))
    return freeze(rates, "mix-rates")


def _draw(key: Column) -> Column:
    """A number from 0 to 1 for each key."""
    return F.pmod(F.xxhash64(key, F.lit("mix")), F.lit(1 << 40)) / F.lit(float(1 << 40))


def _copies_before(row: Column, key: Column) -> Column:
    """Copies of the rows before number ``row`` among those with one key and size.

    They follow the rate as closely as whole copies can; what the first row gets, too, is the rate
    rounded up with the chance of its fraction.
    """
    return F.floor(F.col("_rate") * row + _draw(key)).cast("long")


def mix(
    docs: DataFrame, key: str, source: str, size: Column, limit: float = LIMIT
) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies`` and ``taken`` (copies times size).

    Each source is taken at its rate, rounded to whole copies of documents by the hash of the key;
    rows with the same source, key and size are numbered and share the copies of all of them evenly.
    What that leaves of the target is then made up: of each size class one document may give or
    take a copy, and going down the sizes each one that still fits does.  No document is taken more
    than ``limit`` times.  The outcome depends on the rows only, so reruns agree; which of the rows
    alike in source, key and size gets a copy more does not matter.  A null source is a source, a
    null key a key; a document of size 0 is taken by its rate and adds nothing; an empty table gives
    an empty result.  The five columns replace such of ``docs``; other names may be any.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    packed = docs.select(
        F.struct(*kept).alias("_doc"),
        F.col(key).alias("_key"),
        F.col(source).alias("_source"),
        size.alias("_size"),
    )
    alike = ["_source", "_key", "_size"]
    groups = packed.groupBy(*alike).agg(F.count(F.lit(1)).alias("_rows"))
    groups = freeze(groups, "mix-sizes")
    rates = source_rates(groups.withColumn("_words", F.col("_size") * F.col("_rows")), "_source", "_words", limit)
    rows = _with_rates(groups, rates)
    rows = rows.withColumns(
        {
            "_copies": _copies_before(F.lit(1), F.col("_key")),
            "_all": _copies_before(F.col("_rows"), F.col("_key")),
        }
    )

    left = rows.groupBy("_source").agg(
        (F.first("target") - F.sum(F.col("_all") * F.col("_size"))).alias("_left")
    )
    sides = F.explode(
        F.array(
            F.when(F.col("_copies") + 1 <= limit, F.lit(1)), F.when(F.col("_copies") > 0, F.lit(-1))
        )
    )
    able = rows.filter(F.col("_size") > 0).select(*alike, sides.alias("_side"))
    able = able.filter(F.col("_side").isNotNull())
    rung = F.floor(F.log2("_size") * CLASSES)
    order = F.struct(F.xxhash64("_key").alias("h"), F.col("_key").alias("k"), F.col("_size").alias("s"))
    # The first of rows alike gives or takes the copy.
    picked = able.groupBy("_source", "_side", rung.alias("_rung")).agg(F.min(order).alias("_pick"))
    choice = F.struct(
        F.col("_pick.s").alias("_weight"), "_side", F.col("_pick.k").alias("_key"), F.col("_pick.s").alias("_size")
    )
    ladder = picked.groupBy(F.col("_source").alias("_of")).agg(
        F.sort_array(F.collect_list(choice), asc=False).alias("_ladder")
    )
    climbed = left.join(ladder, F.col("_source").eqNullSafe(F.col("_of"))).select(
        "_source", F.expr(_CLIMB).alias("_done")
    )
    moves = climbed.select("_source", F.explode("_done.moves").alias("_move")).select(
        "_source", F.col("_move._key").alias("_key"), F.col("_move._size").alias("_size"),
        F.col("_move._side").alias("_moved"),
    )
    moves = freeze(moves, "mix-moves")  # at most a row for each source and size class

    repeated = freeze(groups.filter("_rows > 1"), "mix-repeated")
    wide = join_alike(packed, repeated, alike, "left")
    single = wide.filter("_rows IS NULL").drop("_rows").withColumn("_nth", F.lit(0).cast("long"))
    numbered = _numbered(wide.filter("_rows IS NOT NULL").drop("_rows"), alike)
    out = join_alike(_with_rates(single.unionByName(numbered), rates), moves, alike, "left")
    own = _copies_before(F.col("_nth") + 1, F.col("_key")) - _copies_before(F.col("_nth"), F.col("_key"))
    moved = F.when(F.col("_nth") == 0, F.coalesce("_moved", F.lit(0))).otherwise(0)
    return out.select(
        "_doc.*", F.col("_size").alias("size"), "source_size", "target",
        (own + moved).cast("long").alias("copies"),
        ((own + moved) * F.col("_size")).cast("long").alias("taken"),
    )


def join_alike(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on equal ``keys``, null being equal to null; those of the left side stay."""
    renamed = right.withColumnsRenamed({k: f"_r{k}" for k in keys})
    met = F.lit(True)
    for k in keys:
        met = met & F.col(k).eqNullSafe(F.col(f"_r{k}"))
    return left.join(renamed, met, how).drop(*[f"_r{k}" for k in keys])


def _numbered(rows: DataFrame, alike: list[str]) -> DataFrame:
    """``rows`` with ``_nth``: their number from 0 among rows alike, however many those are.

    Rows are written with the task that held them and their place in it; a window sees the rows of
    one task only, and the counts of earlier tasks are added.
    """
    part, place = row_places()
    placed = freeze(rows.withColumns({"_part": part, "_seq": place}), "mix-rows")
    counts = placed.groupBy(*alike, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = offsets_by_part(counts, alike, "_n").drop("_n")
    here = Window.partitionBy(*alike, "_part").orderBy("_seq")
    local = placed.withColumn("_nth", (F.row_number().over(here) - 1).cast("long"))
    joined = join_alike(local, before, [*alike, "_part"], "left")
    return joined.withColumn("_nth", F.col("_nth") + F.col("_before")).drop("_part", "_seq", "_before")


#: Down the ladder of one source: a rung on the side that is missing is taken if it still fits.
_CLIMB = """
aggregate(_ladder,
  struct(cast(_left as double) as rest, filter(_ladder, r -> false) as moves),
  (acc, r) -> if(r._side * acc.rest >= r._weight,
    struct(acc.rest - r._side * r._weight as rest, concat(acc.moves, array(r)) as moves),
    acc))
"""


def _with_rates(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """``rows`` with the figures of their source; one row a source is small."""
    own = rates.withColumnRenamed("_source", "_own")
    return rows.join(own, F.col("_source").eqNullSafe(F.col("_own"))).drop("_own")
