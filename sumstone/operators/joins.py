"""Equi-joins: star joins, look-ups, membership in a computed set, key checks.

No function here hints a broadcast for a side of unknown size; one whose few rows were counted is.  Spark compares file statistics and,
at run time, the bytes really written with ``spark.sql.autoBroadcastJoinThreshold``; a side beyond
it goes through a shuffled join whose hot partitions adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sumstone.operators.ordered import same_keys, small_or_lazy


class DuplicateKeyError(ValueError):
    """The look-up side of a many-to-one join has a key twice."""


def star_join(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Inner-join a fact table with ``(dimension, fact key, dimension key)`` triples.

    Keys of different integer width are widened by the join itself.  The dimension key is dropped
    when its name differs from the fact key's.
    """
    for dim, fact_key, dim_key in dimensions:
        if fact_key == dim_key:
            fact = fact.join(dim, fact_key)
        else:
            key = f"_key_{dim_key}"
            named = dim.withColumnRenamed(dim_key, key)
            fact = fact.join(named, F.col(fact_key) == F.col(key)).drop(key)
    return fact


#: Integer types and their width.
_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def _comparable(left: DataFrame, right: DataFrame, a: str, b: str) -> tuple[Column, Column]:
    """Both keys in one type, so that equal keys have equal hashes."""
    if all(df.schema[k].dataType.simpleString() in _BITS for df, k in ((left, a), (right, b))):
        return F.col(a).cast("bigint"), F.col(b).cast("bigint")
    return F.col(a), F.col(b)


def within_keys(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose key lies between the smallest and the largest key left in ``dim``.

    A job over the dimension finds both ends (one row), which enter the plan as literals: they are
    pushed to the scan, and Parquet skips the row groups outside.  An inner join with ``dim`` gives
    the same rows with and without it.
    """
    kind = fact.schema[fact_key].dataType
    least, most = dim.agg(F.min(dim_key), F.max(dim_key)).first()
    if least is None:
        return fact.filter(F.lit(False))
    name = kind.simpleString()
    if name in _BITS and isinstance(least, int):
        # A key beyond the type of the fact key has no partner: the nearest value only keeps more.
        far = (1 << (_BITS[name] - 1)) - 1
        least, most = (max(min(end, far), -far - 1) for end in (least, most))
    return fact.filter(F.col(fact_key).between(F.lit(least).cast(kind), F.lit(most).cast(kind)))


def maybe_in_keys(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, bits: int = 1 << 20
) -> DataFrame:
    """Fact rows whose key may be in ``dim``: a Bloom filter, tested before anything is shuffled.

    Two bits a key in a field of ``bits``, whatever the size of the dimension; ten bits a key keep
    one foreign key in thirty.  A full field keeps every row and costs only its test.  The field is
    built by an aggregation of the dimension and enters the plan as a scalar subquery.
    """
    own, other = _comparable(fact, dim, fact_key, dim_key)
    words = bits // 64

    def probes(key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(64 * words)) for salt in (1, 2)]

    places = dim.filter(F.col(dim_key).isNotNull()).select(F.explode(F.array(*probes(other))).alias("_p"))
    one = F.lit(1).cast("bigint")
    bit = F.call_function("shiftleft", one, F.pmod("_p", F.lit(64)).cast("int"))
    marked = places.select(F.floor(F.col("_p") / 64).alias("_word"), bit.alias("_bits"))
    blank = dim.sparkSession.range(words).select(F.col("id").alias("_word"), F.lit(0).cast("bigint").alias("_bits"))
    field = marked.unionByName(blank).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    field = field.agg(F.sort_array(F.collect_list(F.struct("_word", "_bits"))).alias("_field"))
    field = field.select(F.col("_field._bits").alias("_field")).scalar()
    keep = F.col(fact_key).isNotNull()
    for p in probes(own):
        word = F.get(field, F.floor(p / 64).cast("int"))
        keep = keep & (F.getbit(word, F.pmod(p, F.lit(64)).cast("int")) == 1)
    return fact.filter(keep)


def grouped_by_attributes(
    fact: DataFrame,
    dimensions: Sequence[tuple[DataFrame, str, str, Sequence[str]]],
    keys: Sequence[str],
    aggregates: dict[str, Column],
    through: tuple[DataFrame, str, str] | None = None,
    measures: Sequence[str] = (),
) -> DataFrame:
    """Aggregates by columns of the fact table and attributes of ``(dimension, fact key, key, attributes)``.

    Each combination of attributes is stood for by the smallest dimension key that has it (and a
    number, where a key has several).  Facts are grouped by these numbers, so the large shuffle
    carries no names, and names are attached to the groups: one aggregation, also where several keys
    share a name.  Rows are those of the inner
    joins; a key that a dimension repeats counts once for each.

    ``through`` is a dimension ``(dimension, fact key, key)`` with keys of others, which meet it
    before the facts do and so move fewer rows.  ``measures`` are columns of the dimensions that
    ``aggregates`` use.
    """
    codes, names, direct = [], [], []
    head = through[0] if through else None
    for i, (dim, fact_key, dim_key, attributes) in enumerate(dimensions):
        code, nth, key = f"_code{i}", f"_nth{i}", f"_key{i}"
        same_key = Window.partitionBy(code).orderBy(*attributes)
        named = dim.groupBy(*attributes).agg(F.min(dim_key).alias(code))
        named = named.withColumn(nth, F.row_number().over(same_key))
        renamed = named.withColumnsRenamed({a: f"_of{i}_{a}" for a in attributes})
        same = F.lit(True)
        for a in attributes:
            same = same & F.col(a).eqNullSafe(F.col(f"_of{i}_{a}"))
        kept = [m for m in measures if m in dim.columns]
        coded = dim.join(renamed, same).select(F.col(dim_key).alias(key), code, nth, *kept)
        if through and fact_key in head.columns:
            head = head.join(coded, F.col(fact_key) == F.col(key)).drop(key)
        else:
            direct.append((coded, fact_key, key))
        codes.append([code, nth])
        names.append(named)
    if through:
        fact = star_join(fact, [(head, *through[1:])])
    fact = star_join(fact, direct)
    flat = [c for pair in codes for c in pair]
    totals = fact.groupBy(*keys, *flat).agg(*[c.alias(n) for n, c in aggregates.items()])
    for pair, named in zip(codes, names):
        totals = totals.join(named, pair)
    attributes = [a for _, _, _, some in dimensions for a in some]
    return totals.select(*keys, *attributes, *aggregates)


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise :class:`DuplicateKeyError` if any key occurs more than once.

    Counts are combined before the shuffle and one offending key at most reaches the driver.
    """
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").take(1)
    if twice:
        key = {k: twice[0][k] for k in keys}
        raise DuplicateKeyError(f"not a many-to-one join: {key} occurs {twice[0]['_n']} times")


def lookup(
    left: DataFrame, right: DataFrame, keys: Sequence[str], check_unique: bool = True
) -> DataFrame:
    """Left outer join that keeps every left row once and one copy of the key columns."""
    if check_unique:
        require_unique(right, keys)
    return left.join(right, list(keys), "left")


def hot_key_lookup(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`lookup` for a left side with very frequent keys, NULL among them.

    A right side of at most 10,000 rows is broadcast, and no left row moves.  Beyond that, rows with
    a NULL key match nothing and are not shuffled; the shuffled join of the others leaves hot
    partitions to adaptive execution, which splits them against the one right row of a key.
    """
    require_unique(right, keys)
    keys, right = list(keys), small_or_lazy(right)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    joined = left.na.drop("any", subset=keys).join(right, keys, "left")
    return joined.unionByName(left.filter(missing), allowMissingColumns=True)


def in_top(df: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is among the rows of a top-k frame, which carries its own k."""
    return df.join(top.select(key), key, "left_semi")


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose non-null key has no partner in the dimension."""
    keyed = fact.filter(F.col(fact_key).isNotNull())
    return keyed.join(dim.select(dim_key), keyed[fact_key] == dim[dim_key], "left_anti")


def null_safe_lookup(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which a NULL key meets a NULL key."""
    out = left.join(right, same_keys(left, right, keys), "left")
    for k in keys:
        out = out.drop(right[k])
    return out
