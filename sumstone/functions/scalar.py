"""Scalar expressions: scores, flags, buckets, units, text, time and address arithmetic."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def product(*cols: str | Column) -> Column:
    """Product of columns, e.g. price times quantity."""
    out = _col(cols[0])
    for c in cols[1:]:
        out = out * _col(c)
    return out


def net_of_rate(amount: Column, rate: float) -> Column:
    """``amount`` less a constant rate; the factor is folded once by the optimizer."""
    return amount * (F.lit(1.0) - F.lit(rate))


def affine_score(col: Column, centre: float, factor: float) -> Column:
    """``(col - centre) * factor``."""
    return (col - F.lit(centre)) * F.lit(factor)


def two_way_flag(condition: Column, when_true: Any, when_false: Any) -> Column:
    """One of two constants; an unknown condition counts as false, as in a two-way ``where``."""
    return F.when(condition, F.lit(when_true)).otherwise(F.lit(when_false))


def zero_where(condition: Column, col: Column) -> Column:
    """``col`` with the rows that meet ``condition`` set to zero."""
    return F.when(condition, F.lit(0).cast("double")).otherwise(col)


def modulo_bucket(col: Column, n: int) -> Column:
    """Bucket number ``0 … n-1`` (never negative)."""
    return F.pmod(col, F.lit(n))


def year_of_date_key(date_key: Column) -> Column:
    """Year of an integer ``yyyymmdd`` key by integer division."""
    return F.floor(date_key / F.lit(10000)).cast("int")


def bytes_to_mib(col: Column) -> Column:
    return col / F.lit(1024) / F.lit(1024)


def bytes_to_gib(col: Column) -> Column:
    return bytes_to_mib(col) / F.lit(1024)


def contains_flag(col: Column, needle: str) -> Column:
    """1 if the upper-cased text contains ``needle`` literally, else 0 (8-bit integer)."""
    return F.upper(col).contains(needle).cast("tinyint")


def padded_code(prefix: str, number: Column, width: int = 10) -> Column:
    """``prefix`` plus the number padded with zeros to ``width`` digits."""
    return F.format_string(f"{prefix}%0{width}d", number)


def labelled(*parts: str | Column) -> Column:
    """Concatenation; plain strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def fixed_decimals(col: Column, digits: int) -> Column:
    """Number as text with exactly ``digits`` decimals and no grouping."""
    return F.format_string(f"%.{digits}f", col.cast("double"))


def pick(values: Sequence[Any], index: Column) -> Column:
    """Element of a constant list at ``index`` modulo its length."""
    position = F.pmod(index, F.lit(len(values))).cast("int") + F.lit(1)
    return F.element_at(F.array(*[F.lit(v) for v in values]), position)


def add_seconds(ts: Column, seconds: Column) -> Column:
    """Timestamp plus a whole number of seconds."""
    return ts + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def timestamp_from_seconds(seconds: Column) -> Column:
    """Zone-less timestamp that many seconds after 1970-01-01."""
    return add_seconds(F.expr(EPOCH_NTZ), seconds)


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970-01-01 of a timestamp or date column.

    For a zone-less timestamp the session time zone plays no part, so clock changes cannot shift
    or repeat an hour.
    """
    col = F.col(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("bigint") * F.lit(86_400_000_000)
    if isinstance(kind, T.TimestampNTZType):
        if df.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "Z"):
            return F.unix_micros(col.cast("timestamp"))  # same number, cheaper
        since = (col - F.expr(EPOCH_NTZ)).cast("decimal(18,6)")
        return (since * F.lit(1_000_000)).cast("bigint")
    raise TypeError(f"{name} is not a date or timestamp column")


def pack_ipv4(high_octet: int, rest: Column) -> Column:
    """IPv4 address as a number: first octet shifted left and or-ed with the other 24 bits."""
    return F.shiftleft(F.lit(high_octet).cast("bigint"), 24).bitwiseOR(rest.cast("bigint"))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
