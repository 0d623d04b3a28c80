"""Filters that reach the file scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def all_of(*conditions: Column) -> Column:
    """Conjunction of any number of conditions."""
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def on_or_after(df: DataFrame, column: str, day: dt.date | str) -> Column:
    """``column >= day`` written in the column's own type, so that it is pushed to the scan."""
    literal = day.isoformat() if isinstance(day, dt.date) else day
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.col(column) >= F.expr(f"TIMESTAMP_NTZ'{literal} 00:00:00'")
    if isinstance(kind, T.TimestampType):
        return F.col(column) >= F.expr(f"TIMESTAMP_LTZ'{literal} 00:00:00'")
    if isinstance(kind, T.StringType):
        return F.col(column).try_cast("date") >= F.expr(f"DATE'{literal}'")
    return F.col(column) >= F.expr(f"DATE'{literal}'")


def from_year(df: DataFrame, column: str, year: int) -> Column:
    """``year(column) >= year`` as a range on the column itself."""
    return on_or_after(df, column, f"{year:04d}-01-01")


def among(column: str, values: Sequence[Any]) -> Column:
    """Membership in a constant list."""
    return F.col(column).isin(list(values))


def keep(df: DataFrame, expression: str, names: Mapping[str, Any] | None = None) -> DataFrame:
    """Filter by an expression string; ``names`` fills ``{placeholders}`` in it as literals."""
    values = {k: _sql_literal(v) for k, v in (names or {}).items()}
    return df.filter(expression.format(**values) if values else expression)


def _sql_literal(value: Any) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP_NTZ'{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE'{value.isoformat()}'"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"
