"""Missing-value markers, tolerant casts, null rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain_names(df: DataFrame) -> DataFrame:
    """Replace dots in column names by underscores (``hours.per.week`` → ``hours_per_week``)."""
    names = [c.replace(".", "_") for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError("column names collide once dots are replaced")
    return df.toDF(*names)


def marker_to_null(df: DataFrame, marker: str = "?", columns: Sequence[str] | None = None) -> DataFrame:
    """Turn a missing-value marker into NULL in all text columns, or in the named ones."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    chosen = text if columns is None else [c for c in columns if c in text]
    return df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit(marker)) for c in chosen})


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop every row that holds a NULL (in ``columns``, by default anywhere)."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def without_marker(df: DataFrame, columns: Sequence[str], marker: str = "?") -> DataFrame:
    """Keep rows in which none of the columns is the marker; NULL does not pass, as in SQL."""
    for c in columns:
        df = df.filter(F.col(f"`{c}`") != F.lit(marker))
    return df


def tolerant_cast(df: DataFrame, columns: Sequence[str], to: str = "bigint") -> DataFrame:
    """Cast text columns; text that is no number becomes NULL instead of failing the job."""
    return df.withColumns({c: F.col(f"`{c}`").try_cast(to) for c in columns})


def clean_table(
    df: DataFrame,
    marker: str = "?",
    numeric: Sequence[str] = (),
) -> DataFrame:
    """Marker → NULL everywhere, rows with NULL dropped, then the numeric columns cast.

    The order matters: text that only fails the cast yields NULL but keeps its row.
    """
    return tolerant_cast(drop_null_rows(marker_to_null(plain_names(df), marker)), numeric)


def rows_before_after(df: DataFrame, marker: str = "?") -> DataFrame:
    """Row counts before and after :func:`clean_table` in one pass over the table."""
    marked = marker_to_null(plain_names(df), marker)
    complete = F.lit(True)
    for c in marked.columns:
        complete = complete & F.col(c).isNotNull()
    return marked.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(complete).alias("rows_after"),
    )
