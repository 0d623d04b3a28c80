"""Calendar and fiscal attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fiscal_year(date: Column, first_month: int) -> Column:
    """Year in which the fiscal year that contains ``date`` ends."""
    return F.year(date) + (F.month(date) >= F.lit(first_month)).cast("int")


def fiscal_month(date: Column, first_month: int) -> Column:
    """1 for the first month of the fiscal year … 12 for the last."""
    return F.pmod(F.month(date) - F.lit(first_month), F.lit(12)) + F.lit(1)


def date_key(date: Column) -> Column:
    """Integer ``yyyymmdd``."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def calendar_columns(date: Column) -> dict[str, Column]:
    """All attributes of the calendar dimension, by output name."""
    upper_flag = lambda c: F.when(c, F.lit("TRUE")).otherwise(F.lit("FALSE"))
    return {
        "DateID": date_key(date),
        "CalendarDate": date,
        "CalendarYear": F.year(date),
        "CalendarMonth": F.date_format(date, "MMMM"),
        "MonthOfYear": F.month(date),
        "CalendarDay": F.date_format(date, "EEEE"),
        "DayOfWeek": F.dayofweek(date),
        "DayOfWeekStartMonday": F.weekday(date),
        "IsWeekDay": upper_flag(F.weekday(date) < 5),
        "DayOfMonth": F.dayofmonth(date),
        "IsLastDayOfMonth": upper_flag(date == F.last_day(date)),
        "DayOfYear": F.dayofyear(date),
        "WeekOfYearIso": F.weekofyear(date),
        "QuarterOfYear": F.quarter(date),
        "FiscalYearOctToSep": fiscal_year(date, 10),
        "FiscalMonthOctToSep": fiscal_month(date, 10),
        "FiscalYearJulToJun": fiscal_year(date, 7),
        "FiscalMonthJulToJun": fiscal_month(date, 7),
    }


def with_calendar(dates: DataFrame, column: str) -> DataFrame:
    """One calendar row per row of ``dates``."""
    return dates.select(*[c.alias(n) for n, c in calendar_columns(F.col(column)).items()])


def calendar_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Calendar dimension for every day between two dates held in a one-row frame.

    The number of rows depends on the span of dates only, never on the size of a table.
    """
    days = bounds.select(
        F.explode(F.sequence(F.col(first).cast("date"), F.col(last).cast("date"))).alias("_day")
    )
    return with_calendar(days, "_day")
