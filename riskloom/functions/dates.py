"""Dates held as text, and yyyymm month numbers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_to_date(text: Column) -> Column:
    """Date from ISO text (date or date-time) or from ``M/d/yyyy H:mm``; NULL for anything else.

    The fifth character tells the forms apart, so that every value is parsed once. Parsing by a
    full pattern keeps partial dates such as ``2024`` out: a plain cast would accept them.
    """
    iso = F.try_to_timestamp(F.left(text, F.lit(10)), F.lit("yyyy-M-d"))
    us = F.try_to_timestamp(text, F.lit("M/d/yyyy H:m"))
    return F.when(F.substring(text, 5, 1) == "-", iso).otherwise(us).cast("date")


def month_end(year_month: Column) -> Column:
    """Last day of a yyyymm month."""
    return F.last_day(F.to_date(year_month.cast("string"), "yyyyMM"))


def days_before(end: Column, day: Column) -> Column:
    """Whole days from ``day`` to ``end``; negative when ``day`` is later."""
    return F.datediff(end, day).cast("long")


def month_index(year_month: Column) -> Column:
    """Months since year 0, so that neighbouring months differ by one across January."""
    return (F.floor(year_month / 100) * 12 + year_month % 100).cast("long")


def shift_month(year_month: Column, months: int) -> Column:
    """A yyyymm column moved by whole months, through dates."""
    first = F.to_date(year_month.cast("string"), "yyyyMM")
    return F.date_format(F.add_months(first, months), "yyyyMM").cast("long")


def month_plus(year_month: int, months: int) -> int:
    """A yyyymm number moved by whole months."""
    index = year_month // 100 * 12 + year_month % 100 - 1 + months
    return index // 12 * 100 + index % 12 + 1


def previous_month(run_date: date) -> int:
    """The month that had just closed on ``run_date``."""
    return month_plus(run_date.year * 100 + run_date.month, -1)
