"""Calendar arithmetic on DATE columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def _index(d: Column, unit: str) -> Column:
    if unit == "month":
        return F.year(d) * 12 + F.month(d)
    if unit == "quarter":
        return F.year(d) * 4 + F.quarter(d)
    return F.year(d)


def boundaries_crossed(start: Column, end: Column, unit: str) -> Column:
    """Calendar month, quarter or year boundaries between two dates (not elapsed periods)."""
    return _index(end, unit) - _index(start, unit)


def months_since(start: Column, end: Column) -> Column:
    return boundaries_crossed(start, end, "month")


def month_label(d: Column) -> Column:
    return F.date_format(d, "MMM yyyy")
