"""Scalar expressions used by the table functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tidy_city(city: str) -> Column:
    """Trimmed, first letter of each space-separated word in upper case."""
    return F.initcap(F.trim(F.col(city)))


def tidy_state(state: str) -> Column:
    return F.upper(F.trim(F.col(state)))


def days_between(end: str, start: str) -> Column:
    """Whole calendar days from ``start`` to ``end``; NULL if either is."""
    return F.datediff(F.to_date(F.col(end)), F.to_date(F.col(start)))


def is_late(delivered: str, promised: str) -> Column:
    """Delivered after the promised moment.

    Compares the full timestamps, so a delivery later on the promised day is
    late although ``days_between`` is 0. Anything not delivered is not late.
    """
    return F.coalesce(F.col(delivered) > F.col(promised), F.lit(False))


def calendar_parts(ts: str, prefix: str) -> dict[str, Column]:
    """Year, month, quarter and sortable ``yyyy-MM`` label of a timestamp."""
    at = F.col(ts)
    return {
        f"{prefix}_year": F.year(at),
        f"{prefix}_month": F.month(at),
        f"{prefix}_quarter": F.quarter(at),
        "year_month": F.date_format(at, "yyyy-MM"),
    }


def volume(*sides: str) -> Column:
    """Product of the sides as a long, NULL if any side is."""
    result = F.lit(1).cast("long")
    for side in sides:
        result = result * F.col(side).cast("long")
    return result
