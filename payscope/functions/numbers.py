"""Number parsing and calendar arithmetic."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_to_number(c: Column) -> Column:
    """Whole number written in plain digits (sign and blanks around it allowed), else NULL.

    The guard keeps out what a cast alone would accept, such as ``1e2``.
    """
    return F.when(c.rlike(r"^ *[+-]?[0-9]+ *\z"), c.try_cast("decimal(38,0)"))


def day_of(as_of: date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def months_crossed(start: Column, end: Column) -> Column:
    """Month boundaries between two dates: Jan 31 to Feb 1 is one."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def years_crossed(start: Column, end: Column) -> Column:
    return F.year(end) - F.year(start)
