"""Scalar expressions of the warehouse programs.

All are built-in Catalyst expressions, so they stay inside whole-stage
codegen and, where they compare a column with a literal, reach the Parquet
scan as pushed filters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def day(col: str | Column) -> Column:
    """H1: ``CAST(x AS date)``."""
    return _c(col).cast("date")


def on_or_after(col: str | Column, cutoff: dt.date | Column) -> Column:
    """The inclusive day cutoff ``CAST(x AS date) >= cutoff``.

    Written as a date comparison (never as formatted text) so that Parquet
    receives it as a range filter.
    """
    bound = F.lit(cutoff) if isinstance(cutoff, dt.date) else cutoff
    return day(col) >= bound


def month_start(col: str | Column) -> Column:
    """H2: ``DATE_TRUNC('month', d)::date`` (a date, not a timestamp)."""
    return F.trunc(day(col), "month")


def day_before(col: str | Column) -> Column:
    """H3: ``DATEADD('day', -1, d)`` kept as a date."""
    return F.date_sub(day(col), 1)


def normalized(col: str | Column) -> Column:
    """H6: ``LOWER(TRIM(x))`` (TRIM removes spaces only)."""
    return F.lower(F.trim(_c(col)))


def status_is(col: str | Column, value: str) -> Column:
    """Normalized string equality."""
    return normalized(col) == F.lit(value.strip().lower())


def blank_as_null(col: str | Column) -> Column:
    """A4: empty or all-blank text becomes NULL, other text is kept as is."""
    c = _c(col)
    return F.when(F.trim(c) == F.lit(""), F.lit(None).cast("string")).otherwise(c)


def changed(new: str | Column, old: str | Column) -> Column:
    """``new IS DISTINCT FROM old`` (NULL-safe)."""
    return ~_c(new).eqNullSafe(_c(old))


def sticky_flag(current: str | Column, incoming: str | Column) -> Column:
    """H7: ``CASE WHEN current = 1 THEN 1 ELSE incoming END``."""
    return F.when(_c(current) == 1, F.lit(1)).otherwise(_c(incoming))


def flag(cond: Column) -> Column:
    """A 0/1 integer flag from a predicate (NULL counts as 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))
