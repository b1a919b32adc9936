"""Date features."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalytics import fixed


def _as_of(as_of: str | _dt.date | None) -> Column:
    if as_of is None:
        raise ValueError("as_of is required; pass 'today' to use current_date()")
    if isinstance(as_of, str) and as_of.lower() == "today":
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def days_since(c: str | Column, as_of: str | _dt.date | None) -> Column:
    """Whole days from ``c`` to the reference day (int; null date -> null)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.datediff(_as_of(as_of), col)


def weekend_flag(c: str | Column, null_as: int | None = 0) -> Column:
    """1 when the date falls on Sunday or Saturday, else 0.

    ``null_as`` is what a null date gives: 0 (default) or None for null.
    """
    col = F.col(c) if isinstance(c, str) else c
    flag = F.when(F.dayofweek(col).isin(*fixed.WEEKEND_DAYS), F.lit(1)).otherwise(F.lit(0))
    if null_as is None:
        return F.when(col.isNull(), F.lit(None).cast("int")).otherwise(flag)
    if null_as != 0:
        return F.when(col.isNull(), F.lit(int(null_as))).otherwise(flag)
    return flag
