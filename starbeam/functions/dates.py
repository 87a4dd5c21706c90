"""date filters through the date dimension.

The filter is applied to ``dim_date`` (small) and reaches the fact through
the join.  Because date keys are YYYYMMDD integers, the same bounds are also
applied to the fact's own key column, which lets Parquet skip row groups of
a fact written clustered by order date.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.star import Star


def _key(d: _dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def date_filter(
    star: Star,
    year: int | None = None,
    quarter: int | None = None,
    month: int | None = None,
    start: _dt.date | None = None,
    end: _dt.date | None = None,
    key_col: str = "order_date_key",
) -> DataFrame:
    """Fact rows whose ``key_col`` date matches; the date columns come along."""
    d = star.dim_date
    f = star.fact_orders
    lo, hi = None, None
    if year is not None:
        d = d.filter(F.col("year") == year)
        lo, hi = _key(_dt.date(year, 1, 1)), _key(_dt.date(year, 12, 31))
    if quarter is not None:
        d = d.filter(F.col("quarter") == quarter)
    if month is not None:
        d = d.filter(F.col("month") == month)
    if start is not None:
        d = d.filter(F.col("full_date") >= F.lit(start))
        lo = max(lo or 0, _key(start))
    if end is not None:
        d = d.filter(F.col("full_date") <= F.lit(end))
        hi = min(hi or 99991231, _key(end))
    if lo is not None:
        f = f.filter(F.col(key_col) >= lo)
    if hi is not None:
        f = f.filter(F.col(key_col) <= hi)
    return f.join(d.withColumnRenamed("date_key", key_col), key_col)
