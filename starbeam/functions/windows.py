"""Ranking and period-over-period helpers.

Both expect grouped (already aggregated) rows.  With partition columns the
window is distributed by them; without, it runs in one task, which is only
right for small results such as one row per year.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .measures import pct

_RANKERS = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}


def rank_within(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[Column],
    methods: Sequence[str] = ("rank",),
) -> DataFrame:
    """RANK / DENSE_RANK / ROW_NUMBER per group with an explicit order.

    Each method becomes a column of that name.
    """
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumns({m: _RANKERS[m]().over(w).cast("long") for m in methods})


def period_over_period(
    df: DataFrame,
    period_cols: Sequence[str],
    value_col: str,
    partition_by: Sequence[str] = (),
    out_col: str | None = None,
) -> DataFrame:
    """percent change of ``value_col`` against the previous period (NULL for
    the first period and where the previous value is 0), rounded to 2."""
    w = Window.partitionBy(*partition_by).orderBy(*period_cols)
    prev = F.lag(value_col).over(w)
    return df.withColumn(out_col or f"{value_col}_pct_change", pct(F.col(value_col) - prev, prev))
