"""The warehouse's SQL conventions as column functions.

Rounding is done on DECIMAL values (half away from zero, like NUMERIC) and
published as DOUBLE.  Ratios are divided as DOUBLE, then fixed to six
decimals before rounding, so a ratio that is one ulp under a .5 boundary
does not round the other way.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Discount tier labels, one set per source of the warehouse.
TIER_LABELS = {
    # golden query GQ-10 (en dash)
    "golden": ("No Discount", "Moderate (1–20%)", "Heavy (>20%)"),
    # discount dataset V2 (hyphen)
    "ascii": ("No Discount", "Moderate (1-20%)", "Heavy (>20%)"),
    # SQL-generation conventions (short form)
    "short": ("No Discount", "Moderate", "Heavy"),
}
HEAVY_ABOVE = Decimal("0.20")
# Default row limits for ranking and exploration results.
TOP_N_RANKING = 10
TOP_N_EXPLORATION = 20


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / NULLIF(den, 0) as DOUBLE (NULL instead of a division error)."""
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))


def round_to(x: str | Column, scale: int) -> Column:
    """Round a DOUBLE through DECIMAL(38,6) to ``scale`` places, back to DOUBLE."""
    return F.round(_c(x).cast("decimal(38,6)"), scale).cast("double")


def money(x: str | Column) -> Column:
    """a money amount (DECIMAL sum) rounded to cents; it stays DECIMAL, so no total loses its cents or ties by rounding."""
    return F.round(_c(x), 2)


def pct(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """100 * num / NULLIF(den, 0), rounded."""
    return round_to(safe_ratio(num, den) * 100, scale)


def days(x: str | Column) -> Column:
    """an average number of days, one decimal."""
    return round_to(x, 1)


def avg_of(x: str | Column) -> Column:
    """AVG as SUM / COUNT in DOUBLE (an aggregate expression)."""
    return F.sum(_c(x)).cast("double") / F.count(_c(x))


def margin_pct(profit: str | Column = "profit", sales: str | Column = "sales") -> Column:
    """SUM(profit) / NULLIF(SUM(sales), 0) * 100, rounded to 2 (an aggregate expression)."""
    return pct(F.sum(_c(profit)), F.sum(_c(sales)))


def discount_tier(discount: str | Column = "discount", labels: str | Sequence[str] = "golden") -> Column:
    """0 -> none, up to 0.20 -> moderate, else heavy (NULL falls to heavy, as ELSE does)."""
    none_l, mod_l, heavy_l = TIER_LABELS[labels] if isinstance(labels, str) else labels
    d = _c(discount)
    return F.when(d == 0, F.lit(none_l)).when(d <= F.lit(HEAVY_ABOVE), F.lit(mod_l)).otherwise(F.lit(heavy_l))


def tier_condition(label: str, discount: str | Column = "discount", labels: str | Sequence[str] = "golden") -> Column:
    """The F3 tier ``label`` as a range predicate on the discount itself, so a
    filter on the tier reaches the Parquet scan (a CASE expression does not)."""
    none_l, mod_l, heavy_l = TIER_LABELS[labels] if isinstance(labels, str) else labels
    d = _c(discount)
    if label == none_l:
        return d == 0
    if label == mod_l:
        return (d != 0) & (d <= F.lit(HEAVY_ABOVE))
    if label == heavy_l:
        return (d > F.lit(HEAVY_ABOVE)) | d.isNull()
    return F.lit(False)


def top_n(df: DataFrame, order: Sequence[Column], n: int | None = TOP_N_RANKING) -> DataFrame:
    """ordered top-n (planned as TakeOrderedAndProject: per-task top-n, then merge)."""
    out = df.orderBy(*order)
    return out.limit(n) if n is not None else out


def default_order(df: DataFrame, first_measure: str, keys: Sequence[str] = ()) -> DataFrame:
    """F8: grouped results by their first measure, descending (NULLs first, as
    PostgreSQL sorts them), then by the group keys."""
    return df.orderBy(F.col(first_measure).desc_nulls_first(), *[F.col(k).asc_nulls_last() for k in keys])
