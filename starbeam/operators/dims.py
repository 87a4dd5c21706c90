"""Dimension building from the clean order-line record.

"First row wins" is decided by the smallest ``row_id`` (source file order),
so the choice is deterministic; a hash aggregate collapses a hot natural key
before the shuffle.  Surrogate keys
follow first appearance, as a SERIAL column filled in file order would.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .clean import date_key
from .numbering import assign_surrogate_keys

ORDER_COL = "row_id"


def first_rows(df: DataFrame, keys: Sequence[str], attrs: Sequence[str], order_col: str = ORDER_COL) -> DataFrame:
    """One row per ``keys``: the attributes of the row with the smallest ``order_col``,
    plus that row's position as ``_first_row`` (equal positions: the smallest attributes).

    A hash aggregate first reduces the rows to the different (keys, attributes),
    about the size of the dimension, before the shuffle; only those are ordered.
    """
    seen = df.groupBy(*keys, *attrs).agg(F.min(order_col).alias("_first_row"))
    first = Window.partitionBy(*keys).orderBy("_first_row", *attrs)
    return (
        seen.withColumn("_n", F.row_number().over(first)).filter("_n = 1")
        .select(*keys, *attrs, "_first_row")
    )


def keyed(df: DataFrame, key_col: str, start: int | Column = 1) -> DataFrame:
    """Number rows by ``_first_row`` into ``key_col`` (first column) and drop the helper."""
    out = assign_surrogate_keys(df, ["_first_row"], key_col, start=start)
    return out.select(key_col, *[c for c in df.columns if c != "_first_row"])


def calendar(dates: DataFrame, date_col: str = "full_date") -> DataFrame:
    """The ten calendar columns for a column of DATEs."""
    d = F.col(date_col)
    wd = F.weekday(d)  # 0 = Monday ... 6 = Sunday
    return dates.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        wd.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        (wd >= 5).alias("is_weekend"),
    )


def build_dim_date(clean: DataFrame) -> DataFrame:
    """Every date seen as an order or ship date (not a full calendar)."""
    seen = (
        clean.select(F.col("order_date").alias("full_date"))
        .unionAll(clean.select(F.col("ship_date").alias("full_date")))
        .distinct()
        .dropna()
    )
    return calendar(seen)


def ensure_date(spark: SparkSession, dim_date: DataFrame, day: _dt.date) -> DataFrame:
    """``dim_date`` plus ``day`` if it is not there yet."""
    one = calendar(spark.range(1).select(F.lit(day).cast("date").alias("full_date")))
    return dim_date.unionByName(one.join(dim_date.select("date_key"), "date_key", "left_anti"))


def build_dim_customer(clean: DataFrame) -> DataFrame:
    """(customer_key, customer_id, customer_name, segment)."""
    rows = first_rows(clean.dropna(subset=["customer_id"]), ["customer_id"], ["customer_name", "segment"])
    return keyed(rows, "customer_key")


def build_dim_geography(clean: DataFrame) -> DataFrame:
    """One row per (postal_code, city, state); NULL postal codes group together."""
    rows = first_rows(clean, ["postal_code", "city", "state"], ["country", "region"])
    return keyed(rows, "geography_key")


def build_dim_product(clean: DataFrame) -> DataFrame:
    """(product_key, product_id, product_name, category, sub_category)."""
    rows = first_rows(
        clean.dropna(subset=["product_id"]), ["product_id"], ["product_name", "category", "sub_category"]
    )
    return keyed(rows, "product_key")


def build_dim_ship_mode(clean: DataFrame) -> DataFrame:
    """Distinct non-NULL ship modes, keyed in order of first appearance."""
    rows = clean.dropna(subset=["ship_mode"]).groupBy("ship_mode").agg(F.min(ORDER_COL).alias("_first_row"))
    return keyed(rows, "ship_mode_key")
