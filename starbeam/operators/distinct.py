"""Exact distinct counts that merge: dense order numbers and bitmaps of them.

``COUNT(DISTINCT order_id)`` has to bring every (group, order_id) pair
together.  Orders with dense numbers need not: each block of 32,768 numbers
is a bitmap of 4 KB, filled within a task, united across tasks and across
groups, and counted at the end.  What is shuffled is a bitmap for each
(group, block) that a task saw.

That is small where a task sees few blocks and few groups.  Numbers follow
the order's first ``row_id``, and the fact is stored by ranges of row id, so a
task that reads the fact sees a few neighbouring blocks; after a shuffle on
another key it would see all of them.  The groups must be few as well.  So
bitmaps serve groups by columns of the fact and of the small dimensions
(calendar, ship modes, geography), which are joined to the partial results;
counts by customer or product keep the plain distinct count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import assign_surrogate_keys

ORDER_NO = "order_no"
BLOCK = "_order_block"


def number_orders(existing: DataFrame, incoming: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """``incoming`` fact rows (row_id, order_id, ...) with ``order_no`` from ``order_numbers``."""
    return incoming.join(order_numbers(existing, incoming if lines is None else lines), "order_id", "left")


def order_numbers(existing: DataFrame, lines: DataFrame) -> DataFrame:
    """(order_id, ``order_no``) of the orders that ``lines`` (row_id, order_id) name.

    An order of ``existing`` keeps its number; the others are numbered after
    the largest one, in the order of their first row id.  The existing table is
    first reduced to the orders the batch names.  A row without an order id
    has no number.  Lines may be rows from which fact rows are made and which
    cost less to read (an order whose lines were all skipped then leaves a gap).
    """
    named = lines.select(F.col("row_id").cast("long"), F.col("order_id").cast("string"))
    orders = named.filter("order_id IS NOT NULL").groupBy("order_id").agg(F.min("row_id").alias("_first_row"))
    if existing.isEmpty():
        return assign_surrogate_keys(orders, ["_first_row", "order_id"], ORDER_NO).select("order_id", ORDER_NO)
    known = existing.select("order_id", ORDER_NO).join(orders.select("order_id"), "order_id", "left_semi")
    known = known.groupBy("order_id").agg(F.min(ORDER_NO).alias(ORDER_NO))
    after = existing.agg(F.coalesce(F.max(ORDER_NO), F.lit(0)) + 1).scalar()
    new = assign_surrogate_keys(orders.join(known, "order_id", "left_anti"), ["_first_row", "order_id"], ORDER_NO, start=after)
    return known.unionByName(new.select("order_id", ORDER_NO))


def block() -> Column:
    """The block an order number is in."""
    return F.bitmap_bucket_number(ORDER_NO).alias(BLOCK)


def orders_seen() -> Column:
    """Aggregate: the bitmap of the order numbers of one block."""
    return F.bitmap_construct_agg(F.bitmap_bit_position(ORDER_NO))


def with_orders(df: DataFrame, keys: Sequence[str], name: str, **sums: Column) -> DataFrame:
    """Groups of ``df`` with the exact number of their orders and sums of additive measures."""
    parts = df.groupBy(*keys, block()).agg(orders_seen().alias("_orders"), *[c.alias(n) for n, c in sums.items()])
    return parts.groupBy(*keys).agg(F.sum(F.bitmap_count("_orders")).alias(name), *[F.sum(n).alias(n) for n in sums])


def united_orders(parts: DataFrame, keys: Sequence[str], name: str, sums: Sequence[str]) -> DataFrame:
    """``with_orders`` from partial results that hold ``_orders`` by block: bitmaps of one group and block are united."""
    blocks = parts.groupBy(*keys, BLOCK).agg(F.bitmap_or_agg("_orders").alias("_orders"), *[F.sum(n).alias(n) for n in sums])
    return blocks.groupBy(*keys).agg(F.sum(F.bitmap_count("_orders")).alias(name), *[F.sum(n).alias(n) for n in sums])
