"""Dense surrogate numbering without a global single-partition window.

``row_number() OVER (ORDER BY ...)`` with no partition moves every row into
one task.  Instead the rows are range-partitioned on the order columns and
sorted inside each partition; each row's partition id and position inside
its partition (``monotonically_increasing_id``) are then written, with the
row, as a Parquet table in the shared work folder.  That write freezes the
layout: a lost executor cannot reshuffle rows between the count pass and
the numbering pass, and the lineage is cut.  The per-partition start
offsets come from a table with one row per partition, whose size is bounded
by the partition count and not by the data, so broadcasting it is safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import COMPRESSION, new_path

_PID = "_sb_pid"
_POS = "_sb_pos"
#: equal stretches of a column's values for each range that ``range_of`` deals them into
STRETCHES = 64
#: rows of a range, which one task sorts
RANGE_ROWS = 500_000


def ranges_for(rows: DataFrame, most: int = RANGE_ROWS) -> int:
    """How many ranges to deal ``rows`` into: the shuffle partitions, or more where they are too many for these."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // most))


def range_of(values: DataFrame, column: str, ranges: int) -> Column | None:
    """The range 0 .. ``ranges`` - 1, in ascending order, of a value of the whole-number ``column``; a null is in the first.

    A range partitioning samples its rows, and so runs whatever made them
    twice; ``values`` may be cheaper to read (the rows' column, or more values).
    The ranges are runs of equal stretches between the least and the largest
    value, counted in one pass.  None where there are no values, or where they
    lie so unevenly that a stretch holds more than two ranges' share.
    """
    low, high, total = values.agg(F.min(column), F.max(column), F.count(column)).first()
    if not total:
        return None
    width = -(-(high - low + 1) // (ranges * STRETCHES))
    stretch = F.expr(f"(`{column}` - {low}L) div {width}L")
    # one row for each stretch at most
    counts = dict(values.filter(F.col(column).isNotNull()).groupBy(stretch).agg(F.count(F.lit(1))).collect())
    if max(counts.values()) * ranges > 2 * max(total, ranges):
        return None
    at, done = [], 0
    for i in range((high - low) // width + 1):
        at.append(done * ranges // total)
        done += counts.get(i, 0)
    table = F.split(F.lit(",".join(map(str, at))), ",").cast("array<int>")
    return F.coalesce(F.element_at(table, (stretch + 1).cast("int")), F.lit(0))


def assign_surrogate_keys(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    key_col: str = "key",
    start: int | Column = 1,
    num_partitions: int | None = None,
    unique: Sequence[str] | None = None,
    ranges: Column | None = None,
    lookups: Sequence[tuple[DataFrame, str]] = (),
    spent: Sequence[str] = (),
) -> DataFrame:
    """Add ``key_col``: 0-gap numbers ``start, start+1, ...`` in ``order_cols`` order.

    ``order_cols`` are names (ascending) or sort Columns such as
    ``F.col("x").desc()``, and should form a total order (ties are numbered in an arbitrary
    but stable order).  ``start`` may be a literal or a one-row column
    expression such as ``max(existing_key) + 1`` passed as a Column.

    With ``unique``, rows that share the first order column (a name) keep one,
    the first in the order of those columns; the range partitioning already
    has them together, so this costs no further shuffle.

    ``ranges`` is a row's range in the order of the first order column (a name,
    ``range_of``), for rows that cost much to make: they are then not sampled.
    With it, each of ``lookups`` (a table of ``_sb_pid``: a range, a key, a value,
    and how to join it) adds its value to the rows of that key in that range; its
    rows go to the range of the rows that need them, which a join on the key alone
    would have to shuffle once more.  ``spent`` are columns that only the lookups
    read; they are not written.
    """
    spark = df.sparkSession
    # names sort ascending; Columns keep the direction the caller gave them
    order = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_cols]
    path = new_path(spark, "numbered")
    # an explicit count (the session's shuffle partitions, sized to the data
    # on a cluster) keeps the written table split into that many files
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if ranges is None:
        dealt, together = df.repartitionByRange(num_partitions, *order), []
    else:
        dealt, together = dealt_by_range(df.withColumn(_PID, ranges), num_partitions, lookups).drop(*spent), [_PID]
    if unique is not None:
        # the order column first: a range's number, the same in all rows of a task, would not help its sort
        same = Window.partitionBy(order_cols[0], *together).orderBy(*unique)
        dealt = dealt.withColumn("_sb_n", F.row_number().over(same)).filter("_sb_n = 1").drop("_sb_n")
    placed = dealt.sortWithinPartitions(*order).withColumn(_POS, F.monotonically_increasing_id())
    if ranges is None:
        placed = placed.withColumn(_PID, F.spark_partition_id())
    placed.write.option("compression", COMPRESSION).parquet(path)
    frozen = spark.read.parquet(path)
    # one row per non-empty partition: the bound on this table is num_partitions
    offsets = (
        frozen.groupBy(_PID)
        .agg(F.count(F.lit(1)).alias("_sb_n"), F.min(_POS).alias("_sb_first"))
        .withColumn(
            "_sb_off",
            F.coalesce(
                F.sum("_sb_n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ) - F.col("_sb_first"),
        )
        .select(_PID, "_sb_off")
    )
    start_col = start if isinstance(start, Column) else F.lit(start)
    return (
        frozen.join(F.broadcast(offsets), _PID)
        .withColumn(key_col, (start_col + F.col("_sb_off") + F.col(_POS)).cast("long"))
        .drop(_PID, _POS, "_sb_off")
    )


def dealt_by_range(rows: DataFrame, num_partitions: int, lookups: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """``rows`` partitioned by their range, with the values of ``lookups``; both sides lie by range, so a join moves nothing more.

    A range's lookup rows are no more than the values its rows name, so they are hashed and the rows not sorted for them.
    """
    dealt = rows.repartitionById(num_partitions, F.col(_PID))
    for lookup, how in lookups:
        sent = lookup.repartitionById(num_partitions, F.col(_PID)).hint("shuffle_hash")
        dealt = dealt.join(sent, lookup.columns[:2], how)
    return dealt


def running_sum(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    value_col: str,
    out_col: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out_col``: the sum of ``value_col`` over all rows up to and including
    this one in ``order_cols`` order (a total order), without a global window.

    Same layout freezing as ``assign_surrogate_keys``; each partition's total
    goes into a table with one row per partition (broadcast, bounded by the
    partition count), and the sum inside a partition is a window over that
    partition's rows alone.
    """
    spark = df.sparkSession
    order = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_cols]
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_path(spark, "prefix")
    (
        df.repartitionByRange(num_partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id())
        .write.option("compression", COMPRESSION).parquet(path)
    )
    frozen = spark.read.parquet(path)
    totals = (
        frozen.groupBy(_PID)
        .agg(F.sum(value_col).alias("_sb_t"))
        .withColumn(
            "_sb_off",
            F.coalesce(F.sum("_sb_t").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
                       F.lit(0)),
        )
        .select(_PID, "_sb_off")
    )
    inside = Window.partitionBy(_PID).orderBy(_POS).rowsBetween(Window.unboundedPreceding, 0)
    return (
        frozen.join(F.broadcast(totals), _PID)
        .withColumn(out_col, F.col("_sb_off") + F.sum(value_col).over(inside))
        .drop(_PID, _POS, "_sb_off")
    )
