"""RANK, DENSE_RANK, ROW_NUMBER and LAG over groups of any size.

A window function brings each group into one task.  Where a group may hold a
large share of the rows, or there is only one, the rows are range-partitioned
on (group, order) instead and sorted, and that layout is written (as E11
does), so it stays fixed.  Equal (group, order) values are in one partition.
Each partition then works out its own ranks, and what a group has in earlier
partitions is added from a carry table.  Only the first and the last group
of a partition can go on elsewhere, so that table has at most two rows for
each partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import COMPRESSION, new_path

_PID, _POS, _GROUP, _ORDER = "_sb_pid", "_sb_pos", "_sb_group", "_sb_order"
RANKS = ("rank", "dense_rank", "row_number")


def _laid_out(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], num_partitions: int | None) -> DataFrame:
    """``df`` in (group, order) order over range partitions, written with each row's partition and place."""
    spark = df.sparkSession
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [*[F.col(c).asc_nulls_first() for c in group], *[F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]]
    path = new_path(spark, "ranked")
    (
        df.repartitionByRange(num_partitions, *by)
        .sortWithinPartitions(*by)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id())
        .withColumn(_GROUP, F.struct(*group) if group else F.struct(F.lit(0).alias("all")))
        .write.option("compression", COMPRESSION).parquet(path)
    )
    return spark.read.parquet(path)


def _ends(laid: DataFrame) -> DataFrame:
    """One row for each partition: its first and its last group."""
    return laid.groupBy(_PID).agg(F.min_by(_GROUP, _POS).alias("head"), F.max_by(_GROUP, _POS).alias("tail"))


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], kinds: Sequence[str] = ("rank",),
           num_partitions: int | None = None) -> DataFrame:
    """``df`` with the columns ``kinds`` (of rank, dense_rank, row_number), numbered from 1 in each ``group``.

    ``order`` holds names (ascending, nulls first) or sort Columns; rows that
    are equal in it share rank and dense_rank.  No group is held by one task.
    """
    unknown = [k for k in kinds if k not in RANKS]
    if unknown:
        raise ValueError(f"unknown rank kinds {unknown}")
    laid = _laid_out(df, group, order, num_partitions)
    by = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]
    own = Window.partitionBy(_PID, _GROUP).orderBy(*by)
    functions = {"rank": F.rank(), "dense_rank": F.dense_rank(), "row_number": F.row_number()}
    local = laid.withColumns({f"_sb_{k}": functions[k].over(own) for k in RANKS if k in kinds or k == "dense_rank"})
    # what a partition holds of the groups at its ends
    edges = _ends(laid).select(_PID, F.explode(F.array_distinct(F.array("head", "tail"))).alias("edge"))
    at_edge = (F.col(_PID) == F.col("_sb_p")) & F.col(_GROUP).eqNullSafe(F.col("edge"))
    held = local.join(F.broadcast(edges.withColumnRenamed(_PID, "_sb_p")), at_edge)  # two rows a partition
    held = held.groupBy("_sb_p", "edge").agg(F.count(F.lit(1)).alias("n"), F.max("_sb_dense_rank").alias("d"))
    before = Window.partitionBy("edge").orderBy("_sb_p").rowsBetween(Window.unboundedPreceding, -1)
    carry = held.select("_sb_p", "edge", F.sum("n").over(before).alias("_sb_n"), F.sum("d").over(before).alias("_sb_d")).filter("_sb_n > 0")
    both = local.join(F.broadcast(carry), at_edge, "left")
    added = {"rank": "_sb_n", "row_number": "_sb_n", "dense_rank": "_sb_d"}
    return both.select(*df.columns, *[(F.col(f"_sb_{k}") + F.coalesce(added[k], F.lit(0))).cast("long").alias(k) for k in kinds])


def lagged(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], value: str, out: str,
           num_partitions: int | None = None) -> DataFrame:
    """``df`` with ``out``: ``value`` of the row before in its ``group`` (null for the first), by ``order`` (a total order).

    The first row of a partition takes the last one of the partition before.
    """
    laid = _laid_out(df, group, order, num_partitions)
    own = Window.partitionBy(_PID, _GROUP).orderBy(_POS)
    local = laid.withColumns({"_sb_lag": F.lag(value).over(own), "_sb_row": F.row_number().over(own)})
    # one row for each partition
    ends = laid.groupBy(_PID).agg(F.min_by(_GROUP, _POS).alias("head"), F.max_by(_GROUP, _POS).alias("tail"),
                                  F.max_by(F.struct(F.col(value).alias("v")), F.col(_POS)).alias("last"))
    inward = Window.orderBy(_PID)
    carry = ends.select(F.col(_PID).alias("_sb_p"), F.col("head").alias("edge"),
                        F.when(F.col("head").eqNullSafe(F.lag("tail").over(inward)), F.lag("last").over(inward)).alias("_sb_last"))
    first = (F.col(_PID) == F.col("_sb_p")) & F.col(_GROUP).eqNullSafe(F.col("edge")) & (F.col("_sb_row") == 1)
    both = local.join(F.broadcast(carry.filter("_sb_last IS NOT NULL")), first, "left")
    return both.select(*df.columns, F.coalesce("_sb_lag", "_sb_last.v").alias(out))
