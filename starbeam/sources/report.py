"""Product report text files, read whole; and the writer that renders them.

A report is a plain-text file of product blocks separated by lines of ``=``.
Each file is read as one value (``wholetext``), so many files parse in
parallel; one file holds a bounded number of blocks (``blocks_per_file``)
when this module writes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import broadcast_within, kept

# Layout of the product report.
RULE = "=" * 80
DASHES = "-" * 80
LABEL_ID = "Product ID   : "
LABEL_NAME = "Product Name : "
LABEL_CATEGORY = "Category     : "
LABEL_METRICS = "DB Metrics   : "
NOTES_HEADER = "WEB INTELLIGENCE:"
SOURCES_HEADER = "Sources:"


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``report_file``, ``value`` (the whole text)."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("report_file"), "value")
    )


def read_report_lines(spark: SparkSession, path: str) -> DataFrame:
    """S2, distributed: one row per line -- ``report_file``, ``line_no`` (1-based
    within its file), ``line``, ``split`` -- with a large file read by many tasks.

    Lines inside one file split are read in order, and splits are ordered by
    their start offset, so (file, split start, position in split) orders the
    lines of a file.  They are written as they were read, which freezes the
    splits; a line's number is its place in its split after the lines of the
    file's earlier splits (a table with one row per split).  ``split`` (its
    start) comes along: what is worked out split by split shuffles no line again.
    """
    raw = (
        spark.read.option("recursiveFileLookup", True)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("report_file"),
            F.col("_metadata.file_block_start").alias("_split"),
            F.monotonically_increasing_id().alias("_in_split"),
            F.col("value").alias("line"),
        )
    )
    frozen = kept(raw, "lines")
    place = F.row_number().over(Window.partitionBy("report_file", "_split").orderBy("_in_split"))
    earlier = Window.partitionBy("report_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    counts = frozen.groupBy("report_file", "_split").agg(F.count(F.lit(1)).alias("_lines"))
    # files of one split, as most are, have no lines before it
    before = counts.select("report_file", "_split", F.sum("_lines").over(earlier).alias("_before")).filter("_before > 0")
    return frozen.withColumn("_place", place).join(broadcast_within(before), ["report_file", "_split"], "left").select(
        "report_file", (F.coalesce("_before", F.lit(0)) + F.col("_place")).alias("line_no"), "line", F.col("_split").alias("split")
    )


def _dollars(x: Column) -> Column:
    return F.when(x < 0, F.concat(F.lit("-$"), F.format_number(-x, 2))).otherwise(
        F.concat(F.lit("$"), F.format_number(x, 2))
    )


def render_blocks(ranked: DataFrame, notes: Column) -> DataFrame:
    """One text block per ranked product (columns of ``product_ranking``)."""
    block = F.concat(
        F.lit("RANK #"), F.col("revenue_rank").cast("string"), F.lit("\n" + DASHES + "\n"),
        F.lit(LABEL_ID), F.col("product_id"), F.lit("\n"),
        F.lit(LABEL_NAME), F.col("product_name"), F.lit("\n"),
        F.lit(LABEL_CATEGORY), F.col("category_path"), F.lit("\n"),
        F.lit(LABEL_METRICS), F.lit("Revenue "), _dollars(F.col("total_revenue")),
        F.lit(" | Units Sold "), F.col("units_sold").cast("string"),
        F.lit(" | Profit "), _dollars(F.col("total_profit")),
        F.lit(" | Margin ~"), F.format_number(F.coalesce(F.col("profit_margin_pct"), F.lit(0.0)), 1), F.lit("%\n\n"),
        F.lit(NOTES_HEADER + "\n"), notes, F.lit("\n\n"),
        F.lit(SOURCES_HEADER + "\n- none\n\n"), F.lit(RULE),
    )
    return ranked.select("revenue_rank", block.alias("block"))


def render_report(ranked: DataFrame, notes: Column, title: str, generated: str, blocks_per_file: int = 100) -> DataFrame:
    """(file_no, value): report texts of at most ``blocks_per_file`` blocks each."""
    blocks = render_blocks(ranked, notes).withColumn(
        "file_no", F.floor((F.col("revenue_rank") - 1) / blocks_per_file).cast("long")
    )
    header = f"{RULE}\n{title}\nGenerated: {generated}\n{RULE}\n\n"
    return blocks.groupBy("file_no").agg(
        F.concat(
            F.lit(header),
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("revenue_rank", "block"))), lambda s: s["block"]),
                "\n\n",
            ),
            F.lit("\n"),
        ).alias("value")
    )


def write_report(texts: DataFrame, path: str) -> None:
    """S2 sink: one folder per ``file_no``, one text file each."""
    # tasks put their files in place; with the other commit the driver would, one by one
    texts.select("file_no", "value").write.partitionBy("file_no").option(
        "mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
