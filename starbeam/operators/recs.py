"""Product report parsing and the recommendation load.

Parsing uses the JVM regex functions (no Python per row).  The report is
split into blocks on runs of ten or more ``=``; a block is a product block
when it carries both a product id and a product name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.upsert import upsert_ignore
from ..session import broadcast_within, kept

# Patterns of the product report.
BLOCK_SPLIT = "={10,}"
ID_PATTERN = r"Product ID\s*:\s*(\S+)"
NAME_PATTERN = r"Product Name\s*:\s*(.+)"
CATEGORY_PATTERN = r"Category\s*:\s*(.+)"
NOTES_PATTERN = r"(?s)WEB INTELLIGENCE:(.*?)(?:Sources:|={5,})"
LEVEL_SEPARATOR = " > "
# Fixed value: search phrase suffix used for products without notes.
SEARCH_SUFFIX = " office product specifications features review"

#: lines of a report file that are cut into blocks together, where their file's splits are not known
STRETCH_LINES = 100_000

REC_KEY = ["product_key", "recommended_product_key", "date_key", "recommendation_type"]
REC_COLUMNS = ["recommendation_key", *REC_KEY, "recommendation_score", "recommendation_reason"]


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def report_blocks(reports: DataFrame) -> DataFrame:
    """R1 on whole-file texts (``read_report``): (report_file, block_no,
    product_id, product_name, category_raw, web_intel)."""
    blocks = reports.select("report_file", F.posexplode(F.split("value", BLOCK_SPLIT)).alias("block_no", "block"))
    return _parse_blocks(blocks)


def _parse_blocks(blocks: DataFrame) -> DataFrame:
    b = F.col("block")
    found = b.rlike(ID_PATTERN) & b.rlike(NAME_PATTERN)
    return blocks.filter(found).select(
        "report_file",
        "block_no",
        _strip(F.regexp_extract(b, ID_PATTERN, 1)).alias("product_id"),
        _strip(F.regexp_extract(b, NAME_PATTERN, 1)).alias("product_name"),
        _strip(F.regexp_extract(b, CATEGORY_PATTERN, 1)).alias("category_raw"),
        _strip(F.regexp_extract(b, NOTES_PATTERN, 1)).alias("web_intel"),
    )


def report_blocks_from_lines(lines: DataFrame) -> DataFrame:
    """R1 over line rows (``read_report_lines``): the same blocks and fields as
    ``report_blocks`` without holding a whole file in one task.

    Each line splits into pieces on the separator; every piece after the
    first, and the first piece of a file, opens a block.  A block's number is
    the running count of the blocks that its file opened; its text is its
    pieces joined by newlines.  Both are worked out in stretches of a file (the
    ``split`` a line was read in, else ``STRETCH_LINES`` lines), and what a file
    opened in earlier stretches is added from a table with one row for each.
    Only blocks that go on in another stretch are brought together once more.
    """
    stretch = F.col("split") if "split" in lines.columns else F.floor((F.col("line_no") - 1) / STRETCH_LINES)
    pieces = lines.select(
        "report_file", stretch.alias("_stretch"), "line_no", F.posexplode(F.split("line", BLOCK_SPLIT)).alias("piece_no", "piece")
    ).withColumn(
        "_opens", ((F.col("piece_no") > 0) | ((F.col("line_no") == 1) & (F.col("piece_no") == 0))).cast("long")
    )
    inside = Window.partitionBy("report_file", "_stretch").orderBy("line_no", "piece_no").rowsBetween(Window.unboundedPreceding, 0)
    texts = pieces.withColumn("_opened", F.sum("_opens").over(inside)).groupBy("report_file", "_stretch", "_opened").agg(
        _joined(F.struct("line_no", "piece_no", F.col("piece").alias("text"))).alias("text"))
    texts = kept(texts, "blocks")
    earlier = Window.partitionBy("report_file").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = texts.groupBy("report_file", "_stretch").agg(F.max("_opened").alias("_n")).select(
        "report_file", "_stretch", F.sum("_n").over(earlier).alias("_before")).filter("_before > 0")
    numbered = texts.join(broadcast_within(before), ["report_file", "_stretch"], "left").withColumn(
        "block_no", F.coalesce("_before", F.lit(0)) + F.col("_opened"))
    # a stretch that begins inside a block: one row for each at most
    going_on = broadcast_within(numbered.filter("_opened = 0").select("report_file", "block_no").distinct())
    whole = numbered.join(going_on, ["report_file", "block_no"], "left_anti").select("report_file", "block_no", "text")
    parts = numbered.join(going_on, ["report_file", "block_no"], "left_semi").groupBy("report_file", "block_no").agg(
        _joined(F.struct("_stretch", "text")).alias("text"))
    # a block is parsed exactly as a block cut from the whole text
    return _parse_blocks(whole.unionByName(parts).withColumnRenamed("text", "block"))


def _joined(part: Column) -> Column:
    """Aggregate: the ``text`` of all parts in the order of their other fields, joined by newlines."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda s: s["text"]), "\n")


def parse_reports(reports: DataFrame) -> DataFrame:
    """R1 on either form of S2: line rows (``line``) or whole texts (``value``)."""
    return report_blocks_from_lines(reports) if "line" in reports.columns else report_blocks(reports)


def category_levels(blocks: DataFrame) -> DataFrame:
    """R1b: "Category > Sub-Category" into its two levels (NULL when absent)."""
    parts = F.split(F.col("category_raw"), LEVEL_SEPARATOR)
    return blocks.select(
        "product_id",
        F.nullif(F.try_element_at(parts, F.lit(1)), F.lit("")).alias("category"),
        F.try_element_at(parts, F.lit(2)).alias("sub_category"),
    )


def missing_notes(blocks: DataFrame, supplied: DataFrame | None = None) -> DataFrame:
    """R2: products whose notes are blank, with the search phrase to look them up.

    ``supplied`` (product_id, notes), if given, fills the gap: ``web_intel`` is
    then the supplied text (or still '' where nothing was supplied).
    """
    gaps = blocks.filter(_strip(F.col("web_intel")) == "").select(
        "product_id", "product_name", F.concat(F.col("product_name"), F.lit(SEARCH_SUFFIX)).alias("search_phrase")
    )
    if supplied is None:
        return gaps
    s = supplied.select("product_id", F.col("notes"))
    return gaps.join(s, "product_id", "left").withColumn("web_intel", F.coalesce("notes", F.lit(""))).drop("notes")


def known_pairs(pairs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Pairs whose source and recommended ids both occur in the report."""
    ids = blocks.select("product_id").distinct()
    return pairs.join(ids.withColumnRenamed("product_id", "source_product_id"), "source_product_id", "left_semi").join(
        ids.withColumnRenamed("product_id", "recommended_product_id"), "recommended_product_id", "left_semi"
    )


def missing_products(pairs: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Ids named by a pair (either side) that the product dimension lacks."""
    ids = pairs.select(F.explode(F.array("source_product_id", "recommended_product_id")).alias("product_id"))
    return ids.distinct().join(dim_product.select("product_id"), "product_id", "left_anti")


def resolve_pair_keys(pairs: DataFrame, dim_product: DataFrame, date_key: int) -> DataFrame:
    """Both ids to product keys plus the load date key; unresolved pairs dropped."""
    src = dim_product.select(F.col("product_id").alias("source_product_id"), "product_key")
    rec = dim_product.select(
        F.col("product_id").alias("recommended_product_id"), F.col("product_key").alias("recommended_product_key")
    )
    return pairs.join(src, "source_product_id").join(rec, "recommended_product_id").select(
        "product_key",
        "recommended_product_key",
        F.lit(date_key).cast("int").alias("date_key"),
        "recommendation_type",
        F.col("recommendation_score").cast("decimal(5,4)"),
        "recommendation_reason",
    )


def empty_recommendations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [],
        "recommendation_key long, product_key long, recommended_product_key long, date_key int, "
        "recommendation_type string, recommendation_score decimal(5,4), recommendation_reason string",
    )


def load_recommendations(existing: DataFrame, resolved: DataFrame) -> DataFrame:
    """Insert-if-absent on (product, recommended product, date, type).

    The date is part of the key: a rerun on the same day adds nothing, a run
    on a later day adds a new snapshot.  New rows are keyed after the current
    maximum, in key order.
    """
    inc = resolved.withColumn("_ord", F.struct(*REC_KEY, "recommendation_score", "recommendation_reason"))
    return upsert_ignore(existing.select(*REC_COLUMNS), inc, REC_KEY, key_col="recommendation_key", order_col="_ord")


def recommendations_by_type(recs: DataFrame) -> DataFrame:
    """Rows per recommendation type."""
    return recs.groupBy("recommendation_type").agg(F.count(F.lit(1)).alias("n")).orderBy("recommendation_type")
