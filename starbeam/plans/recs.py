"""The recommendation load (S2 -> R1 -> R2 -> R3 -> E6b -> R5 -> R6) over a star."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import recs as R
from ..operators.dims import ensure_date
from ..sources.report import render_report, write_report
from .reports import product_ranking
from .star import Star

REPORT_TITLE = "TOP SELLING PRODUCTS - PRODUCT REPORT"


def fixture_notes() -> Column:
    """Notes text of the fixture report: odd ranks carry two bullet lines, even ranks none."""
    return F.when(
        F.col("revenue_rank") % 2 == 1,
        F.concat(F.lit("- Brand: "), F.col("sub_category"), F.lit("\n- Type: "), F.col("category")),
    ).otherwise(F.lit(""))


def write_product_report(star: Star, path: str, generated: _dt.date, notes: Column | None = None) -> str:
    """Render the full revenue ranking as report files under ``path``."""
    texts = render_report(product_ranking(star), notes if notes is not None else fixture_notes(), REPORT_TITLE,
                          generated.isoformat())
    write_report(texts, path)
    return path


def load_recommendations(
    spark: SparkSession,
    star: Star,
    reports: DataFrame,
    pairs: DataFrame,
    load_date: _dt.date,
    supplied_notes: DataFrame | None = None,
) -> Star:
    """Parse the reports (line rows or whole texts), keep pairs whose both
    products the reports name, and add them to the star's recommendation
    table under ``load_date``."""
    blocks = R.parse_reports(reports)
    if supplied_notes is not None:
        filled = R.missing_notes(blocks, supplied_notes).select("product_id", F.col("web_intel").alias("_fill"))
        blocks = blocks.join(filled, "product_id", "left").withColumn(
            "web_intel", F.coalesce("_fill", "web_intel")
        ).drop("_fill")
    known = R.known_pairs(pairs, blocks)
    dim_date = ensure_date(spark, star.dim_date, load_date)
    key = int(load_date.strftime("%Y%m%d"))
    resolved = R.resolve_pair_keys(known, star.dim_product, key)
    existing = star.dim_product_recommendations
    if existing is None:
        existing = R.empty_recommendations(spark)
    return star.with_(dim_date=dim_date, dim_product_recommendations=R.load_recommendations(existing, resolved))

