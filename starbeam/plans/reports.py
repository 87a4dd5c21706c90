"""Ranked product reports and anomaly reports.

Product aggregates are one grouped pass over the fact.  Top-N uses an
ordered limit (per-task top-N, then a merge of N rows per task); a ranking
of *all* products uses the distributed numbering of E11, never a global
single-partition window.  Thresholds that compare a product with all
products are one-row aggregates used as scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import TOP_N_RANKING, margin_pct, money, pct, round_to, safe_ratio
from ..operators.numbering import assign_surrogate_keys
from .golden import subcategory_columns, subcategory_sums
from .star import Star


def product_totals(star: Star) -> DataFrame:
    """Unrounded revenue, units and profit per product (one row per product_key)."""
    per_key = star.fact_orders.groupBy("product_key").agg(
        F.sum("sales").alias("revenue"),
        F.sum("quantity").cast("long").alias("units_sold"),
        F.sum("profit").alias("profit"),
    )
    return per_key.join(star.dim_product, "product_key")


def _report_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "revenue_rank",
        "product_id",
        "product_name",
        "category",
        "sub_category",
        F.concat_ws(" > ", "category", "sub_category").alias("category_path"),
        money("revenue").alias("total_revenue"),
        "units_sold",
        money("profit").alias("total_profit"),
        pct("profit", "revenue", 1).alias("profit_margin_pct"),
    )


def _by_revenue():
    return [F.col("revenue").desc_nulls_last(), F.col("product_id").asc()]


def top_products_report(star: Star, n: int = TOP_N_RANKING) -> DataFrame:
    """A1: top ``n`` products by revenue with rank, "Category > Sub-Category",
    units, profit and margin (1 decimal, as the report prints it)."""
    return _report_columns(_top_products(star, n)).orderBy("revenue_rank")


def _top_products(star: Star, n: int) -> DataFrame:
    """Unrounded totals of the top ``n`` products, ranked; numbering runs over the n kept rows only."""
    top = product_totals(star).orderBy(*_by_revenue()).limit(n)
    return top.withColumn("revenue_rank", F.row_number().over(Window.orderBy(*_by_revenue())).cast("long"))


def product_ranking(star: Star) -> DataFrame:
    """A1 over every product: the same columns with a distributed rank."""
    ranked = assign_surrogate_keys(product_totals(star), _by_revenue(), "revenue_rank")
    return _report_columns(ranked)


def discount_destruction(star: Star, min_avg_discount: float = 0.20, max_margin: float = 0.0) -> DataFrame:
    """A2: sub-categories whose average discount is above ``min_avg_discount`` and
    whose margin is below ``max_margin`` %, both before rounding, with their revenue rank
    among all sub-categories (one row per sub-category, so the ranking window is small)."""
    w = Window.orderBy(F.col("sales").desc_nulls_last(), "category", "sub_category")
    return (
        subcategory_sums(star).withColumn("revenue_rank", F.rank().over(w).cast("long"))
        .filter((safe_ratio("disc", "n_disc") > min_avg_discount) & (safe_ratio("profit", "sales") * 100 < max_margin))
        .select("category", "sub_category", *subcategory_columns(), "revenue_rank")
        .orderBy("profit_margin_pct", "category", "sub_category")
    )


def clearance_signature(star: Star, top_fraction: float = 0.10) -> DataFrame:
    """A3: products in the top ``top_fraction`` by revenue that lose money, sell
    fewer units than the average product and sell at an average price above
    the average product's."""
    totals = product_totals(star).withColumn("avg_price", safe_ratio("revenue", "units_sold"))
    ranked = assign_surrogate_keys(totals, _by_revenue(), "revenue_rank")
    # one scalar subquery over the already written ranking, not one fact scan per threshold
    stats = ranked.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.col("units_sold").cast("double")).alias("mean_units"),
            F.avg("avg_price").alias("mean_price"),
        ).alias("s")
    ).scalar()
    n, mean_units, mean_price = (stats.getField(c) for c in ("n", "mean_units", "mean_price"))
    cut = F.ceil(n.cast("double") * F.lit(top_fraction))
    hits = ranked.filter(
        (F.col("revenue_rank") <= cut)
        & (F.col("profit") < 0)
        & (F.col("units_sold").cast("double") < mean_units)
        & (F.col("avg_price") > mean_price)
    )
    return hits.select(
        "revenue_rank", "product_id", "product_name", "category", "sub_category",
        money("revenue").alias("total_revenue"), "units_sold", money("profit").alias("total_profit"),
        pct("profit", "revenue", 1).alias("profit_margin_pct"), round_to("avg_price", 2).alias("avg_price"),
    ).orderBy("revenue_rank")


def break_even_products(star: Star, tolerance: float = 0.0) -> DataFrame:
    """A4: products with revenue > 0 and |profit| <= tolerance x revenue (exact zero by default)."""
    t = product_totals(star)
    cond = (F.col("revenue") > 0) & (
        F.abs(F.col("profit").cast("double")) <= F.lit(float(tolerance)) * F.col("revenue").cast("double")
    )
    return t.filter(cond).select(
        "product_id", "product_name", "category", "sub_category",
        money("revenue").alias("total_revenue"), "units_sold", money("profit").alias("total_profit"),
        pct("profit", "revenue", 2).alias("profit_margin_pct"),
    ).orderBy(F.col("total_revenue").desc(), "product_id")


def loss_making_top_n(star: Star, n: int = TOP_N_RANKING) -> DataFrame:
    """A5: rows of the top-n report with negative profit (before rounding)."""
    return _report_columns(_top_products(star, n).filter(F.col("profit") < 0)).orderBy("revenue_rank")


def top_n_mix(star: Star, n: int = TOP_N_RANKING) -> DataFrame:
    """How many top-n products each sub-category has, and their margin."""
    top = product_totals(star).orderBy(*_by_revenue()).limit(n)
    return (
        top.groupBy("category", "sub_category")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            money(F.sum("revenue")).alias("total_revenue"),
            money(F.sum("profit")).alias("total_profit"),
            margin_pct("profit", "revenue").alias("profit_margin_pct"),
        )
        .orderBy(F.col("product_count").desc(), F.col("total_revenue").desc(), "category", "sub_category")
    )


REPORTS = {
    "top_products_report": top_products_report,
    "discount_destruction": discount_destruction,
    "clearance_signature": clearance_signature,
    "loss_making_top_n": loss_making_top_n,
    "top_n_mix": top_n_mix,
}
