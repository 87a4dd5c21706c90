"""GQ-01 .. GQ-10: the ten golden business queries as DataFrame functions.

Each takes a ``Star`` and returns the ordered result.  Money is rounded to
cents, percentages to 2 decimals, day averages to 1 (see
``starbeam.functions.measures``).  Sorts spell out PostgreSQL's NULL order,
and every LIMIT has a unique tie-break so the kept rows are determined.

Queries whose measures are additive first roll the fact up on the foreign
keys they need (``rollup``) and join the dimension to those partial sums.
Sums of DECIMAL sums are exact, so results are unchanged; the join then
sees one row per key and task instead of every order line, which matters
when a dimension is too large to broadcast and the join has to shuffle.
Orders are counted by bitmaps of their numbers where the groups come from
small dimensions (GQ-05, GQ-07; ``operators.distinct``); by customer (GQ-03,
GQ-08) the query joins first and counts distinct ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import days, discount_tier, margin_pct, money, pct, round_to, safe_ratio
from ..operators.distinct import ORDER_NO, block, orders_seen, united_orders, with_orders
from .star import Star


def rollup(fact: DataFrame, keys: list, **aggs) -> DataFrame:
    """The fact pre-aggregated on ``keys`` (foreign keys or fact expressions)."""
    return fact.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def kpi_total(star: Star) -> DataFrame:
    """GQ-01: total revenue, profit and margin."""
    return star.fact_orders.agg(
        money(F.sum("sales")).alias("total_revenue"),
        money(F.sum("profit")).alias("total_profit"),
        margin_pct().alias("profit_margin_pct"),
    )


def category_margin(star: Star) -> DataFrame:
    """GQ-02: revenue, profit and margin per category, revenue first."""
    per_product = rollup(star.fact_orders, ["product_key"], sales=F.sum("sales"), profit=F.sum("profit"))
    return (
        per_product.join(star.dim_product.select("product_key", "category"), "product_key")
        .groupBy("category")
        .agg(
            money(F.sum("sales")).alias("total_revenue"),
            money(F.sum("profit")).alias("total_profit"),
            margin_pct().alias("profit_margin_pct"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_first(), "category")
    )


def top_customers(star: Star, n: int = 10) -> DataFrame:
    """GQ-03: top customers by profit; customers sharing a name and segment merge."""
    return (
        star.fact_orders.join(star.dim_customer, "customer_key")
        .groupBy("customer_name", "segment")
        .agg(
            money(F.sum("profit")).alias("total_profit"),
            money(F.sum("sales")).alias("total_revenue"),
            F.countDistinct("order_id").alias("number_of_orders"),
        )
        .orderBy(F.col("total_profit").desc_nulls_first(), "customer_name", "segment")
        .limit(n)
    )


def yoy_trend(star: Star) -> DataFrame:
    """GQ-04: revenue and profit per order year with the change from the year before."""
    per_day = rollup(star.fact_orders, ["order_date_key"], sales=F.sum("sales"), profit=F.sum("profit"))
    yearly = (
        per_day.join(star.dim_date.select(F.col("date_key").alias("order_date_key"), "year"), "order_date_key")
        .groupBy("year")
        .agg(F.sum("sales").alias("revenue"), F.sum("profit").alias("profit"))
    )
    # one row per year: the unpartitioned window runs over a handful of rows
    w = Window.orderBy("year")

    def change(c: str):
        prev = F.lag(c).over(w)
        return pct(F.col(c) - prev, prev)

    return yearly.select(
        "year",
        money("revenue").alias("total_revenue"),
        money("profit").alias("total_profit"),
        change("revenue").alias("revenue_yoy_pct_change"),
        change("profit").alias("profit_yoy_pct_change"),
    ).orderBy("year")


def loss_states(star: Star) -> DataFrame:
    """GQ-05: (state, region) groups with negative total profit, worst first."""
    if ORDER_NO in star.fact_orders.columns:
        per_place = star.fact_orders.groupBy("geography_key", block()).agg(
            orders_seen().alias("_orders"), F.sum("sales").alias("_rev"), F.sum("profit").alias("_profit"))
        placed = per_place.join(star.dim_geography.select("geography_key", "state", "region"), "geography_key")
        states = united_orders(placed, ["state", "region"], "order_count", ["_rev", "_profit"])
    else:
        states = star.fact_orders.join(star.dim_geography, "geography_key").groupBy("state", "region").agg(
            F.sum("sales").alias("_rev"), F.sum("profit").alias("_profit"), F.countDistinct("order_id").alias("order_count"))
    return (
        states
        .filter(F.col("_profit") < 0)
        .select(
            "state", "region",
            money("_rev").alias("total_revenue"),
            money("_profit").alias("total_profit"),
            "order_count",
        )
        .orderBy(F.col("total_profit").asc_nulls_last(), "state", "region")
    )


def subcategory_sums(star: Star) -> DataFrame:
    """Unrounded sums per sub-category: disc and n_disc (discounts and their count), sales, profit."""
    per_product = rollup(
        star.fact_orders, ["product_key"], disc=F.sum("discount"), n_disc=F.count("discount"),
        sales=F.sum("sales"), profit=F.sum("profit"),
    )
    return (
        per_product.join(star.dim_product.select("product_key", "category", "sub_category"), "product_key")
        .groupBy("category", "sub_category")
        .agg(*[F.sum(c).alias(c) for c in ("disc", "n_disc", "sales", "profit")])
    )


def subcategory_columns() -> list[Column]:
    """The published measures of ``subcategory_sums``."""
    return [
        round_to(safe_ratio("disc", "n_disc") * 100, 2).alias("avg_discount_pct"),
        money("sales").alias("total_revenue"),
        money("profit").alias("total_profit"),
        pct("profit", "sales").alias("profit_margin_pct"),
    ]


def subcategory_discount(star: Star) -> DataFrame:
    """GQ-06: average discount and margin per sub-category, lowest margin first."""
    return subcategory_sums(star).select("category", "sub_category", *subcategory_columns()).orderBy(
        F.col("profit_margin_pct").asc_nulls_last(), "category", "sub_category")


def ship_mode_efficiency(star: Star) -> DataFrame:
    """GQ-07: per ship mode: lines, orders, average profit and sales per line, days to ship."""
    order_d = star.dim_date.select(F.col("date_key").alias("order_date_key"), F.col("full_date").alias("_od"))
    ship_d = star.dim_date.select(F.col("date_key").alias("ship_date_key"), F.col("full_date").alias("_sd"))
    lines = (
        star.fact_orders.join(star.dim_ship_mode, "ship_mode_key")
        .join(order_d, "order_date_key")
        .join(ship_d, "ship_date_key")
        .withColumn("_days", F.datediff(F.col("_sd"), F.col("_od")))
    )
    measured = ("profit", "sales", "_days")
    sums = {f"{c}_sum": F.sum(c) for c in measured} | {f"{c}_n": F.count(c) for c in measured} | {"order_line_count": F.count(F.lit(1))}
    if ORDER_NO in star.fact_orders.columns:
        modes = with_orders(lines, ["ship_mode"], "unique_orders", **sums)
    else:
        modes = lines.groupBy("ship_mode").agg(F.countDistinct("order_id").alias("unique_orders"), *[c.alias(n) for n, c in sums.items()])
    return modes.select(
        "ship_mode", "order_line_count", "unique_orders",
        round_to(safe_ratio("profit_sum", "profit_n"), 2).alias("avg_profit_per_line"),
        round_to(safe_ratio("sales_sum", "sales_n"), 2).alias("avg_revenue_per_line"),
        days(safe_ratio("_days_sum", "_days_n")).alias("avg_days_to_ship"),
    ).orderBy(F.col("avg_profit_per_line").desc_nulls_first(), "ship_mode")


def segment_quarterly(star: Star) -> DataFrame:
    """GQ-08: revenue, profit and orders per (year, quarter, segment)."""
    return (
        star.fact_orders.join(star.dim_date, F.col("order_date_key") == F.col("date_key"))
        .join(star.dim_customer, "customer_key")
        .groupBy("year", "quarter", "segment")
        .agg(
            money(F.sum("sales")).alias("total_revenue"),
            money(F.sum("profit")).alias("total_profit"),
            F.countDistinct("order_id").alias("order_count"),
        )
        .orderBy("year", "quarter", "segment")
    )


def top_product_per_category(star: Star) -> DataFrame:
    """GQ-09: per category the product name(s) with the highest rounded revenue (ties kept)."""
    by_key = rollup(star.fact_orders, ["product_key"], sales=F.sum("sales"), profit=F.sum("profit"),
                    quantity=F.sum("quantity"))
    per_product = (
        by_key.join(star.dim_product.select("product_key", "category", "product_name"), "product_key")
        .groupBy("category", "product_name")
        .agg(
            money(F.sum("sales")).alias("total_revenue"),
            money(F.sum("profit")).alias("total_profit"),
            F.sum("quantity").cast("long").alias("total_units_sold"),
        )
    )
    w = Window.partitionBy("category").orderBy(F.col("total_revenue").desc_nulls_first())
    return (
        per_product.withColumn("_rank", F.rank().over(w))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
        .orderBy(F.col("total_revenue").desc_nulls_first(), "category", "product_name")
    )


def discount_tier_matrix(star: Star) -> DataFrame:
    """GQ-10: lines, revenue, profit and margin per discount tier x segment x region, worst first."""
    # joined first: (tier, customer, geography) has nearly as many values as the fact has rows, the final groups are few
    return (
        star.fact_orders.withColumn("discount_tier", discount_tier("discount", "golden"))
        .join(star.dim_customer.select("customer_key", "segment"), "customer_key")
        .join(star.dim_geography.select("geography_key", "region"), "geography_key")
        .groupBy("discount_tier", "segment", "region")
        .agg(
            F.count(F.lit(1)).alias("order_line_count"),
            money(F.sum("sales")).alias("total_revenue"),
            money(F.sum("profit")).alias("total_profit"),
            margin_pct().alias("profit_margin_pct"),
        )
        .orderBy(F.col("total_profit").asc_nulls_last(), "discount_tier", "segment", "region")
    )


GOLDEN = {
    "kpi_total": kpi_total,
    "category_margin": category_margin,
    "top_customers": top_customers,
    "yoy_trend": yoy_trend,
    "loss_states": loss_states,
    "subcategory_discount": subcategory_discount,
    "ship_mode_efficiency": ship_mode_efficiency,
    "segment_quarterly": segment_quarterly,
    "top_product_per_category": top_product_per_category,
    "discount_tier_matrix": discount_tier_matrix,
}
