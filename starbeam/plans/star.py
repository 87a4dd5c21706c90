"""The star: a dataclass of DataFrames, the build pipeline, and the wide views.

``build_star`` runs E6-E11, E14, E15 on a clean order-line record.  The
resulting DataFrames are lazy except for the surrogate numbering, which
writes each keyed table once.  ``starbeam.sources.star_store`` writes and
publishes a star; queries read the published copy.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import discount_tier
from ..operators import dims as D
from ..operators import facts as X


@dataclass(frozen=True)
class Star:
    dim_date: DataFrame
    dim_customer: DataFrame
    dim_geography: DataFrame
    dim_product: DataFrame
    dim_ship_mode: DataFrame
    fact_orders: DataFrame
    dim_product_recommendations: DataFrame | None = None
    #: published roll-ups of exactly these facts by name (``operators.rollups``); None where there are none
    rollups: Mapping[str, DataFrame] | None = None

    def tables(self) -> dict[str, DataFrame]:
        names = [f.name for f in fields(self) if f.name != "rollups"]
        return {n: getattr(self, n) for n in names if getattr(self, n) is not None}

    def dims(self) -> dict[str, DataFrame]:
        return {k: v for k, v in self.tables().items() if k.startswith("dim_")}

    def with_(self, **kw) -> "Star":
        """A star with other tables; other facts have no roll-ups unless they are given too."""
        if "fact_orders" in kw:
            kw.setdefault("rollups", None)
        return replace(self, **kw)


def build_dimensions(clean: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_date": D.build_dim_date(clean),
        "dim_customer": D.build_dim_customer(clean),
        "dim_geography": D.build_dim_geography(clean),
        "dim_product": D.build_dim_product(clean),
        "dim_ship_mode": D.build_dim_ship_mode(clean),
    }


def build_star(clean: DataFrame) -> Star:
    """Clean order-line record (typed, with date keys) -> star."""
    if "order_date_key" not in clean.columns:
        from ..operators.clean import add_date_keys

        clean = add_date_keys(clean)
    dims = build_dimensions(clean)
    # the first load is an insert into an empty fact table: a repeated row_id keeps one row
    return Star(fact_orders=X.load_lines(X.empty_facts(clean.sparkSession), clean, dims), **dims)


def apply_increment(star: Star, clean: DataFrame) -> Star:
    """Load another clean batch into an existing star (a re-run of the load).

    Dates, geographies and ship modes are insert-if-absent (E13); customers
    and products are upserted, keeping their surrogate keys (E12); fact rows
    are resolved against the updated dimensions and inserted when their
    ``row_id`` is new (E15b).  Loading the same batch twice changes nothing.
    """
    dims, new_facts = increment(star, clean)
    return star.with_(fact_orders=star.fact_orders.unionByName(new_facts), **dims)


def increment(star: Star, clean: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """The updated dimensions and only the fact rows a batch adds (see ``apply_increment``)."""
    from ..operators.upsert import upsert_ignore, upsert_update

    if "order_date_key" not in clean.columns:
        from ..operators.clean import add_date_keys

        clean = add_date_keys(clean)
    dims = {
        "dim_date": upsert_ignore(star.dim_date, D.build_dim_date(clean), ["date_key"]),
        "dim_customer": upsert_update(star.dim_customer, clean.dropna(subset=["customer_id"]), ["customer_id"],
                                      ["customer_name", "segment"], "customer_key"),
        "dim_geography": upsert_ignore(star.dim_geography, clean, ["postal_code", "city", "state"],
                                       key_col="geography_key", order_col=D.ORDER_COL),
        "dim_product": upsert_update(star.dim_product, clean.dropna(subset=["product_id"]), ["product_id"],
                                     ["product_name", "category", "sub_category"], "product_key"),
        "dim_ship_mode": upsert_ignore(star.dim_ship_mode, clean.dropna(subset=["ship_mode"]), ["ship_mode"],
                                       key_col="ship_mode_key", order_col=D.ORDER_COL),
    }
    return dims, X.load_lines(star.fact_orders, clean, dims)


# ---------------------------------------------------------------- wide views

def vds_main(star: Star) -> DataFrame:
    """V1: fact joined to all five dimensions on the order date, 23 columns."""
    f = star.fact_orders
    d = star.dim_date.select(
        F.col("date_key").alias("order_date_key"),
        F.col("full_date").alias("order_date"),
        F.col("year").alias("order_year"),
        F.col("quarter").alias("order_quarter"),
        F.col("month").alias("order_month"),
        F.col("month_name").alias("order_month_name"),
    )
    j = (
        X.with_large_dims(f, {"customer_key": star.dim_customer.select("customer_key", "customer_name", "segment"),
                              "product_key": star.dim_product.select("product_key", "product_name", "category", "sub_category")})
        .join(d, "order_date_key")
        .join(star.dim_geography, "geography_key")
        .join(star.dim_ship_mode, "ship_mode_key")
    )
    return j.select(
        "order_line_key", "order_id", "row_id", "sales", "quantity", "discount", "profit",
        "revenue_after_discount", "order_date", "order_year", "order_quarter", "order_month",
        "order_month_name", "customer_name", "segment", "city", "state", "region", "country",
        "product_name", "category", "sub_category", "ship_mode",
    )


def vds_discount(star: Star) -> DataFrame:
    """V2: fact with product, customer and geography and the discount tier, 9 columns."""
    j = (
        star.fact_orders.join(star.dim_product, "product_key")
        .join(star.dim_customer, "customer_key")
        .join(star.dim_geography, "geography_key")
    )
    return j.select(
        "category", "sub_category", "discount", "sales", "profit", "quantity", "segment", "region",
        discount_tier(F.col("discount"), "ascii").alias("discount_tier"),
    )


def vds_recommendations(star: Star) -> DataFrame:
    """V3: recommendations with both product names and the load date."""
    r = star.dim_product_recommendations
    src = star.dim_product.select(
        F.col("product_key"),
        F.col("product_id").alias("source_product_id"),
        F.col("product_name").alias("source_product_name"),
    )
    rec = star.dim_product.select(
        F.col("product_key").alias("recommended_product_key"),
        F.col("product_id").alias("recommended_product_id"),
        F.col("product_name").alias("recommended_product_name"),
    )
    d = star.dim_date.select("date_key", F.col("full_date").alias("recommendation_date"))
    return r.join(src, "product_key").join(rec, "recommended_product_key").join(d, "date_key").select(
        "recommendation_key", "source_product_id", "source_product_name", "recommended_product_id",
        "recommended_product_name", "recommendation_type", "recommendation_score", "recommendation_reason",
        "recommendation_date",
    )
