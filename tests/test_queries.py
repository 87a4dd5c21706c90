"""Order-sensitive and cross-query properties of the business queries."""

from pyspark.sql import functions as F

from starbeam.plans import golden as GQ
from starbeam.plans.metrics import CHARTS, adhoc, dataset_frame, metric_query
from starbeam.plans.star import vds_discount, vds_main


def _sorted_ok(values, reverse=False):
    return values == sorted(values, reverse=reverse)


def test_gq03_top_customers_order(star):
    rows = GQ.top_customers(star).collect()
    assert len(rows) == 10
    assert _sorted_ok([r.total_profit for r in rows], reverse=True)


def test_gq05_only_losses_worst_first(star):
    rows = GQ.loss_states(star).collect()
    assert rows and all(r.total_profit < 0 for r in rows)
    assert _sorted_ok([r.total_profit for r in rows])


def test_gq06_margin_ascending(star):
    rows = GQ.subcategory_discount(star).collect()
    assert _sorted_ok([r.profit_margin_pct for r in rows])


def test_gq04_first_year_has_no_change(star):
    rows = GQ.yoy_trend(star).collect()
    assert rows[0].revenue_yoy_pct_change is None and rows[0].profit_yoy_pct_change is None
    assert all(r.revenue_yoy_pct_change is not None for r in rows[1:])


def test_gq09_ties_kept(star):
    rows = GQ.top_product_per_category(star).collect()
    cats = [r.category for r in rows]
    assert len(set(cats)) == len(star.dim_product.select("category").distinct().collect())


def test_kpi_equals_chart_totals(star):
    kpi = GQ.kpi_total(star).first()
    c1 = CHARTS["chart_revenue_kpi"](star).first().total_revenue
    by_region = CHARTS["chart_revenue_by_region"](star).agg(F.sum("total_revenue")).first()[0]
    assert round(c1, 2) == kpi.total_revenue
    assert by_region == c1  # DECIMAL sums are exact


def test_metric_join_pruning_equals_full_view(star):
    pruned = metric_query(star, metrics=["total_revenue", "order_count"], groupby=["region"])
    full = vds_main(star).groupBy("region").agg(
        F.sum("sales").cast("double").alias("total_revenue"), F.countDistinct("order_id").alias("order_count")
    )
    assert pruned.exceptAll(full.select(*pruned.columns)).count() == 0
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "product_name" not in plan and "customer_name" not in plan


def test_discount_dataset_pruning_and_tier_filter(star):
    heavy = metric_query(star, "discount", [adhoc("SUM", "profit", "Total Profit")], groupby=["region"],
                         filters=[("discount_tier", "==", "Heavy (>20%)")])
    full = vds_discount(star).filter(F.col("discount_tier") == "Heavy (>20%)").groupBy("region").agg(
        F.sum("profit").cast("double").alias("total_profit"))
    assert heavy.exceptAll(full).count() == 0
    cols = dataset_frame(star, "discount", ["region", "profit"]).columns
    assert cols == ["region", "profit"]


def test_row_limit_and_order(star):
    rows = CHARTS["chart_states_region"](star).collect()
    assert len(rows) <= 50 and _sorted_ok([r.total_revenue for r in rows])
    top = CHARTS["chart_top_customers"](star).collect()
    assert len(top) == 10 and _sorted_ok([r.total_profit for r in top], reverse=True)


def test_default_order_first_measure_desc(spark, fx):
    from starbeam.plans.catalog import QUERIES
    from tests.conftest import SMOKE

    rows = QUERIES["default_order"](spark, SMOKE).collect()
    assert _sorted_ok([r.total_revenue for r in rows], reverse=True)
