"""Roll-ups: answers from them are those of the fact, through increments and changed dimensions."""

import pytest
from pyspark.sql import functions as F

from starbeam.operators.rollups import ROLL_UPS
from starbeam.plans.metrics import CHARTS, NAMED_METRICS, adhoc, metric_query
from starbeam.plans.star import build_star, increment
from starbeam.session import new_path
from starbeam.sources.fixture import order_batches
from starbeam.sources.star_store import publish_increment, publish_recommendations, publish_star, read_star

REQUESTS = {
    **{f"metric {m}": dict(metrics=[m]) for m in NAMED_METRICS},
    **{f"by {c}": dict(metrics=["total_revenue", "profit_margin_pct", "total_discount_impact", "total_quantity",
                                "revenue_after_discount"], groupby=[c])
       for c in ("customer_name", "segment", "state", "sub_category", "ship_mode", "order_year", "order_month_name")},
    "segment by quarter": dict(metrics=["total_profit"], groupby=["segment"], time_col="order_date", grain="P3M"),
    "days of a year": dict(metrics=["total_revenue"], filters=[("order_year", "==", 1996)], time_col="order_date", grain="P1D"),
    "filtered customers": dict(metrics=["total_revenue"], groupby=["order_year"],
                               filters=[("segment", "IN", ["BUILDING", "Consumer"]), ("order_year", ">", 1994)]),
    "filter alone": dict(metrics=["total_revenue"], filters=[("category", "!=", "none")]),
    "none left": dict(metrics=["total_revenue"], filters=[("segment", "==", "nobody")]),
    "averages": dict(dataset="discount", metrics=[adhoc("AVG", "discount"), adhoc("COUNT", "quantity"), adhoc("SUM", "sales")],
                     groupby=["category", "sub_category"]),
}
FROM_FACT = {
    "two dimensions, no such roll-up": dict(metrics=["total_revenue"], groupby=["segment", "region"]),
    "orders": dict(metrics=["order_count"], groupby=["ship_mode"]),
    "tier": dict(dataset="discount", metrics=[adhoc("SUM", "profit")], groupby=["discount_tier"]),
    "extremes": dict(metrics=[adhoc("MAX", "sales")], groupby=["ship_mode"]),
    "column of the fact": dict(metrics=["total_revenue"], filters=[("quantity", ">", 10)]),
}


def _files(df):
    return {p for f in df.inputFiles() for p in f.split("/") if p == "fact_orders" or p.startswith("roll_up=")}


def _agree(star, request):
    got = metric_query(star, **request)
    want = metric_query(star.with_(rollups=None), **request)
    assert got.columns == want.columns
    rows = [[tuple(float(v) if hasattr(v, "as_tuple") else v for v in r) for r in d.collect()] for d in (got, want)]
    assert len(rows[0]) == len(rows[1])
    for g, w in zip(*rows):  # sums of DECIMALs are exact, so rows and their order are the same
        assert g == pytest.approx(w, rel=1e-12) if all(isinstance(v, float) for v in g) else g == w
    return got


@pytest.mark.parametrize("name", REQUESTS)
def test_answers_agree_with_the_fact(star, name):
    got = _agree(star, REQUESTS[name])
    held = not any(NAMED_METRICS[m].stored is None for m in REQUESTS[name]["metrics"] if isinstance(m, str))
    assert ("fact_orders" not in _files(got)) == held


@pytest.mark.parametrize("name", FROM_FACT)
def test_other_requests_read_the_fact(star, name):
    assert "fact_orders" in _files(_agree(star, FROM_FACT[name]))


def test_the_smallest_is_read(star):
    def read(**request):
        return {f for f in _files(metric_query(star, **request)) if f.startswith("roll_up=")}

    assert read(metrics=["total_revenue"], groupby=["segment"]) == {"roll_up=customer"}
    assert read(metrics=["total_revenue"], groupby=["segment", "order_year"]) == {"roll_up=day_customer"}
    assert read(metrics=["total_revenue"], groupby=["category"]) == {"roll_up=product"}
    for key in ("revenue_kpi", "profit_kpi", "annual_trend", "revenue_by_region", "category", "top_customers", "segment_quarter"):
        assert "fact_orders" not in _files(CHARTS[f"chart_{key}"](star)), key


def test_each_roll_up_sums_the_fact(star):
    want = star.fact_orders.agg(F.count(F.lit(1)), F.sum("sales"), F.sum(F.col("sales") * F.col("discount"))).first()
    for name, keys in ROLL_UPS.items():
        df = star.rollups[name]
        assert df.count() == star.fact_orders.select(*keys).distinct().count(), name
        assert df.filter(F.greatest(*[F.col(k).isNull().cast("int") for k in (*keys, keys[0])]) > 0).isEmpty()
        assert tuple(df.agg(F.sum("lines"), F.sum("sales"), F.sum("discount_given")).first()) == tuple(want), name


def test_other_facts_have_no_roll_ups(star):
    assert star.rollups and star.with_(dim_date=star.dim_date).rollups
    assert star.with_(fact_orders=star.fact_orders.limit(1)).rollups is None


def test_increments_changed_dimensions_and_stars_without(spark, fx):
    first, second = order_batches(fx.flat)
    built = build_star(first)
    for rollups in (True, False):
        root = new_path(spark, "rolled-star")
        publish_star(built, root, rollups=rollups)
        star = read_star(spark, root)
        assert bool(star.rollups) == rollups
        # every customer of the second batch changes segment: no roll-up holds it
        dims, added = increment(star, second.withColumn("segment", F.lit("Changed")))
        publish_increment(star.with_(**dims), added, root)
        star = read_star(spark, root)
        assert bool(star.rollups) == rollups
        if not rollups:
            continue
        for request in (REQUESTS["by segment"], REQUESTS["segment by quarter"], REQUESTS["by order_year"], REQUESTS["averages"]):
            assert "fact_orders" not in _files(_agree(star, request))
        # the same batch again adds no facts and no roll-up rows
        dims, added = increment(star, second)
        publish_increment(star.with_(**dims), added, root)
        again = read_star(spark, root)
        _agree(again, REQUESTS["by segment"])
        publish_recommendations(again, root)
        assert read_star(spark, root).rollups
