"""Ranks and lags over groups of any size, and order counts by bitmaps, against windows and distinct counts."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starbeam.operators.distinct import ORDER_NO, number_orders, with_orders
from starbeam.operators.facts import new_facts
from starbeam.operators.ranking import RANKS, lagged, ranked
from starbeam.plans.golden import loss_states, ship_mode_efficiency
from starbeam.plans.metrics import NAMED_METRICS, adhoc, metric_query


def _rows(spark, n=600, seed=1):
    """A group with most rows, some small ones, a null one; few different values, so ties run over partitions' ends."""
    rng = random.Random(seed)
    groups = ["hot"] * 12 + ["a", "b", "c", None]
    rows = [(i, rng.choice(groups), rng.choice([None, *range(9)])) for i in range(n)]
    return spark.createDataFrame(rows, "id int, g string, v int")


@pytest.mark.parametrize("group", [["g"], []])
@pytest.mark.parametrize("parts", [1, 7, 40])
def test_ranked_equals_windows(spark, group, parts):
    df = _rows(spark)
    w = Window.partitionBy(*group).orderBy(F.col("v").desc_nulls_last())
    want = df.withColumns({"rank": F.rank().over(w).cast("long"), "dense_rank": F.dense_rank().over(w).cast("long")})
    got = ranked(df, group, [F.col("v").desc_nulls_last()], ("rank", "dense_rank"), parts)
    assert got.columns == want.columns
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    total = Window.partitionBy(*group).orderBy("v", "id")
    numbered = ranked(df, group, ["v", "id"], RANKS, parts).collect()
    assert sorted((r.id, r.row_number) for r in numbered) == sorted(
        (r.id, r.n) for r in df.withColumn("n", F.row_number().over(total)).collect())
    assert all(r["rank"] == r.dense_rank == r.row_number for r in numbered)  # no ties in a total order


def test_a_hot_group_spreads(spark):
    """Rows of one group with different values lie in all range partitions."""
    from starbeam.operators.ranking import _PID, _laid_out

    df = spark.range(2000).withColumn("g", F.lit("one"))
    held = _laid_out(df, ["g"], ["id"], 8).groupBy(_PID).count().collect()
    assert len(held) == 8 and max(r["count"] for r in held) < 600


def test_ranked_awkward(spark):
    assert ranked(_rows(spark).limit(0), ["g"], ["v"]).count() == 0
    one = spark.createDataFrame([(1, "x", 1)] * 50, "id int, g string, v int")  # ties alone
    assert {(r["rank"], r.dense_rank) for r in ranked(one, ["g"], ["v"], ("rank", "dense_rank"), 5).collect()} == {(1, 1)}
    with pytest.raises(ValueError, match="ntile"):
        ranked(one, ["g"], ["v"], ("ntile",))


@pytest.mark.parametrize("group", [["g"], []])
@pytest.mark.parametrize("parts", [1, 7, 40])
def test_lagged_equals_lag(spark, group, parts):
    df = _rows(spark, seed=2)
    w = Window.partitionBy(*group).orderBy("id")
    want = df.withColumn("before", F.lag("v").over(w))
    got = lagged(df, group, ["id"], "v", "before", parts)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_orders_keep_their_numbers(spark, star):
    facts = star.fact_orders
    orders = facts.groupBy("order_id").agg(F.countDistinct(ORDER_NO).alias("n"), F.min(ORDER_NO).alias("no"), F.min("row_id").alias("first"))
    rows = orders.orderBy("first").collect()
    assert all(r.n == 1 for r in rows)
    assert [r.no for r in rows] == list(range(1, len(rows) + 1))  # dense, by first row


def test_increments_number_new_orders_only(spark, star):
    facts = star.fact_orders.filter("row_id <= 400")
    old, new = facts.filter("row_id <= 250"), facts.filter("row_id > 200").drop("order_line_key")
    added = new_facts(old, new)
    both = old.unionByName(added)
    per = both.groupBy("order_id").agg(F.countDistinct(ORDER_NO).alias("n")).filter("n <> 1")
    assert per.count() == 0
    top = old.agg(F.max(ORDER_NO)).first()[0]
    fresh = added.join(old.select("order_id").distinct(), "order_id", "left_anti")
    assert fresh.agg(F.min(ORDER_NO)).first()[0] == top + 1
    # facts without numbers stay without
    assert ORDER_NO not in new_facts(old.drop(ORDER_NO), new).columns


def test_rows_without_an_order_stay(spark, star):
    rows = star.fact_orders.limit(20).withColumn("order_id", F.when(F.col("row_id") % 2 == 0, F.col("order_id"))).drop(ORDER_NO)
    got = number_orders(star.fact_orders.limit(0), rows)
    assert got.count() == 20 and got.filter("order_id IS NULL").filter(f"{ORDER_NO} IS NOT NULL").count() == 0


def test_bitmap_counts_over_several_blocks(spark):
    rows = spark.range(200_000).selectExpr("id % 3 AS g", "id % 70001 AS order_no", "1 AS one")
    got = {r.g: (r.orders, r.lines) for r in with_orders(rows, ["g"], "orders", lines=F.sum("one")).collect()}
    want = rows.groupBy("g").agg(F.countDistinct("order_no").alias("n"), F.count(F.lit(1)).alias("c")).collect()
    assert got == {r.g: (r.n, r.c) for r in want}


REQUESTS = [
    {"metrics": ["order_count"]},
    {"metrics": ["avg_order_value"]},
    {"metrics": ["total_revenue", "order_count", adhoc("MIN", "profit"), adhoc("MAX", "profit")], "groupby": ["region"]},
    {"metrics": ["order_count", "avg_order_value", "profit_margin_pct"], "groupby": ["ship_mode"], "filters": [("ship_mode", "!=", "5-LOW")]},
    {"metrics": ["order_count"], "time_col": "order_date", "grain": "P3M"},
    {"metrics": ["order_count"], "groupby": ["segment"]},
]


@pytest.mark.parametrize("request_", REQUESTS)
def test_metrics_agree_with_and_without_numbers(spark, star, request_):
    plain = star.with_(fact_orders=star.fact_orders.drop(ORDER_NO))
    assert metric_query(star, **request_).collect() == metric_query(plain, **request_).collect()


def test_golden_queries_agree_with_and_without_numbers(spark, star):
    plain = star.with_(fact_orders=star.fact_orders.drop(ORDER_NO))
    for query in (loss_states, ship_mode_efficiency):
        assert query(star).collect() == query(plain).collect()


def test_no_shuffle_by_order(spark, star):
    """Counts of orders group by blocks of numbers; no plan shuffles order ids."""
    for df in (loss_states(star), ship_mode_efficiency(star), metric_query(star, metrics=["order_count"], groupby=["state", "region"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "bitmap_construct_agg" in plan and "order_id" not in plan
    assert NAMED_METRICS["order_count"].counts_orders
