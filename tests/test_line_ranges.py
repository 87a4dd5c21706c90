"""The order-line record is made in ranges of order key: no prefix sum over orders, no line shuffled by part."""

import pytest
from pyspark.sql import functions as F
from test_load_steps import tables  # noqa: F401

from starbeam.sources import fixture as FX


def record(spark, folder):
    return sorted(map(str, FX.flat_orders(spark, folder).collect()))


def exchanges(df):
    return [p for p in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(" in p]


@pytest.fixture
def by_order(spark, tables, monkeypatch):  # noqa: F811
    """The record by shuffles on the order key, the way of uneven keys."""
    with monkeypatch.context() as m:
        m.setattr(FX, "_lines_by_range", lambda *a: None)
        return record(spark, tables)


@pytest.mark.parametrize("few", [True, False])
def test_ranges_give_the_record_of_a_shuffle(spark, tables, by_order, monkeypatch, few):  # noqa: F811
    monkeypatch.setattr(FX, "few_rows", lambda df: few)
    if not few:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert record(spark, tables) == by_order and by_order
        plan = FX.flat_orders(spark, tables)
        assert "prefix-" not in plan._jdf.queryExecution().executedPlan().toString()
        # a line's columns never meet a hash of its order or its part
        assert not [p for p in exchanges(plan) if "l_orderkey" in p or "l_partkey" in p]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_parts_and_orders_repeat_their_lines_only(spark, tables, tmp_path):  # noqa: F811
    folder = str(tmp_path)
    for name in ("region", "nation", "customer", "part", "orders", "lineitem"):
        df = spark.read.parquet(f"{tables}/{name}.parquet")
        if name in ("part", "orders"):
            df = df.unionByName(df.filter(F.col(df.columns[0]) == 1))
        df.write.parquet(f"{folder}/{name}.parquet")
    once = {r.row_id for r in FX.flat_orders(spark, tables).collect()}
    twice = FX.flat_orders(spark, folder).collect()
    assert {r.row_id for r in twice} == once and len(twice) > len(once)


def test_uneven_order_keys_go_by_shuffles(spark, tables, tmp_path):  # noqa: F811
    folder = str(tmp_path)
    far = F.when(F.col("l_orderkey") == 0, 10**15).otherwise(F.col("l_orderkey")).alias("l_orderkey")
    for name in ("region", "nation", "customer", "part", "orders", "lineitem"):
        df = spark.read.parquet(f"{tables}/{name}.parquet")
        if name == "lineitem":
            df = df.select(far, *df.columns[1:])
        df.write.parquet(f"{folder}/{name}.parquet")
    assert record(spark, folder)
    assert [p for p in exchanges(FX.flat_orders(spark, folder)) if "l_orderkey" in p]
