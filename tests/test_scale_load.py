"""The load and the wide view sort and shuffle the lines no more than they must."""

import re

from test_late_keys import lines
from test_load_steps import tables  # noqa: F401

from starbeam.operators import facts as FA
from starbeam.operators import numbering as NU
from starbeam.plans.star import build_star, vds_main
from starbeam.sources import fixture as FX


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def contents(df):
    return sorted(map(str, df.collect()))


def test_no_sort_begins_with_the_number_of_a_range(spark, tables, monkeypatch):  # noqa: F811
    monkeypatch.setattr(FX, "few_rows", lambda df: False)
    monkeypatch.setattr(FA, "few_rows", lambda df: False)
    made, deal = [], NU.dealt_by_range
    monkeypatch.setattr(NU, "dealt_by_range", lambda *a: made.append(deal(*a)) or made[-1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        # one of several keys; the ranges themselves are sorted by it alone
        assert not re.search(r"Sort \[_sb_pid#\d+ ASC NULLS FIRST, ", plan(FX.flat_orders(spark, tables)))
        build_star(lines(spark, range(60)))
        assert made and all("Sort [" not in plan(df).split("ShuffledHashJoin")[0] and "ShuffledHashJoin" in plan(df) for df in made)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_wide_view_shuffles_the_facts_once(spark, monkeypatch):
    star = build_star(lines(spark, range(60)))
    want = contents(vds_main(star))
    assert len(want) > 40
    monkeypatch.setattr(FA, "few_rows", lambda df: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = vds_main(star.with_(dim_product=star.dim_product.unionByName(star.dim_product.filter("product_key = 1"))))
        assert plan(got).count("ShuffledHashJoin") == 2
        more = contents(got)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert set(more) == set(want) and len(more) > len(want)  # a key held twice joins twice, as in any join
