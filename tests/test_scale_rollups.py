"""Roll-ups are written when a query reads them, and only those."""

from pathlib import Path

from test_load_steps import tables  # noqa: F401

from starbeam.plans.metrics import CHARTS, metric_query
from starbeam.warehouse import Fixture


def contents(df):
    return sorted(map(str, df.collect()))


def rollups_read(df):
    return {p for f in df.inputFiles() for p in f.split("/") if p.startswith("roll_up=")}


def rolled_up(fx):
    found = Path(fx.star_root.removeprefix("file:")).glob("*/rollups/roll_up=*")
    return {p.name.removeprefix("roll_up=") for p in found}


def test_roll_ups_are_written_when_they_are_read(spark, tables):  # noqa: F811
    fx = Fixture(spark, tables)
    for name in ("chart_ship_mode", "chart_profit_by_state"):
        assert contents(CHARTS[name](fx.rolled)) == contents(CHARTS[name](fx.facts))
    assert contents(metric_query(fx.rolled, metrics=["order_count"])) == contents(metric_query(fx.facts, metrics=["order_count"]))
    assert rolled_up(fx) == set()
    got = CHARTS["chart_segment_quarter"](fx.rolled)
    assert rollups_read(got) == {"roll_up=day_customer"} and rolled_up(fx) == {"day_customer"}
    assert contents(got) == contents(CHARTS["chart_segment_quarter"](fx.facts))
    got = CHARTS["chart_category"](fx.rolled)
    assert rollups_read(got) == {"roll_up=product"} and contents(got) == contents(CHARTS["chart_category"](fx.facts))
    assert len(fx.star.rollups) == 6 and len(fx.rollups) == 6


def test_empty_facts_have_no_roll_ups_to_read(spark, tables):  # noqa: F811
    from starbeam.operators.rollups import OnDemand

    facts = Fixture(spark, tables).facts
    none = facts.with_(fact_orders=facts.fact_orders.limit(0), rollups=OnDemand(lambda names: {}))
    assert contents(metric_query(none, groupby=["segment"])) == [] and not none.rollups
