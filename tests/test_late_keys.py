"""Keys of dimensions too large to broadcast are sent to the ranges of row id; the lines are not shuffled by customer or product."""

import pytest
from test_facts import rows

from starbeam.operators import facts as FA
from starbeam.plans.star import apply_increment, build_star


def lines(spark, ids):
    """Lines of five customers and seven products, some without one, some row ids repeated."""
    return rows(spark, [{"row_id": i, "order_id": f"O{n % 9}", "customer_id": None if n % 11 == 3 else f"C{n % 5}",
                         "product_id": None if n % 13 == 4 else f"P{n % 7}", "quantity": n} for n, i in enumerate(ids)])


def contents(star):
    return {name: sorted(map(str, df.collect())) for name, df in star.tables().items()}


@pytest.fixture
def incoming(spark, monkeypatch):
    """Every dimension beyond the broadcast bound; gives the rows that ``new_facts`` was called with."""
    seen, new_facts = [], FA.new_facts

    def spy(existing, rows, *args):
        seen.append(rows)
        return new_facts(existing, rows, *args)

    monkeypatch.setattr(FA, "few_rows", lambda df: False, raising=False)
    monkeypatch.setattr(FA, "broadcast_within", lambda df: df)
    monkeypatch.setattr(FA, "new_facts", spy)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield seen
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_are_not_shuffled_by_customer_or_product(spark, incoming):
    build_star(lines(spark, range(60)))
    plan = incoming[0]._jdf.queryExecution().executedPlan().toString()
    moved = [p for p in plan.splitlines() if "Exchange hashpartitioning(" in p]
    assert moved and not [p for p in moved if "customer_id" in p or "product_id" in p]


@pytest.mark.parametrize("ids", [[None, *range(60), 7, 7, 30], [*range(60), 10**9]], ids=["even", "uneven"])
def test_late_keys_are_those_of_a_broadcast(spark, request, ids):
    later = [*range(50, 90), 8]
    first, second = lines(spark, ids), lines(spark, later)
    star = build_star(first)
    want = contents(star), contents(apply_increment(star, second))
    request.getfixturevalue("incoming")
    star = build_star(first)
    assert (contents(star), contents(apply_increment(star, second))) == want
    assert 0 < star.fact_orders.count() < 60


def test_ranges_follow_the_lines(spark, monkeypatch):
    """More lines than the partitions' share are dealt into more ranges, with the same facts."""
    df = lines(spark, range(90))
    want = contents(build_star(df))
    made, assign = [], FA.assign_surrogate_keys

    def spy(rows, order, key, **kw):
        made.append(kw["num_partitions"])
        return assign(rows, order, key, **kw)

    monkeypatch.setattr(FA, "assign_surrogate_keys", spy)
    monkeypatch.setattr(FA, "RANGE_ROWS", 10)
    assert contents(build_star(df)) == want
    assert made == [9]
