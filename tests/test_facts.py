import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from starbeam.operators import facts as FA
from starbeam.operators.clean import add_date_keys
from starbeam.plans.star import build_dimensions, build_star

COLS = ("row_id long, order_id string, order_date date, ship_date date, ship_mode string, customer_id string, "
        "customer_name string, segment string, country string, city string, state string, postal_code string, "
        "region string, product_id string, category string, sub_category string, product_name string, "
        "sales decimal(12,4), quantity int, discount decimal(5,4), profit decimal(12,4)")


def rows(spark, specs):
    base = dict(order_id="O1", order_date=dt.date(2016, 1, 4), ship_date=dt.date(2016, 1, 9), ship_mode="First",
                customer_id="C1", customer_name="Ann", segment="Consumer", country="United States", city="Boston",
                state="MA", postal_code=None, region="East", product_id="P1", category="Office", sub_category="Art",
                product_name="Pen", sales=Decimal("10.0000"), quantity=1, discount=Decimal("0.0000"),
                profit=Decimal("1.0000"))
    names = [c.split()[0] for c in COLS.split(", ")]
    return spark.createDataFrame([tuple({**base, **s}[c] for c in names) for s in specs], COLS)


def test_revenue_after_discount_rounds_half_up(spark):
    df = rows(spark, [{"row_id": 1, "sales": Decimal("10.0005"), "discount": Decimal("0.5000")}])
    star = build_star(df)
    r = star.fact_orders.first()
    # 10.0005 * 0.5 = 5.00025 -> 5.0003
    assert r.revenue_after_discount == Decimal("5.0003")
    assert r.order_line_key == 1 and r.order_date_key == 20160104


def test_null_postal_code_resolves_and_missing_dims_skip(spark):
    df = rows(spark, [{"row_id": 1}, {"row_id": 2, "customer_id": "C2"}, {"row_id": 3, "product_id": "P9"}])
    clean = add_date_keys(df)
    dims = build_dimensions(clean.filter(F.col("row_id") == 1))
    assert FA.resolve_keys(clean, dims).count() == 1
    s = FA.skipped_counts(clean, dims).first()
    assert (s.skipped_rows, s.missing_customer, s.missing_product, s.missing_geography) == (2, 1, 1, 0)
    assert sorted(r.row_id for r in FA.skipped_rows(clean, dims).collect()) == [2, 3]


def test_loaded_plus_skipped_equals_input(spark, fx):
    from starbeam.operators.clean import clean_orders, reject_counts
    from starbeam.sources.fixture import raw_orders

    raw = raw_orders(fx.flat)
    clean = clean_orders(raw)
    dims = build_dimensions(clean)
    loaded = FA.resolve_keys(clean, dims).count()
    skipped = FA.skipped_counts(clean, dims).first().skipped_rows
    rej = reject_counts(raw).first()
    assert loaded + skipped == rej.clean_rows
    assert rej.raw_rows - rej.duplicate_rows - rej.dropped_rows == rej.clean_rows


def test_fact_load_twice_equals_once(spark, star):
    facts = star.fact_orders.drop("order_line_key")
    once = FA.load_facts(star.fact_orders, facts)
    assert once.count() == star.fact_orders.count()
    assert once.exceptAll(star.fact_orders).count() == 0


def test_fact_load_appends_new_rows_after_max_key(spark, star):
    facts = star.fact_orders.drop("order_line_key")
    first = FA.number_facts(facts.filter(F.col("row_id") <= 100))
    both = FA.load_facts(first, facts)
    n = facts.count()
    keys = sorted(r.order_line_key for r in both.select("order_line_key").collect())
    assert keys == list(range(1, n + 1))
    assert both.filter((F.col("row_id") <= 100) & (F.col("order_line_key") > 100)).count() == 0


def test_repeated_row_id_keeps_one_row(spark):
    df = rows(spark, [{"row_id": 5, "order_id": "B"}, {"row_id": 5, "order_id": "A"}, {"row_id": 6}])
    star = build_star(df)
    got = sorted((r.order_line_key, r.row_id, r.order_id) for r in star.fact_orders.collect())
    assert got == [(1, 5, "A"), (2, 6, "O1")]
