import datetime as dt
from decimal import Decimal

from starbeam.operators import dims as DM
from starbeam.operators.upsert import upsert_ignore, upsert_update

COLS = "row_id long, customer_id string, customer_name string, segment string, postal_code string, city string, " \
       "state string, country string, region string, product_id string, product_name string, category string, " \
       "sub_category string, ship_mode string, order_date date, ship_date date"


def rec(spark, rows):
    base = dict(customer_id="C1", customer_name="Ann", segment="Consumer", postal_code="02138", city="Boston",
                state="MA", country="United States", region="East", product_id="P1", product_name="Pen",
                category="Office", sub_category="Art", ship_mode="First Class", order_date=dt.date(2016, 1, 4),
                ship_date=dt.date(2016, 1, 9))
    names = [c.split()[0] for c in COLS.split(", ")]
    return spark.createDataFrame([tuple({**base, **r}[c] for c in names) for r in rows], COLS)


def test_first_row_wins_and_keys_follow_first_appearance(spark):
    df = rec(spark, [
        {"row_id": 3, "customer_id": "C2", "customer_name": "Bob"},
        {"row_id": 1, "customer_name": "Ann"},
        {"row_id": 2, "customer_name": "Ann Later"},
    ])
    got = {r.customer_id: (r.customer_key, r.customer_name) for r in DM.build_dim_customer(df).collect()}
    assert got == {"C1": (1, "Ann"), "C2": (2, "Bob")}


def test_geography_null_postal_is_one_member(spark):
    df = rec(spark, [{"row_id": 1, "postal_code": None}, {"row_id": 2, "postal_code": None, "region": "West"},
                     {"row_id": 3}])
    g = DM.build_dim_geography(df).collect()
    assert len(g) == 2
    assert [r.region for r in g if r.postal_code is None] == ["East"]


def test_dim_date_calendar(spark):
    df = rec(spark, [{"row_id": 1, "order_date": dt.date(2016, 1, 9), "ship_date": dt.date(2016, 1, 11)}])
    d = {r.date_key: r for r in DM.build_dim_date(df).collect()}
    sat = d[20160109]
    assert (sat.day_of_week, sat.day_name, sat.month_name, sat.is_weekend, sat.quarter) == (5, "Saturday", "January",
                                                                                            True, 1)
    assert d[20160111].day_of_week == 0 and not d[20160111].is_weekend


def test_ensure_date_adds_once(spark):
    df = rec(spark, [{"row_id": 1}])
    d = DM.build_dim_date(df)
    once = DM.ensure_date(spark, d, dt.date(2026, 6, 21))
    twice = DM.ensure_date(spark, once, dt.date(2026, 6, 21))
    assert once.count() == 3 and twice.count() == 3
    assert DM.ensure_date(spark, d, dt.date(2016, 1, 4)).count() == 2


def test_upsert_update_keeps_surrogates_and_numbers_new_after_max(spark):
    existing = DM.build_dim_customer(rec(spark, [{"row_id": 1}, {"row_id": 2, "customer_id": "C2"}]))
    incoming = rec(spark, [{"row_id": 5, "customer_id": "C2", "customer_name": "Zed", "segment": "Corporate"},
                           {"row_id": 6, "customer_id": "C9", "customer_name": "New"},
                           {"row_id": 4, "customer_id": "C8", "customer_name": "Newer"}])
    out = {r.customer_id: (r.customer_key, r.customer_name, r.segment)
           for r in upsert_update(existing, incoming, ["customer_id"], ["customer_name", "segment"],
                                  "customer_key").collect()}
    assert out == {"C1": (1, "Ann", "Consumer"), "C2": (2, "Zed", "Corporate"), "C8": (3, "Newer", "Consumer"),
                   "C9": (4, "New", "Consumer")}


def test_upsert_ignore_is_idempotent(spark):
    existing = DM.build_dim_geography(rec(spark, [{"row_id": 1}]))
    incoming = rec(spark, [{"row_id": 2}, {"row_id": 3, "city": "Salem", "region": "North"},
                           {"row_id": 4, "city": "Salem", "region": "South"}])
    keys = ["postal_code", "city", "state"]
    once = upsert_ignore(existing, incoming, keys, key_col="geography_key", order_col="row_id")
    twice = upsert_ignore(once, incoming, keys, key_col="geography_key", order_col="row_id")
    got = sorted((r.geography_key, r.city, r.region) for r in twice.collect())
    assert got == [(1, "Boston", "East"), (2, "Salem", "North")]
    assert once.exceptAll(twice).count() == 0


def test_upsert_ignore_without_keys(spark):
    a = spark.createDataFrame([(1, Decimal("1.0"))], "k int, v decimal(5,1)")
    b = spark.createDataFrame([(1, Decimal("2.0")), (2, Decimal("3.0")), (2, Decimal("4.0"))], "k int, v decimal(5,1)")
    out = upsert_ignore(a, b, ["k"]).orderBy("k").collect()
    assert [r.k for r in out] == [1, 2] and out[0].v == Decimal("1.0")
