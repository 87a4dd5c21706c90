import datetime as dt

from pyspark.sql import functions as F

from starbeam.operators import clean as CL
from starbeam.schema import SOURCE_COLUMNS

BASE = dict(zip(SOURCE_COLUMNS, [
    "1", "CA-1", "1/3/2016", "1/5/2016", "Second Class", "CG-1", "Claire Gute", "Consumer", "United States",
    "Boston", "Massachusetts", "02138", "East", "FUR-1", "Furniture", "Chairs", 'Chair 24"" wide', "100.5",
    "2", "0.2", "10.25",
]))


def frame(spark, rows):
    return spark.createDataFrame([tuple({**BASE, **r}[c] for c in SOURCE_COLUMNS) for r in rows],
                                 ", ".join(f"`{c}` string" for c in SOURCE_COLUMNS))


def test_dates_parse_and_bad_text_becomes_null(spark):
    df = CL.parse_dates(frame(spark, [{}, {"row_id": "2", "order_date": "13/45/2016"},
                                       {"row_id": "3", "order_date": "12/31/2017"}]))
    got = {r.row_id: r.order_date for r in df.collect()}
    assert got == {"1": dt.date(2016, 1, 3), "2": None, "3": dt.date(2017, 12, 31)}


def test_clean_pipeline_order(spark):
    rows = [
        {},
        {},  # exact duplicate: removed
        {"row_id": "2", "customer_id": None},  # NULL key: dropped
        {"row_id": "3", "customer_id": "   "},  # blank-only id survives the NULL drop, trimmed to ''
        {"row_id": "4", "product_id": "\tFUR-2 ", "ship_mode": " Same Day "},
        {"row_id": "5", "postal_code": None},
        {"row_id": "6", "ship_date": "02/30/2016"},
    ]
    out = {r.row_id: r for r in CL.clean_orders(frame(spark, rows)).collect()}
    assert sorted(out) == [1, 3, 4, 5]
    assert out[3].customer_id == ""
    assert out[4].product_id == "FUR-2" and out[4].ship_mode == "Same Day"
    assert out[1].postal_code == "02138"  # leading zero kept
    assert out[5].postal_code is None  # a missing postal code stays NULL (not the text 'nan')
    assert out[1].order_date_key == 20160103 and out[1].ship_date_key == 20160105
    assert out[1].city == "Boston" and str(out[1].sales) == "100.5000"


def test_reject_counts(spark):
    rows = [{}, {}, {"row_id": "2", "customer_id": None}, {"row_id": "3", "order_date": "x"},
            {"row_id": "4", "order_date": "x", "product_id": None}]
    r = CL.reject_counts(frame(spark, rows)).first()
    assert (r.raw_rows, r.duplicate_rows, r.dropped_rows, r.clean_rows) == (5, 1, 3, 1)
    assert (r.null_order_date, r.null_customer_id, r.null_product_id) == (2, 1, 1)


def test_csv_source_latin1_quotes_and_na(spark, tmp_path):
    from starbeam.sources.csv import read_orders_csv

    header = ",".join(['"Row ID"', '"Order ID"', '"Order Date"', '"Ship Date"', '"Ship Mode"', '"Customer ID"',
                       '"Customer Name"', '"Segment"', '"Country"', '"City"', '"State"', '"Postal Code"', '"Region"',
                       '"Product ID"', '"Category"', '"Sub-Category"', '"Product Name"', '"Sales"', '"Quantity"',
                       '"Discount"', '"Profit"'])
    line = ('1,CA-1,1/3/2016,1/5/2016,First Class,CG-1,Zoë Café,Consumer,United States,Boston,MA,02138,East,'
            'T-1,Technology,Machines,"HP Designjet 24"" Color",10,1,0,1')
    line2 = '2,CA-2,1/3/2016,1/5/2016,First Class,NA,A,Consumer,United States,Boston,MA,,East,T-1,Technology,M,X,1,1,0,1'
    (tmp_path / "utf8").mkdir()
    (tmp_path / "utf8" / "a.csv").write_bytes((header + "\n" + line + "\n" + line2 + "\n").encode("utf-8"))
    (tmp_path / "latin1").mkdir()
    (tmp_path / "latin1" / "b.csv").write_bytes((header + "\n" + line + "\n").encode("latin-1"))
    for sub in ("utf8", "latin1"):
        df = read_orders_csv(spark, str(tmp_path / sub))
        first = df.filter(F.col("row_id") == "1").first()
        assert first.customer_name == "Zoë Café", sub
        assert first.product_name == 'HP Designjet 24" Color'
        assert first.postal_code == "02138"
    second = read_orders_csv(spark, str(tmp_path / "utf8")).filter(F.col("row_id") == "2").first()
    assert second.customer_id is None and second.postal_code is None


def test_observed_reject_counts_match_the_aggregate(spark):
    rows = [{}, {}, {"row_id": "2", "customer_id": None}, {"row_id": "3", "order_date": "x"},
            {"row_id": "4", "order_date": "x", "product_id": None}]
    raw = frame(spark, rows)
    clean, raw_obs, kept_obs = CL.clean_orders_observed(raw)
    assert clean.count() == 1
    m = {**raw_obs.get, **kept_obs.get}
    r = CL.reject_counts(raw).first()
    assert m["raw_rows"] == r.raw_rows and m["distinct_rows"] == r.raw_rows - r.duplicate_rows
    assert (m["null_order_date"], m["null_customer_id"], m["null_product_id"]) == (
        r.null_order_date, r.null_customer_id, r.null_product_id)


def test_byte_order_mark_and_missing_column(spark, fx):
    import pytest

    from starbeam.schema import SOURCE_HEADERS
    from starbeam.session import new_path
    from starbeam.sources.csv import read_orders_csv
    from starbeam.sources.fixture import raw_orders

    back = {v: k for k, v in SOURCE_HEADERS.items()}
    raw = raw_orders(fx.flat.filter("row_id <= 3"))
    names, lines = [back.get(c, c) for c in raw.columns], [",".join("" if v is None else v for v in r) for r in raw.collect()]
    whole = new_path(spark, "bom")
    text = "\ufeff" + ",".join(names) + "\n" + "\n".join(lines)
    spark.createDataFrame([(text,)], "t string").coalesce(1).write.text(whole)
    assert sorted(r.row_id for r in read_orders_csv(spark, whole).collect()) == ["1", "2", "3"]
    partial = new_path(spark, "partial")
    raw.select(*[F.col(c).alias(back.get(c, c)) for c in raw.columns if c != "sales"]).write.option("header", True).csv(partial)
    with pytest.raises(ValueError, match="sales"):
        read_orders_csv(spark, partial)


def test_only_rows_with_a_repeated_hash_are_shuffled_whole(spark, monkeypatch):
    from starbeam.operators import clean as C

    rows = [("a", None), (None, "a"), ("a", None), ("b", "c"), ("b", "d"), ("b", "c"), (None, None)]
    raw = spark.createDataFrame(rows, "x string, y string")
    want = sorted(set(rows), key=str)
    got = C.dedup_rows(raw)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert "left_anti" in got._jdf.queryExecution().optimizedPlan().toString().lower().replace("leftanti", "left_anti")
    monkeypatch.setattr(C, "MAX_BROADCAST_ROWS", 0)  # more repeats than a task holds
    assert sorted(map(tuple, C.dedup_rows(raw).collect()), key=str) == want
