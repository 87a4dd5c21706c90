import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from starbeam.operators import recs as RC
from starbeam.plans import reports as AR
from starbeam.plans.recs import load_recommendations
from starbeam.plans.star import build_star
from tests.test_facts import rows


def test_top_report_ranks(star):
    rep = AR.top_products_report(star, 5).collect()
    assert [r.revenue_rank for r in rep] == [1, 2, 3, 4, 5]
    assert all(" > " in r.category_path for r in rep)
    assert rep[0].total_revenue >= rep[-1].total_revenue


def test_break_even_exact_zero(spark):
    df = rows(spark, [
        {"row_id": 1, "product_id": "A", "sales": Decimal("50"), "profit": Decimal("5")},
        {"row_id": 2, "product_id": "A", "sales": Decimal("50"), "profit": Decimal("-5")},
        {"row_id": 3, "product_id": "B", "sales": Decimal("40"), "profit": Decimal("0.01")},
        {"row_id": 4, "product_id": "C", "sales": Decimal("0"), "profit": Decimal("0")},
    ])
    star = build_star(df)
    assert [r.product_id for r in AR.break_even_products(star).collect()] == ["A"]
    assert sorted(r.product_id for r in AR.break_even_products(star, 0.001).collect()) == ["A", "B"]


def test_report_round_trip(spark, fx, star):
    parsed = RC.report_blocks(fx.reports)
    ranking = AR.product_ranking(star)
    assert parsed.count() == ranking.count()
    a = parsed.select("product_id", "product_name", F.split("category_raw", " > ").alias("lv"))
    b = ranking.select("product_id", "product_name", F.array("category", "sub_category").alias("lv"))
    assert a.exceptAll(b).count() == 0
    gaps = RC.missing_notes(parsed)
    assert gaps.count() == ranking.filter(F.col("revenue_rank") % 2 == 0).count()
    assert gaps.first().search_phrase.endswith(" office product specifications features review")


def test_report_parse_edge_blocks(spark):
    text = ("=" * 20 + "\nHEADER\n" + "=" * 12 + "\nRANK #1\nProduct ID   : X-1\nProduct Name :  Lamp \n"
            "Category     : Furniture > Lamps\nWEB INTELLIGENCE:\n- bright\n- cheap\n\nSources:\n- a\n" + "=" * 15 +
            "\nProduct ID : X-2\nCategory : Tech\nWEB INTELLIGENCE:\nnotes run to the rule\n=====\n" + "=" * 10 +
            "\nProduct ID : X-3\nProduct Name : Desk\n")
    df = spark.createDataFrame([("f", text)], "report_file string, value string")
    got = {r.product_id: r for r in RC.report_blocks(df).collect()}
    assert sorted(got) == ["X-1", "X-3"]  # X-2 has no name
    assert got["X-1"].product_name == "Lamp" and got["X-1"].web_intel == "- bright\n- cheap"
    assert got["X-3"].category_raw == "" and got["X-3"].web_intel == ""
    lv = {r.product_id: (r.category, r.sub_category) for r in RC.category_levels(RC.report_blocks(df)).collect()}
    assert lv == {"X-1": ("Furniture", "Lamps"), "X-3": (None, None)}


def test_recommendation_reload_same_day_adds_nothing_next_day_adds(spark, fx, star):
    day1 = dt.date(2026, 6, 21)
    again = load_recommendations(spark, star, fx.reports, fx.pairs, day1)
    base = star.dim_product_recommendations
    assert again.dim_product_recommendations.count() == base.count()
    later = load_recommendations(spark, star, fx.reports, fx.pairs, dt.date(2026, 6, 22))
    recs = later.dim_product_recommendations
    assert recs.count() == 2 * base.count()
    assert recs.agg(F.countDistinct("recommendation_key")).first()[0] == recs.count()
    assert later.dim_date.filter(F.col("date_key") == 20260622).count() == 1


def test_missing_products_reports_either_side(spark, star):
    pairs = spark.createDataFrame(
        [("1", "999999", "upsell", Decimal("0.5"), "r"), ("888888", "2", "substitute", Decimal("0.5"), "r")],
        "source_product_id string, recommended_product_id string, recommendation_type string, "
        "recommendation_score decimal(5,4), recommendation_reason string")
    got = sorted(r.product_id for r in RC.missing_products(pairs, star.dim_product).collect())
    assert got == ["888888", "999999"]


def test_audits_clean_star_and_catch_violations(spark, star):
    from starbeam.operators.audit import audit_all

    assert audit_all(star.tables()).filter(F.col("n") > 0).count() == 0
    bad = star.tables()
    bad["fact_orders"] = star.fact_orders.unionByName(star.fact_orders.limit(1).withColumn("customer_key", F.lit(-1)))
    found = {(r.audit, r.item) for r in audit_all(bad).filter(F.col("n") > 0).collect()}
    assert ("foreign_key", "customer_key->dim_customer") in found
    assert ("unique", "row_id") in found


def test_line_parser_equals_whole_text_parser(spark, tmp_path):
    from starbeam.sources.report import read_report, read_report_lines

    a = ("HEADER\n" + "=" * 12 + "\nProduct ID : A-1\nProduct Name : Lamp\nCategory : F > L\n"
         "WEB INTELLIGENCE:\n- one\n- two\nSources:\n- x\n" + "=" * 10 + " trailing text on the rule line\n"
         "Product ID : A-2\nProduct Name : Desk " + "=" * 11 + " Product ID : A-3\nProduct Name : Chair\n")
    b = ("Product ID : B-1\r\nProduct Name : Stool\r\nWEB INTELLIGENCE:\r\nnotes\r\n=====\r\n"
         + "=" * 10 + "\r\nProduct ID : B-2\r\nProduct Name : Bench")  # CRLF, no final newline
    (tmp_path / "a.txt").write_text(a)
    (tmp_path / "b.txt").write_bytes(b.encode())
    whole = RC.report_blocks(read_report(spark, str(tmp_path))).drop("block_no")
    lines = RC.report_blocks_from_lines(read_report_lines(spark, str(tmp_path))).drop("block_no")
    got = sorted(tuple(r) for r in lines.collect())
    want = sorted(tuple(r) for r in whole.collect())
    assert [g[1] for g in got] == ["A-1", "A-2", "A-3", "B-1", "B-2"]
    assert got == want
    numbered = read_report_lines(spark, str(tmp_path)).filter(F.col("report_file").endswith("b.txt"))
    assert sorted(r.line_no for r in numbered.collect()) == list(range(1, 9))
