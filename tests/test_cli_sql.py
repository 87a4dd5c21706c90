"""SQL over the registered star views gives the DataFrame answers; the CLI drives a full load."""

from pyspark.sql import functions as F

from starbeam.cli import main, register_views
from starbeam.plans import golden as GQ
from starbeam.session import new_path
from starbeam.sources.csv import write_orders_csv
from starbeam.sources.fixture import raw_orders


def test_spark_sql_on_views_matches_dataframe_query(spark, star):
    register_views(star, spark)
    got = spark.sql("""
        SELECT p.category,
               CAST(ROUND(SUM(fo.sales), 2) AS DOUBLE) AS total_revenue,
               CAST(ROUND(SUM(fo.profit), 2) AS DOUBLE) AS total_profit,
               CAST(ROUND(CAST(CAST(SUM(fo.profit) AS DOUBLE) / NULLIF(CAST(SUM(fo.sales) AS DOUBLE), 0) * 100
                          AS DECIMAL(38,6)), 2) AS DOUBLE) AS profit_margin_pct
        FROM fact_orders fo JOIN dim_product p ON fo.product_key = p.product_key
        GROUP BY p.category""")
    assert got.exceptAll(GQ.category_margin(star)).count() == 0
    assert spark.sql("SELECT COUNT(*) FROM vds_main").first()[0] == star.fact_orders.count()


def test_cli_load_twice_is_idempotent(spark, fx, capsys):
    src = new_path(spark, "cli-csv")
    write_orders_csv(raw_orders(fx.flat).filter(F.col("row_id").cast("long") <= 800).coalesce(1), src)
    root = new_path(spark, "cli-star")
    assert main(["load", "--csv", src, "--star", root]) == 0
    assert main(["load", "--csv", src, "--star", root]) == 0
    from starbeam.sources.star_store import read_star

    star = read_star(spark, root)
    n = star.fact_orders.count()
    assert n == star.fact_orders.select("row_id").distinct().count() > 0
    assert main(["query", "kpi_total", "--star", root]) == 0
    assert main(["sql", "SELECT COUNT(*) AS n FROM fact_orders", "--star", root]) == 0
    assert "total_revenue" in capsys.readouterr().out


def test_cli_recommend_same_day_twice_adds_nothing(spark, fx):
    from starbeam.sources.star_store import read_star

    src = new_path(spark, "cli-csv2")
    write_orders_csv(raw_orders(fx.flat), src)
    root = new_path(spark, "cli-star2")
    assert main(["load", "--csv", src, "--star", root]) == 0
    pairs = new_path(spark, "cli-pairs")
    fx.pairs.write.option("header", True).csv(pairs)
    args = ["recommend", "--report", fx.report_path, "--pairs", pairs, "--star", root, "--date", "2026-06-22"]
    assert main(args) == 0
    first = read_star(spark, root).dim_product_recommendations.count()
    assert main(args) == 0
    assert read_star(spark, root).dim_product_recommendations.count() == first > 0
