"""D3 over dimensions that Spark broadcasts (one scan) and over larger ones (one anti join a key)."""

from pyspark.sql import functions as F

from starbeam.operators.audit import audit_foreign_keys

LIMIT = "spark.sql.autoBroadcastJoinThreshold"


def _found(df):
    return sorted(tuple(r) for r in df.select("table_name", "item", "n").collect())


def _faulty(spark):
    fact = spark.range(0, 3000).select(
        F.col("id").alias("order_line_key"),
        # a hot key, nulls and keys that no dimension holds
        F.when(F.col("id") < 1000, 7).when(F.col("id") < 1010, None).otherwise(F.col("id") % 50).alias("customer_key"),
        (F.col("id") % 4).cast("int").alias("geography_key"), (F.col("id") % 10).alias("product_key"),
        (F.col("id") % 3).alias("ship_mode_key"), F.lit(20240101).alias("order_date_key"),
        F.when(F.col("id") == 5, 19990101).otherwise(20240102).alias("ship_date_key"))
    keys = lambda name, values: spark.createDataFrame([(v,) for v in values], f"{name} long")
    return {
        "fact_orders": fact, "dim_customer": keys("customer_key", [*range(0, 40), 7, 7]), "dim_geography": keys("geography_key", [0, 1, 2, 3, None]),
        "dim_product": keys("product_key", range(10)), "dim_ship_mode": keys("ship_mode_key", []),
        "dim_date": keys("date_key", [20240101, 20240102]),
    }


def test_both_ways_find_the_same_orphans(spark):
    tables = _faulty(spark)
    orphans = sum(1 for i in range(1010, 3000) if i % 50 >= 40)
    got = {item: n for _, item, n in _found(audit_foreign_keys(tables))}
    assert got == {"customer_key->dim_customer": orphans, "geography_key->dim_geography": 0, "product_key->dim_product": 0,
                   "ship_mode_key->dim_ship_mode": 3000, "order_date_key->dim_date": 0, "ship_date_key->dim_date": 1}
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, "-1")
    try:
        assert {item: n for _, item, n in _found(audit_foreign_keys(tables))} == got
    finally:
        spark.conf.set(LIMIT, before)


def test_small_dimensions_share_one_scan(spark, star):
    plan = audit_foreign_keys({k: v for k, v in star.tables().items() if k != "dim_product_recommendations"})
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("order_date_key") > 0 and "LeftAnti" not in text
    assert sum("Relation" in line and "order_date_key" in line for line in text.splitlines()) == 1
