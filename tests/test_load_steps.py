"""The warehouse's load does each step once, and only the steps that a query reads."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starbeam.operators.distinct import number_orders
from starbeam.operators.facts import empty_facts, load_facts, new_facts
from starbeam.operators.numbering import assign_surrogate_keys, range_of
from starbeam.operators.upsert import upsert_update
from starbeam.schema import FACT_COLUMNS
from starbeam.sources.fixture import LINEITEM_COLUMNS, flat_orders
from starbeam.warehouse import Fixture


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Small driver tables: an order without lines, lines without an order, a repeated line, NULL keys."""
    folder = str(tmp_path_factory.mktemp("tables"))
    day = dt.datetime(2016, 1, 4)
    made = {
        "region": ([(0, "East")], "r_regionkey int, r_name string"),
        "nation": ([(0, "Here", 0), (1, "There", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(c, f"Customer {c}", c % 2, "A") for c in range(3)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "part": ([(p, f"Part {p}", "Art", "Office") for p in range(4)], "p_partkey long, p_name string, p_brand string, p_type string"),
        "orders": ([(o, o % 3, day, "1-URGENT") for o in range(6)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": (
            [(o if o < 8 else None, p, 0, n, 1.0 + p, 10.0 * n, 0.05, 0.02, "N", "O", day)
             for o in (0, 1, 3, 4, 5, 7, 8) for p, n in ((3, 2), (1, 1), (1, 1), (0, 3))],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_line_numbers_need_no_copy_of_the_lines(spark, tables):
    flat = flat_orders(spark, tables)
    every = spark.read.parquet(f"{tables}/lineitem.parquet")
    numbered = every.withColumn("row_id", F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in LINEITEM_COLUMNS])))
    want = numbered.filter("l_orderkey < 6").selectExpr("cast(row_id as long)", "cast(l_orderkey as string)", "cast(l_partkey as string)")
    got = flat.select("row_id", "order_id", "product_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert "numbered-" not in plan  # the lines come from the table, shuffled once


def test_orders_are_numbered_without_a_run_of_the_fact_joins(spark):
    lines = spark.createDataFrame([(1, "B"), (2, "A"), (3, "B")], "row_id long, order_id string")
    once = lines.filter(F.raise_error(F.lit("read twice")).cast("boolean"))
    number_orders(empty_facts(spark), once, lines)
    got = number_orders(empty_facts(spark), lines, lines)
    assert sorted((r.row_id, r.order_no) for r in got.collect()) == [(1, 1), (2, 2), (3, 1)]


def test_a_query_of_facts_loads_no_recommendations(spark, tables):
    fx = Fixture(spark, tables)
    assert fx.facts.fact_orders.count() == fx.flat.count() == 20
    assert not {"report_path", "loaded", "rollups"} & set(vars(fx))
    day = fx.star.dim_date.filter("full_date = DATE'2026-06-21'").count()
    assert (day, fx.facts.dim_date.count(), fx.star.dim_date.count()) == (1, 1, 2)
    assert fx.star.rollups and fx.star.dim_product_recommendations is not None


def fact_rows(spark, ids):
    """Facts of orders of up to three lines, whose lines lie apart."""
    rows = spark.createDataFrame([(i, None if i == 5 else f"O{i % 7}") for i in ids], "row_id long, order_id string")
    rest = [f for f in empty_facts(spark).schema if f.name in FACT_COLUMNS and f.name not in ("order_line_key", "row_id", "order_id")]
    return rows.select("*", *[(F.col("row_id") % 8).cast(f.dataType).alias(f.name) for f in rest])


def test_ranges_keep_the_order_of_values(spark):
    df = spark.createDataFrame([(v,) for v in [None, *range(-50, 900, 3)]], "v long")
    got = [r.b for r in df.select("v", range_of(df, "v", 8).alias("b")).orderBy(F.col("v").asc_nulls_first()).collect()]
    assert got == sorted(got) and got[0] == 0 and set(got) == set(range(8))
    assert range_of(df.limit(0), "v", 8) is None
    uneven = spark.createDataFrame([(v,) for v in [*range(200), 10**9]], "v long")
    assert range_of(uneven, "v", 8) is None  # left to a range partitioning


def test_numbers_by_ranges_are_those_of_a_range_partitioning(spark):
    df = spark.createDataFrame([(v % 211, v) for v in range(300)], "v long, w long")
    plain = assign_surrogate_keys(df, ["v"], "k", unique=["w"])
    dealt = assign_surrogate_keys(df, ["v"], "k", unique=["w"], ranges=range_of(df, "v", 8))
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, plain.collect()))


def test_first_facts_are_not_sampled_nor_shuffled_by_order(spark):
    """The rows are made once, and meet their orders' numbers in the ranges of row id."""
    rows, made = fact_rows(spark, [*range(40), 3]), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    got = new_facts(empty_facts(spark), rows.mapInArrow(counted, rows.schema), rows)
    assert made.value == 41
    plain = new_facts(empty_facts(spark), rows)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect())) and got.count() == 40
    assert {r.row_id: r.order_no for r in got.collect()}[12] == 7  # O5 comes last: row 5 has no order


def test_an_increment_finds_the_loaded_ids_first(spark):
    """Incoming rows are made once; known orders keep their numbers, loaded ids their rows."""
    existing = new_facts(empty_facts(spark), fact_rows(spark, range(10)))
    rows, made = fact_rows(spark, range(8, 30)), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    got = new_facts(existing, rows.mapInArrow(counted, rows.schema), rows)
    assert made.value == 22
    assert sorted((r.order_line_key, r.row_id) for r in got.collect()) == [(i + 1, i) for i in range(10, 30)]
    want = load_facts(existing, rows).filter("row_id >= 10").select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_an_upsert_reads_its_batch_once(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    old = spark.createDataFrame([(1, "a", "x")], "key long, id string, name string")
    rows = spark.createDataFrame([(1, "a", "y"), (2, "b", "z"), (3, "b", "w")], "row_id long, id string, name string")
    got = upsert_update(old, rows.mapInArrow(counted, rows.schema), ["id"], ["name"], "key")
    assert sorted(map(tuple, got.collect())) == [(1, "a", "y"), (2, "b", "z")] and made.value == 3
