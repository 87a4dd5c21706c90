"""Adapter from the driver's TPC-H-like tables to the order-line record.

The warehouse expects the 21-column retail order-line record (see
``starbeam.schema.SOURCE_COLUMNS``).  The driver tables have no ship mode,
profit or city, so this module derives them by a fixed rule; the DuckDB
oracle (``oracle/``) derives them by the same rule in SQL.  Only tests, the
bench and ``__spark_entry__`` use this module; the warehouse operators read
whatever record they are given.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.numbering import _PID, range_of, ranges_for, running_sum
from ..schema import SOURCE_COLUMNS, SOURCE_HEADERS
from ..session import broadcast_within, few_rows

LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _d54(c):
    return c.cast("decimal(5,4)")


def flat_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed, clean order-line record (one row per lineitem row).

    ``row_id`` numbers whole lineitem rows in column order (whole rows are
    unique in the driver data; ``(l_orderkey, l_linenumber)`` is not).
    """
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")

    heads = (
        orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumnRenamed("o_orderkey", "l_orderkey")
    )
    j = _lines_by_range(li, heads, part)
    if j is None:
        j = _lines_by_order(li, heads, part)
    sales = F.col("l_extendedprice").cast("decimal(12,4)")
    discount = _d54(F.col("l_discount") * 4)
    margin_rate = (
        _d54(F.lit(Decimal("0.20")))
        - discount
        + _d54(F.col("l_tax"))
        - _d54(F.lit(Decimal("0.004")) * F.col("n_nationkey"))
    )
    cust_digit = F.col("c_custkey") % 10
    return j.select(
        F.col("row_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("o_orderpriority").alias("ship_mode"),
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.lit("United States").alias("country"),
        F.concat(F.col("n_name"), F.lit(" C"), cust_digit.cast("string")).alias("city"),
        F.col("n_name").alias("state"),
        F.lpad((F.col("n_nationkey") * 10 + cust_digit).cast("string"), 5, "0").alias("postal_code"),
        F.col("r_name").alias("region"),
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("p_name").alias("product_name"),
        sales.alias("sales"),
        F.col("l_quantity").cast("int").alias("quantity"),
        discount.alias("discount"),
        (sales * margin_rate).cast("decimal(12,4)").alias("profit"),
    )


def _lines_by_range(li: DataFrame, heads: DataFrame, part: DataFrame) -> DataFrame | None:
    """The lines, numbered, with their orders and parts, all of them sent to ranges of order key; None where the keys lie too unevenly.

    A line's number is its place in its range after the lines of the ranges
    before.  Parts too many to broadcast go to the ranges whose lines name them,
    so that no line is shuffled by part.
    """
    lines = li.filter("l_orderkey IS NOT NULL")
    low, high = lines.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    n_ranges = ranges_for(li)
    ranges = range_of(lines, "l_orderkey", n_ranges)
    if ranges is None:
        return None
    lines = lines.withColumn(_PID, ranges)
    earlier = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # one row for each range
    offsets = lines.groupBy(_PID).agg(F.count(F.lit(1)).alias("_lines")).select(
        _PID, (F.coalesce(F.sum("_lines").over(earlier), F.lit(0)) + li.filter("l_orderkey IS NULL").count()).alias("_before"))
    # a task holds one range; sorted by the keys of the join with the orders first, it is not sorted again for that
    order = [F.col(c).asc_nulls_first() for c in ("l_orderkey", _PID, *LINEITEM_COLUMNS[1:])]
    j = lines.select(*LINEITEM_COLUMNS, _PID).repartitionById(n_ranges, F.col(_PID)).sortWithinPartitions(*order)
    j = j.withColumn("_place", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33) + 1)
    parts, keys = F.broadcast(part), F.col("l_partkey") == F.col("p_partkey")
    if not few_rows(part):
        named = lines.filter("l_partkey IS NOT NULL").select(F.col(_PID).alias("_range"), F.col("l_partkey").alias("_named")).distinct()
        parts = named.join(part, F.col("_named") == F.col("p_partkey")).drop("_named").repartitionById(n_ranges, F.col("_range"))
        parts = parts.hint("shuffle_hash")  # no more than the lines of a range name
        keys = (F.col(_PID) == F.col("_range")) & keys
    heads = heads.filter(F.col("l_orderkey").between(low, high)).withColumn(_PID, ranges).repartitionById(n_ranges, F.col(_PID))
    return (
        j.join(heads, ["l_orderkey", _PID]).join(parts, keys).join(F.broadcast(offsets), _PID)
        .withColumn("row_id", F.col("_before") + F.col("_place"))
    )


def _lines_by_order(li: DataFrame, heads: DataFrame, part: DataFrame) -> DataFrame:
    """The same by shuffles on the order key: where an order's numbers begin comes from a prefix sum over one small row
    for each order, and a line's place in it from a window on the same key."""
    counts = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_lines"))
    starts = running_sum(counts, ["l_orderkey"], "_lines", "_upto").select(
        "l_orderkey", (F.col("_upto") - F.col("_lines")).alias("_before"))
    places = Window.partitionBy("l_orderkey").orderBy(*[F.col(c).asc_nulls_first() for c in LINEITEM_COLUMNS[1:]])
    lines = li.filter("l_orderkey IS NOT NULL").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
        F.row_number().over(places).alias("_place"))
    return (
        lines.join(starts, "l_orderkey").join(heads, "l_orderkey")
        .join(broadcast_within(part), F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("row_id", F.col("_before") + F.col("_place"))
    )


def raw_orders(flat: DataFrame) -> DataFrame:
    """The dirty, all-text variant of ``flat`` (what a CSV read yields).

    Dirt rules (the oracle applies the same): rows with ``row_id % 50 = 0``
    appear twice; order date text ``13/45/2016`` where ``row_id % 97 = 0``;
    NULL customer id where ``row_id % 101 = 0``; ids padded with spaces where
    ``row_id % 7 = 0`` (this rule wins over the NULL rule).
    """
    rid = F.col("row_id")

    def mdy(c):
        return F.concat_ws("/", F.month(c).cast("string"), F.dayofmonth(c).cast("string"), F.year(c).cast("string"))

    pad7 = rid % 7 == 0
    cust = (
        F.when(pad7, F.concat(F.lit("  "), F.col("customer_id"), F.lit(" ")))
        .when(rid % 101 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("customer_id"))
    )
    prod = F.when(pad7, F.concat(F.lit(" "), F.col("product_id"), F.lit("  "))).otherwise(F.col("product_id"))
    mode = F.when(pad7, F.concat(F.col("ship_mode"), F.lit(" "))).otherwise(F.col("ship_mode"))
    base = flat.select(
        rid.cast("string").alias("row_id"),
        "order_id",
        F.when(rid % 97 == 0, F.lit("13/45/2016")).otherwise(mdy(F.col("order_date"))).alias("order_date"),
        mdy(F.col("ship_date")).alias("ship_date"),
        mode.alias("ship_mode"),
        cust.alias("customer_id"),
        "customer_name", "segment", "country", "city", "state", "postal_code", "region",
        prod.alias("product_id"),
        "category", "sub_category", "product_name",
        F.col("sales").cast("string").alias("sales"),
        F.col("quantity").cast("string").alias("quantity"),
        F.col("discount").cast("string").alias("discount"),
        F.col("profit").cast("string").alias("profit"),
    )
    dups = base.filter(F.col("row_id").cast("long") % 50 == 0)
    return base.unionByName(dups)


def write_awkward_csv(raw: DataFrame, path: str) -> None:
    """``raw`` as three folders of CSV files that differ in ways that real exports do (the oracle applies the same rules).

    Every customer name gets an accented letter, and where ``row_id % 11 = 0``
    the product name a line break and quotes.  ``row_id % 3`` deals the rows:
    0, UTF-8 with a byte order mark, the record's column order; 1, Latin-1,
    columns reversed, a surplus field where ``row_id % 17 = 0``; 2, UTF-8
    with carriage returns, customer and product id changed places and the
    segment last, which is missing where ``row_id % 13 = 0``.  A folder holds
    as many files as tasks wrote it, each with the folder's header; those of the
    first two are compressed, so read whole, the last one's split over tasks.
    """
    mask = (1 << 33) - 1
    back = {v: k for k, v in SOURCE_HEADERS.items()}
    rid = F.col("row_id").cast("long")
    broken = F.concat("product_name", F.lit('\n"x", y'))
    rows = raw.withColumns({"customer_name": F.concat("customer_name", F.lit(" é")),
                            "product_name": F.when(rid % 11 == 0, broken).otherwise(F.col("product_name"))})
    swap = {"customer_id": "product_id", "product_id": "customer_id"}
    orders = [SOURCE_COLUMNS, SOURCE_COLUMNS[::-1],
              [swap.get(c, c) for c in SOURCE_COLUMNS if c != "segment"] + ["segment"]]
    for part, columns in enumerate(orders):
        named = [F.coalesce(c, F.lit("")).alias(c) for c in columns]
        header = ",".join(back[c] for c in columns)
        line = F.to_csv(F.struct(*named), {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": ""})
        if part == 0:
            header = "\ufeff" + header
        elif part == 1:
            line = F.when(rid % 17 == 0, F.concat(line, F.lit(",surplus"))).otherwise(line)
        else:
            short = F.to_csv(F.struct(*named[:-1]), {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": ""})
            line = F.concat(F.when(rid % 13 == 0, short).otherwise(line), F.lit("\r"))
            header += "\r"
        some = rows.filter(rid % 3 == part)
        # a task's first row brings the header of its file
        first = F.monotonically_increasing_id().bitwiseAND(F.lit(mask)) == 0
        text = some.select(F.when(first, F.concat(F.lit(header + "\n"), line)).otherwise(line).alias("value"))
        if some.isEmpty():
            text = raw.sparkSession.createDataFrame([(header,)], "value string").coalesce(1)
        elif part == 1:
            text = text.select(F.encode("value", "ISO-8859-1").cast("string").alias("value"))
        text.write.option("compression", "none" if part == 2 else "gzip").text(f"{path}/part{part}")


BATCH_CUTOFF = "1995-06-01"


def order_batches(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two loads for the upsert operators: orders before the cut-off, then the
    rest with upper-cased customer names (an attribute change on re-load)."""
    first = flat.filter(F.col("order_date") < F.lit(BATCH_CUTOFF).cast("date"))
    second = flat.filter(F.col("order_date") >= F.lit(BATCH_CUTOFF).cast("date")).withColumn(
        "customer_name", F.upper("customer_name")
    )
    return first, second


REC_TYPES = ["substitute", "cross_sell", "upsell"]


def recommendation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommendation pairs derived from ``part``.

    Each part gets one pair pointing 7 ids further on, with the type chosen by
    ``p_partkey % 3``; pairs from the last 7 parts point past the last id, so
    they exercise the unknown-id paths.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    t = F.col("p_partkey") % 3
    return part.select(
        F.col("p_partkey").cast("string").alias("source_product_id"),
        (F.col("p_partkey") + 7).cast("string").alias("recommended_product_id"),
        F.when(t == 0, F.lit(REC_TYPES[0])).when(t == 1, F.lit(REC_TYPES[1])).otherwise(F.lit(REC_TYPES[2])).alias(
            "recommendation_type"
        ),
        ((F.col("p_partkey") * 37 % 100).cast("double") / 100).cast("decimal(5,4)").alias("recommendation_score"),
        F.concat(F.lit("pairs with "), F.col("p_name")).alias("recommendation_reason"),
    )
