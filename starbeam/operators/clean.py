"""Cleaning of the text order-line record.

Order of steps is the warehouse's: exact-duplicate drop on the raw text, date
parse, NULL-key drop, then trimming (so a blank-only id survives as '').
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schema import KEY_COLUMNS, MONEY, RATE
from ..session import MAX_BROADCAST_ROWS, kept, new_path

# Whitespace removed by the trim step.
WHITESPACE = " \t\n\r\x0b\x0c"
DATE_PATTERN = "M/d/yyyy"
_HASH = "_sb_hash"
#: rows of nothing but a hash, some 60 bytes in memory, that a task holds for each of ``MAX_BROADCAST_ROWS``
HASHES_A_ROW = 3
TRIMMED = ["customer_id", "product_id", "ship_mode", "postal_code"]


def dedup_rows(raw: DataFrame) -> DataFrame:
    """Drop rows that repeat another row in every column.

    A first pass shuffles a hash of each row and writes those that occur more
    than once.  Only rows with such a hash are shuffled and compared whole;
    all others differ from every row and pass by.  Where more hashes repeat
    than a task can hold, all rows are compared.
    """
    spark = raw.sparkSession
    path = new_path(spark, "repeated")
    hashed = raw.withColumn(_HASH, F.xxhash64(*raw.columns))
    hashed.groupBy(_HASH).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(_HASH).write.parquet(path)
    repeated = spark.read.schema(f"{_HASH} long").parquet(path)
    if repeated.count() > HASHES_A_ROW * MAX_BROADCAST_ROWS:
        return raw.dropDuplicates()
    once = hashed.join(F.broadcast(repeated), _HASH, "left_anti").select(*raw.columns)
    more = hashed.join(F.broadcast(repeated), _HASH, "left_semi").select(*raw.columns)
    # written, as a filter on the result would otherwise run on all rows of the input for these few
    return once.unionByName(kept(more.dropDuplicates(), "compared"))


def parse_dates(df: DataFrame, cols=("order_date", "ship_date")) -> DataFrame:
    """``M/d/yyyy`` text to DATE; text that is not a date becomes NULL."""
    # generated, so that a text is parsed once: a filter on a projected date would parse it again below
    dates = F.struct(*[F.try_to_date(F.col(c), DATE_PATTERN).alias(c) for c in cols])
    return df.select(*[c for c in df.columns if c not in cols], F.inline(F.array(dates))).select(*df.columns)


def drop_null_keys(df: DataFrame) -> DataFrame:
    """Drop rows missing an order date, ship date, customer id or product id."""
    return df.dropna(subset=KEY_COLUMNS)


def date_key(c: Column) -> Column:
    """DATE to the integer YYYYMMDD key (arithmetic, no string formatting)."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def add_date_keys(df: DataFrame) -> DataFrame:
    return df.withColumns({"order_date_key": date_key(F.col("order_date")), "ship_date_key": date_key(F.col("ship_date"))})


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITESPACE))


def normalise_strings(df: DataFrame) -> DataFrame:
    """E5: trim ids, ship mode and postal code; city and state are left as is."""
    return df.withColumns({c: strip(F.col(c)) for c in TRIMMED})


def type_measures(df: DataFrame) -> DataFrame:
    """Text measures to the warehouse types (a malformed number is an error)."""
    return df.withColumns({
        "row_id": F.col("row_id").cast("long"),
        "sales": F.col("sales").cast(MONEY),
        "quantity": F.col("quantity").cast("int"),
        "discount": F.col("discount").cast(RATE),
        "profit": F.col("profit").cast(MONEY),
    })


def clean_orders(raw: DataFrame) -> DataFrame:
    """E1 -> E2 -> E3 -> E4 -> E5 on the text record; typed record out."""
    df = dedup_rows(raw)
    df = parse_dates(df)
    df = drop_null_keys(df)
    df = add_date_keys(df)
    df = normalise_strings(df)
    return type_measures(df)


def reject_counts(raw: DataFrame) -> DataFrame:
    """One row of counts: duplicates removed, then rows dropped by reason.

    A row with several missing keys counts under each reason and once in
    ``dropped_rows``.
    """
    dedup = parse_dates(dedup_rows(raw))
    missing = {c: F.col(c).isNull() for c in KEY_COLUMNS}
    any_missing = missing["order_date"] | missing["ship_date"] | missing["customer_id"] | missing["product_id"]
    counts = dedup.agg(
        F.count(F.lit(1)).alias("distinct_rows"),
        *[F.count_if(m).alias(f"null_{c}") for c, m in missing.items()],
        F.count_if(any_missing).alias("dropped_rows"),
    )
    raw_rows = raw.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("raw_rows", raw_rows).select(
        "raw_rows",
        (F.col("raw_rows") - F.col("distinct_rows")).alias("duplicate_rows"),
        *[f"null_{c}" for c in KEY_COLUMNS],
        "dropped_rows",
        (F.col("distinct_rows") - F.col("dropped_rows")).alias("clean_rows"),
    )


def clean_orders_observed(raw: DataFrame) -> tuple[DataFrame, Observation, Observation]:
    """E3b on the write path: ``clean_orders`` with its reject counts gathered as
    metrics of the same job that consumes the clean rows (no extra pass).

    Returns (clean, raw_metrics, kept_metrics); read them with ``.get`` after
    the clean rows have been written.  ``raw_rows`` counts input rows,
    ``distinct_rows`` rows after E1, ``null_<key>`` missing keys after E2.
    """
    raw_obs, kept_obs = Observation("raw"), Observation("parsed")
    counted = raw.observe(raw_obs, F.count(F.lit(1)).alias("raw_rows"))
    # one pass, which the metrics are of
    parsed = parse_dates(counted.dropDuplicates()).observe(
        kept_obs,
        F.count(F.lit(1)).alias("distinct_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in KEY_COLUMNS],
    )
    df = add_date_keys(drop_null_keys(parsed))
    return type_measures(normalise_strings(df)), raw_obs, kept_obs
