"""Fact key resolution, projection, idempotent load and load summary.

The key maps of the warehouse become equi-joins.  A dimension's ids and keys
are broadcast up to a fixed number of rows (``session.broadcast_within``).  A
load sends the keys of a larger customer or product dimension to the ranges of
row id whose lines name them (``load_lines``); elsewhere it falls back to a
sort-merge join, and AQE splits a skewed join partition if one customer holds a
large share of the lines.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import FACT_COLUMNS, MONEY, RATE
from ..session import broadcast_within, few_rows, kept
from .distinct import ORDER_NO, number_orders, order_numbers
from .numbering import _PID, RANGE_ROWS, assign_surrogate_keys, dealt_by_range, range_of, ranges_for

GEO_KEY = ["postal_code", "city", "state"]
#: the dimensions that grow with the lines: key, id, table
BY_ID = {"customer_key": ("customer_id", "dim_customer"), "product_key": ("product_id", "dim_product")}


def _with_geo_key(df: DataFrame, geo: DataFrame, how: str) -> DataFrame:
    g = geo.select(*[F.col(c).alias(f"_g_{c}") for c in GEO_KEY], "geography_key")
    cond = (
        df["postal_code"].eqNullSafe(g["_g_postal_code"])
        & (df["city"] == g["_g_city"])
        & (df["state"] == g["_g_state"])
    )
    return df.join(g, cond, how).drop(*[f"_g_{c}" for c in GEO_KEY])


def _lookups(clean: DataFrame, dims: dict[str, DataFrame], how: str, late: Collection[str] = ()) -> DataFrame:
    # the small dimensions first: what the larger ones may have to shuffle then holds keys in place of texts
    f = clean.join(dims["dim_ship_mode"].select("ship_mode", "ship_mode_key"), "ship_mode", how)
    f = _with_geo_key(f, dims["dim_geography"], how)
    for key, (name, dim) in BY_ID.items():
        if key not in late:
            f = f.join(broadcast_within(dims[dim].select(name, key)), name, how)
    return f


def resolve_keys(clean: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The clean record with its four dimension keys; a row missing any is skipped."""
    return _lookups(clean, dims, "inner")


def skipped_counts(clean: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """One row: skipped rows, and how many miss each dimension."""
    f = _lookups(clean, dims, "left")
    miss = {d: F.col(f"{d}_key").isNull() for d in ("customer", "product", "geography", "ship_mode")}
    any_miss = miss["customer"] | miss["product"] | miss["geography"] | miss["ship_mode"]
    return f.agg(
        F.count_if(any_miss).alias("skipped_rows"),
        *[F.count_if(m).alias(f"missing_{d}") for d, m in miss.items()],
    )


def skipped_rows(clean: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The skipped rows themselves."""
    f = _lookups(clean, dims, "left")
    cond = (
        F.col("customer_key").isNull() | F.col("product_key").isNull()
        | F.col("geography_key").isNull() | F.col("ship_mode_key").isNull()
    )
    return f.filter(cond)


def project_facts(resolved: DataFrame, late: Collection[str] = ()) -> DataFrame:
    """Fact columns with warehouse types and the stored derived measure
    ``revenue_after_discount = sales * (1 - discount)`` (NUMERIC(12,4), half-up);
    the ids of keys that are resolved ``late`` in place of the keys."""
    def key(name: str) -> Column:
        return F.col(BY_ID[name][0]) if name in late else F.col(name).cast("long")

    sales = F.col("sales").cast(MONEY)
    discount = F.col("discount").cast(RATE)
    return resolved.select(
        F.col("row_id").cast("long"),
        F.col("order_id").cast("string"),
        F.col("order_date_key").cast("int"),
        F.col("ship_date_key").cast("int"),
        F.col("ship_mode_key").cast("long"),
        key("customer_key"),
        F.col("geography_key").cast("long"),
        key("product_key"),
        sales.alias("sales"),
        F.col("quantity").cast("int"),
        discount.alias("discount"),
        F.col("profit").cast(MONEY),
        (sales * (F.lit(1) - discount)).cast(MONEY).alias("revenue_after_discount"),
    )


def number_facts(facts: DataFrame) -> DataFrame:
    """``order_line_key`` in row_id order (the insertion order of the load)."""
    return assign_surrogate_keys(facts, ["row_id"], "order_line_key").select(*FACT_COLUMNS)


def load_facts(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Add the incoming fact rows whose ``row_id`` is not loaded yet."""
    added = new_facts(existing, incoming)
    return existing.select(*added.columns).unionByName(added)


def empty_facts(spark) -> DataFrame:
    """A fact table with no rows (the state before the first load)."""
    return spark.createDataFrame(
        [],
        "order_line_key long, row_id long, order_id string, order_date_key int, ship_date_key int, "
        "ship_mode_key long, customer_key long, geography_key long, product_key long, sales decimal(12,4), "
        "quantity int, discount decimal(5,4), profit decimal(12,4), revenue_after_discount decimal(12,4), order_no long",
    )


def load_lines(existing: DataFrame, clean: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The fact rows that the clean lines add to ``existing`` (see ``new_facts``)."""
    late = {k: dims[dim].select(name, k) for k, (name, dim) in BY_ID.items() if not few_rows(dims[dim])}
    return new_facts(existing, project_facts(_lookups(clean, dims, "inner", late), late), clean, late)


def new_facts(
    existing: DataFrame, incoming: DataFrame, lines: DataFrame | None = None, late: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """E15b, only the added rows: incoming rows with an unseen ``row_id``, keyed
    after the largest loaded ``order_line_key``.  Incoming rows sharing a
    ``row_id`` keep one, the first in (row_id, other columns) order, as an
    insert that skips conflicts keeps the first.  Where the existing facts have
    order numbers (``distinct.number_orders``), the added ones get theirs.
    With ``lines``, the rows that ``incoming`` was resolved from, the joins of
    ``incoming`` run once, and its rows are shuffled once, by ranges of row id,
    to which their orders' numbers are sent.  So are the keys of the dimensions
    ``late`` (an id and its key, by the key's name), whose ids ``incoming`` holds
    in place of keys; a row whose id is in none is skipped."""
    rest = [c for c in FACT_COLUMNS if c not in ("order_line_key", "row_id")]
    first = existing.isEmpty()  # the first load: nothing to look the rows up in
    after = 1 if first else existing.agg(F.coalesce(F.max("order_line_key"), F.lit(0)) + 1).scalar()
    unseen, columns = incoming.drop(ORDER_NO), [*FACT_COLUMNS]
    if not first:
        unseen = _unseen(existing, unseen, incoming if lines is None else lines)
    late, ranges, n_ranges, lookups = late or {}, None, None, []
    if lines is not None:
        ids = lines.select(F.col("row_id").cast("long"), F.col("order_id").cast("string"), *[BY_ID[k][0] for k in late])
        n_ranges = ranges_for(ids, RANGE_ROWS)
        ranges = range_of(ids, "row_id", n_ranges)
    for key, dim in late.items():
        name = BY_ID[key][0]
        if ranges is None:
            unseen = unseen.join(dim, name)
        else:
            lookups.append((_sent(ids, ranges, name).join(dim, name).select(_PID, name, key), "inner"))
    if ORDER_NO in existing.columns:
        columns = [*FACT_COLUMNS, ORDER_NO]
        if ranges is None:
            unseen = number_orders(existing, unseen, lines)
        else:
            numbers = order_numbers(existing, ids)
            lookups.append((_sent(ids, ranges, "order_id").join(numbers, "order_id").select(_PID, "order_id", ORDER_NO), "left"))
    # ranges of row id: neighbouring rows hold neighbouring order numbers
    return assign_surrogate_keys(unseen, ["row_id"], "order_line_key", start=after, num_partitions=n_ranges, unique=rest,
                                 ranges=ranges, lookups=lookups, spent=[BY_ID[k][0] for k in late]).select(*columns)


def _sent(ids: DataFrame, ranges: Column, name: str) -> DataFrame:
    """The different values of a column in each range of row id."""
    return ids.filter(F.col(name).isNotNull()).select(ranges.alias(_PID), name).distinct()


def _unseen(existing: DataFrame, incoming: DataFrame, named: DataFrame) -> DataFrame:
    """The rows of ``incoming`` whose ``row_id``, also one of ``named``, is not loaded yet; NULL ids compare equal.

    The ids loaded already are found by themselves first: they are few where a batch is new.
    """
    batch = named.select(F.col("row_id").cast("long").alias("_batch")).distinct()
    loaded = existing.select("row_id")
    seen = kept(loaded.join(batch, F.col("row_id").eqNullSafe(F.col("_batch")), "left_semi").distinct(), "seen")
    seen = broadcast_within(seen.select(F.col("row_id").alias("_seen")))
    return incoming.join(seen, F.col("row_id").eqNullSafe(F.col("_seen")), "left_anti")


def with_large_dims(facts: DataFrame, dims: Mapping[str, DataFrame], place: str = "order_line_key") -> DataFrame:
    """``facts`` joined with the dimensions that grow with them, given by their keys.

    Where more than one is too large to broadcast, the facts are shuffled once, by ranges of the whole-number
    column ``place``, and of each dimension the rows that a range names are sent there; joins on the
    dimensions' keys would shuffle them once for each.
    """
    late = [k for k, dim in dims.items() if not few_rows(dim)]
    ranges = None
    if len(late) > 1:
        n_ranges = ranges_for(facts, RANGE_ROWS)
        ranges = range_of(facts, place, n_ranges)
    if ranges is None:
        late = []
    else:
        lookups = [(_sent(facts, ranges, k).join(dims[k], k).select(_PID, k, *[c for c in dims[k].columns if c != k]), "inner") for k in late]
        facts = dealt_by_range(facts.withColumn(_PID, ranges), n_ranges, lookups).drop(_PID)
    for k, dim in dims.items():
        if k not in late:
            facts = facts.join(dim, k)
    return facts


def load_summary(star: dict[str, DataFrame], dropped: DataFrame | None = None, skipped: DataFrame | None = None) -> DataFrame:
    """(item, n) rows: row count per table, then dropped and skipped counts."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("item"), "n")
        for name, df in star.items()
        if df is not None
    ]
    if dropped is not None:
        parts.append(dropped.select(F.lit("dropped_rows").alias("item"), F.col("dropped_rows").alias("n")))
        parts.append(dropped.select(F.lit("duplicate_rows").alias("item"), F.col("duplicate_rows").alias("n")))
    if skipped is not None:
        parts.append(skipped.select(F.lit("skipped_rows").alias("item"), F.col("skipped_rows").alias("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
