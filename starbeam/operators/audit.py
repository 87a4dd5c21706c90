"""Data-quality audits of a star, each returning a small DataFrame.

Every audit is a handful of aggregates; none collects rows.  Output rows
are (table_name, item, n); ``n`` is the number of violations.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import FOREIGN_KEYS, MAX_LENGTHS, NOT_NULL, UNIQUE_KEYS
from ..session import size_in_bytes


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _long(df: DataFrame, table: str, items: list[str]) -> DataFrame:
    """One aggregated row with a column per item -> (table_name, item, n) rows."""
    stack = ", ".join(f"'{i}', `{i}`" for i in items)
    return df.selectExpr(f"stack({len(items)}, {stack}) as (item, n)").select(
        F.lit(table).alias("table_name"), "item", F.col("n").cast("long")
    )


def audit_not_null(tables: dict[str, DataFrame]) -> DataFrame:
    """NULL count per NOT NULL column, one scan per table."""
    parts = []
    for t, df in tables.items():
        cols = [c for c in NOT_NULL.get(t, []) if c in df.columns]
        if cols:
            parts.append(_long(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]), t, cols))
    return _union(parts)


def audit_unique(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of key values held by more than one row, per unique key."""
    parts = []
    for t, df in tables.items():
        for key in UNIQUE_KEYS.get(t, []):
            if not all(k in df.columns for k in key):
                continue
            dup = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_c")).agg(F.count_if(F.col("_c") > 1).alias("n"))
            parts.append(dup.select(F.lit(t).alias("table_name"), F.lit(",".join(key)).alias("item"), "n"))
    return _union(parts)


def _broadcastable(df: DataFrame) -> bool:
    """Whether Spark's own size estimate of ``df`` is within its broadcast limit."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return size_in_bytes(df) <= limit


def _orphans_in_one_scan(df: DataFrame, table: str, fks: list[tuple[str, str, str]], tables: dict[str, DataFrame]) -> DataFrame:
    """D3 for keys of dimensions that Spark broadcasts: ``df`` is read once and probes all of them."""
    rows = df.select(*[F.col(col).cast("long").alias(f"v{i}") for i, (col, _, _) in enumerate(fks)])
    for i, (_, dim, key) in enumerate(fks):
        # a faulty dimension may hold a key twice
        held = tables[dim].select(F.col(key).cast("long").alias(f"k{i}")).distinct()
        rows = rows.join(held, F.col(f"v{i}") == F.col(f"k{i}"), "left")
    items = [f"{col}->{dim}" for col, dim, _ in fks]
    counts = [F.count_if(F.col(f"v{i}").isNotNull() & F.col(f"k{i}").isNull()).alias(item) for i, item in enumerate(items)]
    return _long(rows.agg(*counts), table, items)


def _orphans_by_value(df: DataFrame, table: str, fk: tuple[str, str, str], tables: dict[str, DataFrame]) -> DataFrame:
    """D3 for the key of a larger dimension: its values are counted map-side, so the shuffle
    carries different values only, and the dimension joins on the partitioning of the counts."""
    col, dim, key = fk
    value = F.col(col).cast("long").alias("v")
    held = df.filter(F.col(col).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    orphans = held.join(tables[dim].select(F.col(key).cast("long").alias("v")), "v", "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(
        F.lit(table).alias("table_name"), F.lit(f"{col}->{dim}").alias("item"), "n")


def audit_foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """D3: fact rows (and recommendation rows) whose key is not in the dimension.

    One scan for all keys of dimensions within Spark's broadcast limit; a
    pass over the bare key column for each larger one.
    """
    parts = []
    checks = {"fact_orders": FOREIGN_KEYS}
    if "dim_product_recommendations" in tables:
        checks["dim_product_recommendations"] = [
            ("product_key", "dim_product", "product_key"),
            ("recommended_product_key", "dim_product", "product_key"),
            ("date_key", "dim_date", "date_key"),
        ]
    small = {dim: _broadcastable(tables[dim]) for fks in checks.values() for _, dim, _ in fks}
    for t, fks in checks.items():
        together = [fk for fk in fks if small[fk[1]]]
        if together:
            parts.append(_orphans_in_one_scan(tables[t], t, together, tables))
        parts += [_orphans_by_value(tables[t], t, fk, tables) for fk in fks if not small[fk[1]]]
    return _union(parts)


def audit_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """CHECK constraints: score in [0, 1]; VARCHAR lengths within their limits."""
    parts = []
    for t, df in tables.items():
        named = [
            (f"len({c})<={n}", F.count_if(F.length(c) > n))
            for c, n in MAX_LENGTHS.get(t, {}).items()
            if c in df.columns
        ]
        if t == "dim_product_recommendations":
            s = F.col("recommendation_score")
            named.append(("recommendation_score between 0 and 1", F.count_if((s < 0) | (s > 1))))
        if named:
            parts.append(_long(df.agg(*[e.alias(name) for name, e in named]), t, [name for name, _ in named]))
    return _union(parts)


def _row_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """D1 and D4 in one aggregate pass per table: (audit, table_name, item, n)."""
    parts = []
    for t, df in tables.items():
        named = [("not_null", c, F.count_if(F.col(c).isNull())) for c in NOT_NULL.get(t, []) if c in df.columns]
        named += [("check", f"len({c})<={n}", F.count_if(F.length(c) > n))
                  for c, n in MAX_LENGTHS.get(t, {}).items() if c in df.columns]
        if t == "dim_product_recommendations":
            sc = F.col("recommendation_score")
            named.append(("check", "recommendation_score between 0 and 1", F.count_if((sc < 0) | (sc > 1))))
        if not named:
            continue
        agg = df.agg(*[e.alias(f"c{i}") for i, (_, _, e) in enumerate(named)])
        stack = ", ".join(f"'{a}', '{item}', c{i}" for i, (a, item, _) in enumerate(named))
        parts.append(agg.selectExpr(f"stack({len(named)}, {stack}) as (audit, item, n)").select(
            "audit", F.lit(t).alias("table_name"), "item", F.col("n").cast("long")))
    return _union(parts)


def audit_all(tables: dict[str, DataFrame]) -> DataFrame:
    """D1-D4 together, with the audit name (one scan per table for D1 and D4)."""
    return _union([
        _row_checks(tables),
        audit_unique(tables).withColumn("audit", F.lit("unique")).select("audit", "table_name", "item", "n"),
        audit_foreign_keys(tables).withColumn("audit", F.lit("foreign_key")).select("audit", "table_name", "item",
                                                                                    "n"),
    ])
