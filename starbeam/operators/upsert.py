"""The two upsert forms of the warehouse, on immutable DataFrames.

``upsert_update`` is INSERT ... ON CONFLICT DO UPDATE (slowly changing
dimension, type 1): existing keys keep their surrogate and take the
incoming attributes; new natural keys are numbered after the current
maximum.  ``upsert_ignore`` is ON CONFLICT DO NOTHING.  Both return the new
table; the caller writes it (see ``starbeam.sources.star_store``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import kept
from .dims import ORDER_COL, first_rows, keyed


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[f"{prefix}{k}"])
        cond = c if cond is None else cond & c
    return cond


def _anti(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` (the incoming batch) whose key is absent from ``right``
    (the existing table); NULL key parts compare equal.

    The existing table is first reduced to the keys the batch names (a semi
    join whose build side is the batch's keys, broadcast by Spark when the
    batch is small), so a small batch never shuffles the whole table.
    """
    batch_keys = left.select(*[F.col(k).alias(f"_b_{k}") for k in keys]).distinct()
    existing = right.select(*keys)
    hits = existing.join(batch_keys, _on(existing, batch_keys, keys, "_b_"), "left_semi")
    r = hits.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    return left.join(r, _on(left, r, keys, "_r_"), "left_anti")


def _next_key(existing: DataFrame, key_col: str) -> Column:
    return existing.agg(F.coalesce(F.max(key_col), F.lit(0)) + 1).scalar()


def upsert_update(
    existing: DataFrame,
    incoming: DataFrame,
    natural_key: Sequence[str],
    attrs: Sequence[str],
    key_col: str,
    order_col: str = ORDER_COL,
) -> DataFrame:
    """E12.  ``incoming`` is a record with ``natural_key``, ``attrs`` and ``order_col``;
    the first row per natural key is the one applied."""
    natural_key = list(natural_key)
    # read several times, here and wherever the new table is
    inc = kept(first_rows(incoming, natural_key, attrs, order_col), "incoming")
    i = inc.select(*[F.col(c).alias(f"_i_{c}") for c in inc.columns])
    cond = None
    for k in natural_key:
        c = existing[k].eqNullSafe(i[f"_i_{k}"])
        cond = c if cond is None else cond & c
    updated = existing.join(i, cond, "left").select(
        F.col(key_col),
        *[F.col(k) for k in natural_key],
        *[
            F.when(F.col("_i__first_row").isNotNull(), F.col(f"_i_{a}")).otherwise(existing[a]).alias(a)
            for a in attrs
        ],
    )
    new = _anti(inc, existing, natural_key)
    return updated.unionByName(keyed(new, key_col, start=_next_key(existing, key_col)))


def upsert_ignore(
    existing: DataFrame,
    incoming: DataFrame,
    key_cols: Sequence[str],
    key_col: str | None = None,
    order_col: str | None = None,
) -> DataFrame:
    """E13.  Rows of ``incoming`` whose key is already present are ignored; among
    incoming rows sharing a key the first by ``order_col`` wins.  With
    ``key_col`` the added rows get surrogate keys after the current maximum
    (``order_col`` order)."""
    key_cols = list(key_cols)
    cols = [c for c in existing.columns if c != key_col]
    if order_col is not None:
        rest = [c for c in cols if c not in key_cols]
        inc = first_rows(incoming, key_cols, [c for c in rest if c != order_col], order_col)
        if order_col in rest:
            inc = inc.withColumn(order_col, F.col("_first_row"))
    else:
        inc = incoming.select(*cols).dropDuplicates(key_cols).withColumn("_first_row", F.lit(0))
    inc = kept(inc, "incoming")
    new = _anti(inc, existing, key_cols)
    if key_col is None:
        return existing.unionByName(new.select(*cols))
    return existing.unionByName(keyed(new.select(*cols, "_first_row"), key_col, start=_next_key(existing, key_col)))
