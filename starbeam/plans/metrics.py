"""The metric layer and the chart queries built on it.

``metric_query`` answers (dataset, metrics, group-by, filters, time grain,
order, row limit) requests.  It joins only the dimensions whose columns the
request touches: Catalyst keeps an unused inner join (it cannot know the
foreign key always matches), so the pruning is done here, and it is valid
because fact keys are NOT NULL and resolve (audits D1-D3) and dimension keys
are unique (D2).  A request whose metrics and dimensions the roll-ups of the
published star hold reads the smallest of them instead of the fact.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import discount_tier, safe_ratio, tier_condition
from ..operators.distinct import BLOCK, ORDER_NO, block, orders_seen
from ..operators.rollups import MEASURES, ROLL_UPS, SUMMED, OnDemand
from ..session import size_in_bytes
from .star import Star, vds_recommendations

# ------------------------------------------------------------------ datasets

# column -> (table, source column); "fact" columns need no join
_MAIN = {
    **{c: ("fact", c) for c in ("order_line_key", "order_id", "row_id", "sales", "quantity", "discount", "profit",
                                "revenue_after_discount")},
    "order_date": ("dim_date", "full_date"),
    "order_year": ("dim_date", "year"),
    "order_quarter": ("dim_date", "quarter"),
    "order_month": ("dim_date", "month"),
    "order_month_name": ("dim_date", "month_name"),
    "customer_name": ("dim_customer", "customer_name"),
    "segment": ("dim_customer", "segment"),
    "city": ("dim_geography", "city"),
    "state": ("dim_geography", "state"),
    "region": ("dim_geography", "region"),
    "country": ("dim_geography", "country"),
    "product_name": ("dim_product", "product_name"),
    "category": ("dim_product", "category"),
    "sub_category": ("dim_product", "sub_category"),
    "ship_mode": ("dim_ship_mode", "ship_mode"),
}
_DISCOUNT = {
    **{c: ("fact", c) for c in ("discount", "sales", "profit", "quantity")},
    "discount_tier": ("fact", None),  # derived from discount
    "category": ("dim_product", "category"),
    "sub_category": ("dim_product", "sub_category"),
    "segment": ("dim_customer", "segment"),
    "region": ("dim_geography", "region"),
}
DATASETS = {"main": _MAIN, "discount": _DISCOUNT}
_JOIN_KEY = {
    "dim_date": ("order_date_key", "date_key"),
    "dim_customer": ("customer_key", "customer_key"),
    "dim_geography": ("geography_key", "geography_key"),
    "dim_product": ("product_key", "product_key"),
    "dim_ship_mode": ("ship_mode_key", "ship_mode_key"),
}


def dataset_frame(star: Star, dataset: str, columns: Sequence[str]) -> DataFrame:
    """The dataset restricted to ``columns``, joining only the dimensions they need."""
    spec = DATASETS[dataset]
    unknown = [c for c in columns if c not in spec]
    if unknown:
        raise KeyError(f"dataset {dataset!r} has no column(s) {unknown}")
    needed = {spec[c][0] for c in columns} - {"fact"}
    df = star.fact_orders
    for table in sorted(needed):
        fk, pk = _JOIN_KEY[table]
        own = [c for c in columns if spec[c][0] == table]
        dim = star.tables()[table].select(F.col(pk).alias(fk), *[F.col(spec[c][1]).alias(c) for c in own])
        df = df.join(dim, fk)
    out = []
    for c in columns:
        table, src = spec[c]
        if c == "discount_tier" and dataset == "discount":
            out.append(discount_tier(F.col("discount"), "ascii").alias(c))
        elif table == "fact":
            out.append(F.col(src).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


# ------------------------------------------------------------------- metrics

@dataclass(frozen=True)
class Metric:
    """An aggregate over dataset rows (``build``).  Additive metrics also give
    partial aggregates over fact rows (``parts``) and how to combine them
    (``final``), which lets ``metric_query`` aggregate before joining."""

    name: str
    columns: tuple[str, ...]
    build: Callable[[], Column]
    parts: Callable[[], dict[str, Column]] | None = None
    final: Callable[[], Column] | None = None
    #: how parts of the same group combine
    merge: Callable[[str], Column] = F.sum
    #: ``final`` counts the orders in the bitmaps ``_orders`` (see ``operators.distinct``)
    counts_orders: bool = False
    #: column of a roll-up that holds each part, where roll-ups have them all (``operators.rollups``)
    stored: dict[str, str] | None = None


def _held(**parts: str) -> dict[str, str] | None:
    """``parts`` if the roll-ups have all the columns they name."""
    return parts if set(parts.values()) <= set(MEASURES) else None


def _sum_metric(name: str, expr: Callable[[], Column], cols, cast: str | None = None, stored: str | None = None) -> Metric:
    """A sum, in the type that summing gives (DECIMAL for money) unless ``cast`` names another; ``stored``
    is the roll-ups' column of that sum where it is not the one of a single column's name."""
    part = f"_{name}_sum"
    typed = lambda c: c if cast is None else c.cast(cast)
    return Metric(name, tuple(cols), lambda: typed(F.sum(expr())),
                  lambda: {part: F.sum(expr())}, lambda: typed(F.sum(part)), stored=_held(**{part: stored or cols[0]}))


def _ratio_metric(name: str, num: Callable[[], Column], den: Callable[[], Column], den_agg, cols, scale=1.0):
    pn, pd = f"_{name}_num", f"_{name}_den"
    stored = _held(**{pn: cols[0], pd: cols[1] if den_agg is F.sum else "lines"})
    return Metric(
        name, tuple(cols),
        lambda: safe_ratio(F.sum(num()), den_agg(den())) * scale if scale != 1.0
        else safe_ratio(F.sum(num()), den_agg(den())),
        lambda: {pn: F.sum(num()), pd: den_agg(den())},
        lambda: safe_ratio(F.sum(pn), F.sum(pd)) * scale if scale != 1.0 else safe_ratio(F.sum(pn), F.sum(pd)),
        stored=stored,
    )


def _distinct_orders():
    return F.countDistinct("order_id")


NAMED_METRICS = {
    # M1-M8: the saved metrics of the main dataset
    "total_revenue": _sum_metric("total_revenue", lambda: F.col("sales"), ["sales"]),
    "total_profit": _sum_metric("total_profit", lambda: F.col("profit"), ["profit"]),
    "profit_margin_pct": _ratio_metric("profit_margin_pct", lambda: F.col("profit"), lambda: F.col("sales"), F.sum,
                                       ["profit", "sales"], 100.0),
    "total_quantity": _sum_metric("total_quantity", lambda: F.col("quantity"), ["quantity"], "long"),
    "avg_order_value": Metric("avg_order_value", ("sales", "order_id"),
                              lambda: safe_ratio(F.sum("sales"), _distinct_orders()),
                              lambda: {"_order_sales": F.sum("sales")},
                              lambda: safe_ratio(F.sum("_order_sales"), F.sum(F.bitmap_count("_orders"))), counts_orders=True),
    "revenue_after_discount": _sum_metric("revenue_after_discount", lambda: F.col("revenue_after_discount"),
                                          ["revenue_after_discount"]),
    "total_discount_impact": _sum_metric("total_discount_impact", lambda: F.col("sales") * F.col("discount"),
                                         ["sales", "discount"], stored="discount_given"),
    "order_count": Metric("order_count", ("order_id",), lambda: _distinct_orders().cast("long"),
                          lambda: {}, lambda: F.sum(F.bitmap_count("_orders")).cast("long"), counts_orders=True),
}


def _snake(label: str) -> str:
    return re.sub(r"[^0-9a-z]+", "_", label.lower()).strip("_")


def adhoc(aggregate: str, column: str, label: str | None = None) -> Metric:
    """M9: an ad-hoc aggregate of one column; named after its label (snake case)
    or ``<aggregate>_<column>``."""
    agg = aggregate.upper()
    name = _snake(label) if label else f"{agg.lower()}_{column}"
    col = lambda: F.col(column)
    part = f"_{name}_part"
    if agg == "SUM":
        return _sum_metric(name, col, [column], "double")  # of any column
    if agg == "AVG":
        return _ratio_metric(name, col, col, F.count, [column])
    if agg == "COUNT":
        return Metric(name, (column,), lambda: F.count(column).cast("long"),
                      lambda: {part: F.count(column)}, lambda: F.sum(part).cast("long"),
                      stored={part: "lines"} if column in SUMMED else None)
    if agg in ("MIN", "MAX"):
        fn = F.min if agg == "MIN" else F.max
        return Metric(name, (column,), lambda: fn(column).cast("double"),
                      lambda: {part: fn(column)}, lambda: fn(part).cast("double"), fn)
    if agg == "COUNT_DISTINCT":
        return Metric(name, (column,), lambda: F.countDistinct(column).cast("long"))
    raise ValueError(f"unknown aggregate {aggregate!r}")


# Time grains of the chart specs (ISO 8601 durations).
GRAINS = {"P1D": "day", "P1W": "week", "P1M": "month", "P3M": "quarter", "P1Y": "year"}

_OPS = {
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "IN": lambda c, v: c.isin(list(v)),
    "NOT IN": lambda c, v: ~c.isin(list(v)),
}


def metric_query(
    star: Star,
    dataset: str = "main",
    metrics: Sequence[str | Metric] = ("total_revenue",),
    groupby: Sequence[str] = (),
    filters: Sequence[tuple[str, str, object]] = (),
    time_col: str | None = None,
    grain: str | None = None,
    order_desc: bool = True,
    row_limit: int | None = None,
) -> DataFrame:
    """M0.  Aggregates ``metrics`` per ``groupby`` (plus the time bucket when
    ``grain`` is given) over the dataset, after the ``filters`` (M10).
    Sorted by the first metric (descending unless ``order_desc`` is False),
    group keys breaking ties; ``row_limit`` keeps the first rows."""
    ms = [NAMED_METRICS[m] if isinstance(m, str) else m for m in metrics]
    spec = DATASETS[dataset]
    used = [spec.get(c, ("fact", c))[0] for c in [*groupby, *[f[0] for f in filters], *([time_col] if time_col else [])]]
    rollup = _smallest_rollup(star, ms, set(used))
    if rollup is None:
        star = star.with_(fact_orders=_bounded(star.fact_orders, dataset, filters))
    # the fact on one foreign key is no larger than that dimension; on several keys, or on a key and
    # a fact column, it comes near its own size, and joining first sends only the final groups
    few = len(set(used) - {"fact"}) + sum(spec.get(c, ("fact", c))[0] == "fact" for c in groupby) <= 1
    # dimensions that don't grow with the data, so that bitmaps are few (operators.distinct)
    countable = ORDER_NO in star.fact_orders.columns and set(used) <= {"dim_date", "dim_geography", "dim_ship_mode"}
    if rollup is not None:
        out, keys = _from_rollup(star, rollup, dataset, ms, list(groupby), list(filters), time_col, grain)
    elif few and all(m.parts is not None and (countable or not m.counts_orders) for m in ms):
        out, keys = _rolled(star, dataset, ms, list(groupby), list(filters), time_col, grain)
    else:
        out, keys = _direct(star, dataset, ms, list(groupby), list(filters), time_col, grain)
    first = F.col(ms[0].name)
    order = [first.desc_nulls_first() if order_desc else first.asc_nulls_last(), *[F.col(k).asc() for k in keys]]
    out = out.orderBy(*order)
    return out.limit(row_limit) if row_limit is not None else out


def _smallest_rollup(star: Star, ms: Sequence[Metric], used: set[str]) -> str | None:
    """The smallest published roll-up, by its files, that holds the metrics and the keys of the tables
    used; None where only the fact does."""
    if star.rollups is None or "fact" in used or any(m.stored is None for m in ms):
        return None
    keys = {_JOIN_KEY[t][0] for t in used}
    able = [n for n, by in ROLL_UPS.items() if keys <= set(by)]
    holding = star.rollups.among(able) if isinstance(star.rollups, OnDemand) else {n: star.rollups[n] for n in able if n in star.rollups}
    return min(holding, key=lambda n: (size_in_bytes(holding[n]), n), default=None)


def _date_keys(column, value) -> tuple[int, int] | None:
    """The date key range [first, after) of a year or a day; None for values that are neither."""
    if column == ("dim_date", "year") and isinstance(value, int):
        return value * 10000, (value + 1) * 10000
    if column == ("dim_date", "full_date"):
        if isinstance(value, str) and re.fullmatch(r"\d{4}-\d{2}-\d{2}", value, re.ASCII):
            day = int(value.replace("-", ""))
        elif type(value) is date:  # a datetime has a time, which no key tells
            day = value.year * 10000 + value.month * 100 + value.day
        else:
            return None
        return day, day + 1
    return None


def _bounded(fact: DataFrame, dataset: str, filters) -> DataFrame:
    """The fact (or a roll-up by day) with the key range of filters on the order date or year, so that they
    reach the scan.  The filters themselves still run on the dimension."""
    key = F.col("order_date_key")
    for subject, op, value in filters:
        op = op.upper()
        ranges = [_date_keys(DATASETS[dataset].get(subject), v) for v in (value if op == "IN" else [value])]
        if not ranges or None in ranges:
            continue
        first, after = min(r[0] for r in ranges), max(r[1] for r in ranges)
        if op in ("==", "IN", ">=", ">"):
            fact = fact.filter(key >= (after if op == ">" else first))
        if op in ("==", "IN", "<=", "<"):
            fact = fact.filter(key < (first if op == "<" else after))
    return fact


def _filter(df: DataFrame, dataset: str, subject: str, op: str, value, col: Column) -> DataFrame:
    if dataset == "discount" and subject == "discount_tier" and op == "==":
        # same rows as testing the CASE label, but prunable row groups
        return df.filter(tier_condition(str(value), "discount", "ascii"))
    return df.filter(_OPS[op.upper()](col, value))


def _grain(df: DataFrame, time_col: str | None, grain: str | None, keys: list[str]):
    if time_col and grain:
        # Truncate to the grain; trunc keeps a DATE (date_trunc would give a timestamp) but knows no days
        if GRAINS[grain] == "day":
            return df, [time_col, *keys]
        return df.withColumn(time_col, F.trunc(F.col(time_col), GRAINS[grain])), [time_col, *keys]
    return df, keys


def _direct(star, dataset, ms, groupby, filters, time_col, grain):
    """Join the needed dimensions to every fact row, then aggregate (any metric)."""
    cols = list(dict.fromkeys(
        [*groupby, *[f[0] for f in filters], *[c for m in ms for c in m.columns], *([time_col] if time_col else [])]
    ))
    df = dataset_frame(star, dataset, cols)
    for subject, op, value in filters:
        df = _filter(df, dataset, subject, op, value, F.col(subject))
    df, keys = _grain(df, time_col, grain, groupby)
    aggs = [m.build().alias(m.name) for m in ms]
    return (df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)), keys


def _rolled(star, dataset, ms, groupby, filters, time_col, grain):
    """Aggregate the fact on the foreign keys first, join dimensions to the partial
    aggregates, then combine them (additive metrics, and counts of orders by bitmaps)."""
    spec = DATASETS[dataset]
    wanted = [*groupby, *[f[0] for f in filters], *([time_col] if time_col else [])]
    unknown = [c for c in wanted + [c for m in ms for c in m.columns] if c not in spec]
    if unknown:
        raise KeyError(f"dataset {dataset!r} has no column(s) {unknown}")
    tables = sorted({spec[c][0] for c in wanted} - {"fact"})
    fact = star.fact_orders
    for subject, op, value in filters:
        if spec[subject][0] == "fact":
            src = spec[subject][1] or "discount"
            col = discount_tier(F.col("discount"), "ascii") if subject == "discount_tier" else F.col(src)
            fact = _filter(fact, dataset, subject, op, value, col)
    held = {}
    for subject, op, value in filters:
        t, src = spec[subject]
        if t != "fact":  # rows of the fact that the filter drops are not rolled up
            held[t] = _filter(held.get(t, star.tables()[t]), dataset, subject, op, value, F.col(src))
    for t, dim in held.items():
        fk, pk = _JOIN_KEY[t]
        fact = fact.join(dim.select(F.col(pk).alias(fk)), fk, "left_semi")
    fact_keys = []
    for c in groupby:
        if spec[c][0] == "fact":
            fact_keys.append((discount_tier(F.col("discount"), "ascii") if c == "discount_tier"
                              else F.col(spec[c][1])).alias(c))
    parts = {k: v for m in ms for k, v in m.parts().items()}
    orders = any(m.counts_orders for m in ms)
    roll = fact.groupBy(*[_JOIN_KEY[t][0] for t in tables], *fact_keys, *([block()] if orders else [])).agg(
        *[v.alias(k) for k, v in parts.items()], *([orders_seen().alias("_orders")] if orders else [])
    )
    for t in tables:
        fk, pk = _JOIN_KEY[t]
        own = [c for c in dict.fromkeys(wanted) if spec[c][0] == t]
        roll = roll.join(star.tables()[t].select(F.col(pk).alias(fk), *[F.col(spec[c][1]).alias(c) for c in own]),
                         fk)
    roll, keys = _grain(roll, time_col, grain, groupby)
    if orders:  # an order that several keys of one group have is in each of their bitmaps
        merged = {k: m.merge(k) for m in ms for k in m.parts()}
        roll = roll.groupBy(*keys, BLOCK).agg(F.bitmap_or_agg("_orders").alias("_orders"), *[v.alias(k) for k, v in merged.items()])
    aggs = [m.final().alias(m.name) for m in ms]
    return (roll.groupBy(*keys).agg(*aggs) if keys else roll.agg(*aggs)), keys


def _from_rollup(star, rollup, dataset, ms, groupby, filters, time_col, grain):
    """Join dimensions, filtered, to the rows of a roll-up and add its sums up."""
    spec = DATASETS[dataset]
    wanted = list(dict.fromkeys([*groupby, *([time_col] if time_col else [])]))
    unknown = [c for c in [c for m in ms for c in m.columns] if c not in spec]
    if unknown:
        raise KeyError(f"dataset {dataset!r} has no column(s) {unknown}")
    roll = _bounded(star.rollups[rollup], dataset, filters)
    tables = sorted({spec[c][0] for c in [*wanted, *[f[0] for f in filters]]})
    parts = {part: column for m in ms for part, column in m.stored.items()}
    roll = roll.select(*[_JOIN_KEY[t][0] for t in tables], *[F.col(c).alias(p) for p, c in parts.items()])
    for t in tables:
        fk, pk = _JOIN_KEY[t]
        dim = star.tables()[t]
        for subject, op, value in filters:
            if spec[subject][0] == t:
                dim = _filter(dim, dataset, subject, op, value, F.col(spec[subject][1]))
        own = [F.col(spec[c][1]).alias(c) for c in wanted if spec[c][0] == t]
        roll = roll.join(dim.select(F.col(pk).alias(fk), *own), fk)
    roll, keys = _grain(roll, time_col, grain, groupby)
    aggs = [m.final().alias(m.name) for m in ms]
    return (roll.groupBy(*keys).agg(*aggs) if keys else roll.agg(*aggs)), keys


# -------------------------------------------------------------------- charts

HEAVY = "Heavy (>20%)"


def _charts() -> dict[str, Callable[[Star], DataFrame]]:
    return {
        "chart_revenue_kpi": lambda s: metric_query(s, metrics=["total_revenue"]),
        "chart_profit_kpi": lambda s: metric_query(s, metrics=["total_profit"]),
        "chart_annual_trend": lambda s: metric_query(
            s, metrics=["total_revenue", "total_profit"], time_col="order_date", grain="P1Y"),
        "chart_revenue_by_region": lambda s: metric_query(s, metrics=["total_revenue"], groupby=["region"]),
        "chart_category": lambda s: metric_query(s, metrics=["total_revenue", "total_profit"], groupby=["category"]),
        "chart_top_customers": lambda s: metric_query(
            s, metrics=["total_profit"], groupby=["customer_name"], row_limit=10, order_desc=True),
        "chart_segment_quarter": lambda s: metric_query(
            s, metrics=["total_revenue"], groupby=["segment"], time_col="order_date", grain="P3M"),
        "chart_ship_mode": lambda s: metric_query(
            s, metrics=["order_count", "total_revenue", "total_profit", "avg_order_value"], groupby=["ship_mode"]),
        "chart_discount_bubble": lambda s: metric_query(
            s, "discount", [adhoc("AVG", "discount"), adhoc("SUM", "profit"), adhoc("SUM", "sales")],
            groupby=["sub_category", "category"]),
        "chart_tier_segment": lambda s: metric_query(
            s, "discount", [adhoc("SUM", "profit", "Total Profit")], groupby=["discount_tier", "segment"]),
        "chart_states_region": lambda s: metric_query(
            s, metrics=["total_revenue", "total_profit", "order_count"], groupby=["state", "region"],
            order_desc=False, row_limit=50),
        "chart_subcategory_profit": lambda s: metric_query(
            s, "discount", [adhoc("SUM", "profit", "Profit")], groupby=["sub_category"], order_desc=False),
        "chart_heavy_damage": lambda s: metric_query(
            s, "discount", [adhoc("SUM", "profit", "Total Profit")], groupby=["region"],
            filters=[("discount_tier", "==", HEAVY)]),
        "chart_profit_by_state": lambda s: metric_query(
            s, metrics=["total_profit", "total_revenue", "order_count"], groupby=["state"], order_desc=False),
        "chart_subcategory": lambda s: metric_query(
            s, metrics=["total_revenue", "total_profit"], groupby=["sub_category"], order_desc=True),
        "chart_recommendations": vds_recommendations,
    }


CHARTS = _charts()
