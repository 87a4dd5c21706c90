"""Roll-ups of the fact: sums of its measures by sets of its foreign keys.

A roll-up holds keys only, no attributes.  So a dimension row that an upsert
changes (a customer's segment) needs no roll-up rewritten, and an increment
adds the roll-up rows of its own fact rows: sums of sums are the sums.
Counts of values are ``lines``, as the measures are NOT NULL (D1).

``roll_up`` makes all of them in one pass over the fact (grouping sets, summed
map-side before the shuffle).  Those by one key are no larger than its
dimension, the one by day and customer no larger than the orders.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: name of each roll-up -> the fact's foreign keys it is by
ROLL_UPS = {
    "day": ("order_date_key",),
    "ship_mode": ("ship_mode_key",),
    "geography": ("geography_key",),
    "product": ("product_key",),
    "customer": ("customer_key",),
    "day_customer": ("order_date_key", "customer_key"),
}
KEYS = sorted({k for keys in ROLL_UPS.values() for k in keys})
NAME = "roll_up"
SUMMED = ["sales", "quantity", "discount", "profit", "revenue_after_discount"]
MEASURES = ["lines", *SUMMED, "discount_given"]


def measures() -> list[Column]:
    """The aggregates over fact rows that a roll-up holds, named as in MEASURES."""
    given = F.sum(F.col("sales") * F.col("discount")).alias("discount_given")
    return [F.count(F.lit(1)).alias("lines"), *[F.sum(c).alias(c) for c in SUMMED], given]


class OnDemand(Mapping[str, DataFrame]):
    """The roll-ups of some facts, written when they are first asked for; ``write`` writes some by name and reads them back."""

    def __init__(self, write: Callable[[Collection[str]], dict[str, DataFrame]]) -> None:
        self._write, self._found = write, {}

    def among(self, names: Collection[str]) -> dict[str, DataFrame]:
        """Those of ``names`` that there are (empty facts have none), the missing ones written in one pass."""
        missing = [n for n in names if n not in self._found]
        if missing:
            self._found |= self._write(missing)
        return {n: self._found[n] for n in names if n in self._found}

    def __getitem__(self, name: str) -> DataFrame:
        return self.among([name])[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.among(ROLL_UPS))

    def __len__(self) -> int:
        return len(self.among(ROLL_UPS))


def roll_up(fact: DataFrame, names: Collection[str] = tuple(ROLL_UPS)) -> DataFrame:
    """Roll-ups of ``fact``, all or some: NAME, KEYS (NULL where a roll-up is not by that key) and the measures.
    An empty fact has none."""
    sets = [[F.col(k) for k in ROLL_UPS[n]] for n in names]
    out = fact.groupingSets(sets, *[F.col(k) for k in KEYS]).agg(F.grouping_id().alias("_set"), *measures())
    # grouping_id: one bit a key, set where the row is not by it
    sets_of = {name: sum(1 << i for i, k in enumerate(reversed(KEYS)) if k not in keys) for name, keys in ROLL_UPS.items()}
    name = F.coalesce(*[F.when(F.col("_set") == bits, F.lit(n)) for n, bits in sets_of.items()])
    return out.select(name.alias(NAME), *KEYS, *MEASURES)
