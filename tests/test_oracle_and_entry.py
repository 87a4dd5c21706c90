"""Spark results against the DuckDB oracle on the smallest tables."""

from collections import Counter

import duckdb
import pytest

from tests.conftest import SMOKE

def _keys():
    from starbeam.plans.catalog import QUERIES

    return sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem".split():  # the tables the oracle reads
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


@pytest.mark.parametrize("key", _keys())
def test_matches_oracle(spark, fx, con, key):
    from __spark_entry__ import oracle_sql, queries

    df = queries()[key](spark, SMOKE)
    res = con.execute(oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(ocols, res.fetchall())


def test_every_query_has_oracle_or_is_rows_only():
    from __spark_entry__ import oracle_sql, queries

    assert set(_keys()) <= set(queries())
    assert set(_keys()) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["category", "total_revenue", "total_profit", "profit_margin_pct"]
    assert df.count() > 0
