"""The CSV sources are written by many tasks, and compressed; repeated rows are found by more hashes."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starbeam.plans import catalog as CT
from starbeam.session import work_dir
from starbeam.sources import fixture as FX
from starbeam.sources.csv import file_report, read_orders_csv


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def contents(df):
    return sorted(map(str, df.collect()))


def test_awkward_files_are_written_by_many_tasks(spark, fx, tmp_path):
    raw = FX.raw_orders(fx.flat).repartition(5)
    FX.write_awkward_csv(raw, str(tmp_path / "many"))
    FX.write_awkward_csv(raw.coalesce(1), str(tmp_path / "one"))
    got, want = ([f"{tmp_path}/{d}/part{i}" for i in range(3)] for d in ("many", "one"))
    assert file_report(spark, want).count() == 3 and file_report(spark, got).count() == 15

    def report(paths):
        by = file_report(spark, paths).groupBy(F.regexp_extract("_file", "/part([0-9])/", 1)).agg(
            F.bool_and("utf8"), F.sum("rows"), F.sum("short_rows"), F.sum("surplus_rows"), F.count_distinct("header"))
        return contents(by)

    assert report(got) == report(want)
    assert contents(read_orders_csv(spark, got, max_surplus=None)) == contents(read_orders_csv(spark, want, max_surplus=None))
    FX.write_awkward_csv(raw.filter("row_id = '3'"), str(tmp_path / "few"))  # a folder without rows has its header
    assert read_orders_csv(spark, [f"{tmp_path}/few/part{i}" for i in range(3)]).count() == 1
    assert file_report(spark, [f"{tmp_path}/few/part{i}" for i in range(3)]).agg(F.sum("rows")).first()[0] == 1


def test_raw_csv_is_compressed_and_looked_at_once(fx):
    first = CT._raw_csv(fx)
    files = [f for f in first.inputFiles() if "/raw-csv-" in f]
    assert files and all(f.endswith(".csv.gz") for f in files)
    base = Path(work_dir(fx.spark).removeprefix("file:"))
    before = len(list(base.glob("csv-files-*")))
    assert contents(CT._raw_csv(fx).select("row_id")) == contents(FX.raw_orders(fx.flat).select("row_id"))
    assert len(list(base.glob("csv-files-*"))) == before


@pytest.mark.parametrize("most", [3, 4])
def test_repeated_hashes_beyond_the_bound_of_rows(spark, monkeypatch, most):
    from starbeam.operators import clean as C

    monkeypatch.setattr(C, "MAX_BROADCAST_ROWS", most)
    raw = spark.range(40).selectExpr("cast(id % 30 as string) as a", "cast(null as string) as b")
    got = C.dedup_rows(raw)
    assert contents(got) == contents(raw.distinct())
    assert ("xxhash64" in plan(got)) == (most == 4)  # ten hashes repeat


def test_dates_are_parsed_once(spark):
    from starbeam.operators import clean as C

    rows = [("1/2/2016", "1/3/2016", "c", "p"), ("13/45/2016", "1/3/2016", "c", "p"), (None, "1/3/2016", "c", "p"), ("1/2/2016", "", "c", "p"),
            ("1/2/2016", "1/4/2016", None, "p")]
    raw = spark.createDataFrame(rows, "order_date string, ship_date string, customer_id string, product_id string")
    parsed = C.parse_dates(raw)
    assert parsed.columns == raw.columns and parsed.count() == 5
    got = C.drop_null_keys(parsed)
    assert [tuple(map(str, r)) for r in got.collect()] == [("2016-01-02", "2016-01-03", "c", "p")]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("M/d/yyyy") == 2  # one for each column
