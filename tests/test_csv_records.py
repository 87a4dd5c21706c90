"""Records of quoted CSV files, cut from byte ranges of any size, against Python's csv reader."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from starbeam.schema import SOURCE_HEADERS
from starbeam.session import new_path, work_dir
from starbeam.sources.csv import RaggedRows, file_report, read_orders_csv
from starbeam.sources.csv_records import UnclosedQuote, line_records, lines, n_fields, records
from starbeam.streaming.incremental import load_files, start_incremental_load
from starbeam.sources.star_store import read_star

HEADERS = list(SOURCE_HEADERS)


@pytest.fixture
def small_ranges(spark):
    """Files are read in byte ranges of some hundred bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "300")
    spark.conf.set(keys[1], "0")
    yield
    for k, v in zip(keys, before, strict=True):
        spark.conf.set(k, v)


def _field(rng):
    kind = rng.randrange(8)
    if kind == 0:
        return "line one\nline two, with comma"
    if kind == 1:
        return '"quoted" start'
    if kind == 2:
        return "\n" * rng.randrange(1, 4)
    if kind == 3:
        return "x" * rng.randrange(200, 900) + '\n"' + "y" * rng.randrange(0, 700)
    if kind == 4:
        return 'ends with quote"'
    return rng.choice(["", "plain", "é ü", "a,b", "1.5", "two  words"])


def test_records_equal_pythons_reader(spark, tmp_path, small_ranges):
    rng = random.Random(5)
    want = {}
    for f in range(3):
        rows = [[_field(rng) for _ in range(4)] for _ in range(40)] + [["last", "12\" unquoted", "x", "y"]]
        out = io.StringIO()
        csv.writer(out, lineterminator="\r\n" if f % 2 else "\n").writerows(rows)
        text = out.getvalue().replace('"12"" unquoted"', '12" unquoted')  # a quote in the middle of a bare field
        (tmp_path / f"{f}.csv").write_bytes(text.encode())
        want[f"{f}.csv"] = list(csv.reader(io.StringIO(text, newline="")))
    source = lines(spark, str(tmp_path))
    assert source.rdd.getNumPartitions() > 3 * 4  # the files are split
    got = records(source).orderBy("_file", "_start", "_id").select("_file", "record", n_fields(F.col("record")).alias("n")).collect()
    for name, rows in want.items():
        found = [next(csv.reader(io.StringIO(r.record, newline=""))) for r in got if r._file.endswith(name)]
        assert found == rows
        assert [r.n for r in got if r._file.endswith(name)] == [4] * len(rows)


def test_unclosed_quotes_stop(spark, tmp_path, small_ranges):
    (tmp_path / "open.csv").write_text('a,b\n1,"never closed\n' + "2,3\n" * 200)
    with pytest.raises(UnclosedQuote, match="ends inside quotes"):
        records(lines(spark, str(tmp_path)))
    (tmp_path / "open.csv").write_text('a,b\n1,"closed late\n' + "2,3\n" * 200 + '"\n')
    assert records(lines(spark, str(tmp_path))).count() == 2
    with pytest.raises(Exception, match="a record of over 500 bytes"):
        records(lines(spark, str(tmp_path)), max_record=500).collect()


def test_plain_lines_are_records(spark, tmp_path):
    (tmp_path / "plain.csv").write_bytes(b"a,b\r\n\r\n1,2\r\n\n3,\xe9\r\n")
    got = line_records(lines(spark, str(tmp_path))).select(F.col("record").cast("binary").alias("r")).collect()
    assert [bytes(r.r) for r in got] == [b"a,b", b"1,2", b"3,\xe9"]


def _order(i, **changes):
    row = dict(zip(HEADERS, [str(i), f"O-{i}", "1/3/2016", "1/5/2016", "First Class", f"CG-{i}", "Zoë", "Consumer", "United States", "Boston",
                             "MA", "02138", "East", f"T-{i}", "Technology", "Machines", "Name", "10", "1", "0", "3"], strict=True))
    return row | changes


def _write(path, columns, rows, encoding="utf-8", bom=False, cut=None):
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n")
    w.writerow(columns)
    for i, r in enumerate(rows):
        fields = [r[c] for c in columns]
        w.writerow(fields if cut is None or i not in cut else fields[: cut[i]] + ["more"] * (cut[i] - len(fields)))
    path.write_bytes(("﻿" if bom else "").encode() + out.getvalue().encode(encoding))


def _folder(tmp_path):
    swapped = list(HEADERS)
    for a, b in (("Customer ID", "Product ID"), ("Row ID", "Profit")):
        i, j = swapped.index(a), swapped.index(b)
        swapped[i], swapped[j] = swapped[j], swapped[i]
    _write(tmp_path / "a.csv", HEADERS, [_order(1), _order(2, **{"Product Name": 'two\nlines, "quoted"'})], bom=True)
    _write(tmp_path / "b.csv", swapped, [_order(3), _order(4)], encoding="latin-1")
    _write(tmp_path / "c.csv", HEADERS[::-1] + ["Note"], [_order(5, Note="n"), _order(6, Note="n")], cut={0: 22 - 2, 1: 24})
    return str(tmp_path)


def test_columns_go_by_name_in_every_file(spark, tmp_path, small_ranges):
    path = _folder(tmp_path)
    with pytest.raises(RaggedRows, match="surplus"):
        read_orders_csv(spark, path)
    with pytest.raises(RaggedRows, match="missing"):
        read_orders_csv(spark, path, max_surplus=1, max_short=0)
    got = {r.row_id: r for r in read_orders_csv(spark, path, max_surplus=1).collect()}
    # the fifth row lacks its last two fields, of which one is the row id
    assert set(got) == {"1", "2", "3", "4", "6", None}
    for i, r in got.items():
        if i is not None:
            assert (r.customer_id, r.product_id, r.profit, r.customer_name) == (f"CG-{i}", f"T-{i}", "3", "Zoë")
    assert got["2"].product_name == 'two\nlines, "quoted"'
    report = {r._file[-5:]: (r.utf8, r.rows, r.short_rows, r.surplus_rows) for r in file_report(spark, path).collect()}
    assert report == {"a.csv": (True, 2, 0, 0), "b.csv": (False, 2, 0, 0), "c.csv": (True, 2, 1, 1)}


def test_stream_reads_each_file_by_its_header(spark, tmp_path):
    (tmp_path / "c").mkdir()
    _folder(tmp_path / "c")
    (tmp_path / "c" / "c.csv").unlink()
    root, ckpt = new_path(spark, "csv-star"), new_path(spark, "csv-ckpt")
    start_incremental_load(spark, str(tmp_path / "c"), root, ckpt).awaitTermination(300)
    star = read_star(spark, root)
    facts = star.fact_orders.join(star.dim_customer, "customer_key").join(star.dim_product, "product_key")
    assert sorted((r.row_id, r.customer_id, r.product_id, float(r.profit)) for r in facts.collect()) == [
        (i, f"CG-{i}", f"T-{i}", 3.0) for i in (1, 2, 3, 4)]
    assert load_files(spark, [], root) is None


def test_a_load_removes_its_intermediate_tables(spark, tmp_path):
    from pathlib import Path

    _folder(tmp_path)
    base = Path(work_dir(spark).removeprefix("file:"))
    root = new_path(spark, "tidy-star")
    before = {p.name for p in base.iterdir()}
    load_files(spark, [str(tmp_path / "a.csv")], root)
    load_files(spark, [str(tmp_path / "b.csv")], root)
    assert {p.name for p in base.iterdir()} - before == {root.rsplit("/", 1)[1]}


def test_empty_and_blank_files(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert read_orders_csv(spark, str(tmp_path)).count() == 0
    (tmp_path / "head.csv").write_text(",".join(HEADERS) + "\n\n")
    assert read_orders_csv(spark, str(tmp_path)).count() == 0
