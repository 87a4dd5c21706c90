"""Report lines are numbered and cut into blocks split by split."""

import random

from test_csv_records import small_ranges  # noqa: F401

from starbeam.operators import recs as RC
from starbeam.sources.report import read_report, read_report_lines


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def contents(df):
    return sorted(map(str, df.collect()))


def test_blocks_are_cut_split_by_split(spark, tmp_path, small_ranges):  # noqa: F811
    rng = random.Random(3)
    for f in range(3):
        blocks = [f"Product ID : {f}-{i}\nProduct Name : Name {i}\nWEB INTELLIGENCE:\n" + "note\n" * rng.randrange(0, 120) + "Sources:\n- x\n"
                  for i in range(30)]
        (tmp_path / f"{f}.txt").write_text(("=" * 12 + "\n").join(["HEADER\n", *blocks]))
    read = read_report_lines(spark, str(tmp_path))
    assert read.select("split").distinct().count() > 10
    by_file = {f: p.read_text().removesuffix("\n").split("\n") for f, p in ((p.name, p) for p in tmp_path.glob("*.txt"))}
    rows = read.orderBy("report_file", "line_no").collect()
    for name, text in by_file.items():
        mine = [r for r in rows if r.report_file.endswith(name)]
        assert [r.line for r in mine] == text and [r.line_no for r in mine] == list(range(1, len(text) + 1))
    want = contents(RC.report_blocks(read_report(spark, str(tmp_path))).drop("block_no"))
    for source in (read, read.drop("split")):
        got = RC.report_blocks_from_lines(source)
        assert contents(got.drop("block_no")) == want and len(want) == 90
        assert "rangepartitioning" not in plan(got)
        assert got.select("report_file", "block_no").distinct().count() == 90


def test_stretches_without_splits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(RC, "STRETCH_LINES", 7)
    (tmp_path / "a.txt").write_text("".join("=" * 10 + f"\nProduct ID : {i}\nProduct Name : n\n" + "x\n" * (i % 40) for i in range(60)))
    want = contents(RC.report_blocks(read_report(spark, str(tmp_path))).drop("block_no"))
    got = RC.report_blocks_from_lines(read_report_lines(spark, str(tmp_path)).drop("split"))
    assert contents(got.drop("block_no")) == want and len(want) == 60
