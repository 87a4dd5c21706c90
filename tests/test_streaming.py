"""The streaming incremental load equals a batch build over the same rows."""


from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from starbeam.operators.clean import clean_orders
from starbeam.plans.star import build_star
from starbeam.schema import SOURCE_HEADERS
from starbeam.session import new_path, work_dir
from starbeam.sources.csv import decode_orders, write_orders_csv
from starbeam.sources.fixture import raw_orders
from starbeam.sources.star_store import MARKERS, AuditFailed, publish_increment, publish_star, published, read_star
from starbeam.streaming.incremental import load_batch, start_incremental_load


def test_stream_two_drops_then_replay(spark, fx):
    raw = raw_orders(fx.flat.filter(F.col("row_id") <= 1500))
    src = new_path(spark, "stream-src")
    first = raw.filter(F.col("row_id").cast("long") <= 700)
    second = raw.filter(F.col("row_id").cast("long") > 600)  # overlaps the first drop
    write_orders_csv(first.coalesce(1), f"{src}/drop=1")
    root, ckpt = new_path(spark, "stream-star"), new_path(spark, "stream-ckpt")
    q = start_incremental_load(spark, src, root, ckpt)
    q.awaitTermination(300)
    after_one = read_star(spark, root).fact_orders.count()
    write_orders_csv(second.coalesce(1), f"{src}/drop=2")
    q = start_incremental_load(spark, src, root, ckpt)
    q.awaitTermination(300)
    star = read_star(spark, root)

    expected = build_star(clean_orders(raw.withColumn("_file", F.lit("x")).transform(decode_orders)))
    assert after_one < star.fact_orders.count() == expected.fact_orders.count()
    got = star.fact_orders.select("row_id", "order_line_key", "sales")
    assert got.exceptAll(expected.fact_orders.select("row_id", "order_line_key", "sales")).count() == 0
    keys = star.fact_orders.agg(F.countDistinct("order_line_key"), F.max("order_line_key")).first()
    assert keys[0] == keys[1] == star.fact_orders.count()
    assert star.dim_customer.count() == expected.dim_customer.count()


def _csv_rows(raw):
    """Raw records as the CSV stream hands them to a batch."""
    back = {v: k for k, v in SOURCE_HEADERS.items()}
    return raw.withColumn("_file", F.lit("f")).select("_file", *[F.col(c).alias(back.get(c, c)) for c in raw.columns])


def _rows(fx, low, high):
    return _csv_rows(raw_orders(fx.flat.filter(F.col("row_id").between(low, high))))


def test_batches_of_a_fresh_checkpoint_are_loaded(spark, fx):
    """Batch ids restart with a checkpoint; what counts is the rows."""
    root = new_path(spark, "replay-star")
    load_batch(spark, _rows(fx, 1, 150), root)
    once = read_star(spark, root).fact_orders.count()
    load_batch(spark, _rows(fx, 1, 150), root)  # a replay adds nothing
    assert read_star(spark, root).fact_orders.count() == once
    src, other = new_path(spark, "stream-src"), new_path(spark, "stream-ckpt")
    write_orders_csv(raw_orders(fx.flat.filter(F.col("row_id").between(151, 300))).coalesce(1), src)
    start_incremental_load(spark, src, root, other).awaitTermination(300)  # another stream, its first batch
    facts = read_star(spark, root).fact_orders
    want = clean_orders(decode_orders(_rows(fx, 1, 300))).select("row_id").distinct().count()
    assert facts.count() == facts.select("row_id").distinct().count() == want > once


def test_versions_count_up(spark, fx):
    root = new_path(spark, "count-star")
    names = [load_batch(spark, _rows(fx, a, a + 40), root) for a in (1, 42)]
    assert [n.split("-")[0] for n in names] == ["000000000001", "000000000002"]
    assert published(spark, root).version == names[1]


def _spoil(spark, folder):
    """Make every Parquet file of a folder unreadable."""
    for f in Path(folder.removeprefix("file:")).glob("*.parquet"):
        f.write_bytes(b"no parquet")


def test_unreadable_markers_stop_the_load(spark, fx):
    root = new_path(spark, "spoilt-star")
    load_batch(spark, _rows(fx, 1, 60), root)
    _spoil(spark, f"{root}/{MARKERS}")
    with pytest.raises(Exception):
        load_batch(spark, _rows(fx, 61, 90), root)
    with pytest.raises(Exception):
        read_star(spark, root)


def test_unreadable_recommendations_are_not_dropped(spark, fx):
    root = new_path(spark, "recs-star")
    version = publish_star(fx.star, root)
    assert read_star(spark, root).dim_product_recommendations is not None
    _spoil(spark, f"{root}/{version}/dim_product_recommendations")
    with pytest.raises(Exception):
        load_batch(spark, _rows(fx, 1, 20), root)
    assert published(spark, root).version == version


def test_refused_publish_leaves_the_old_version(spark, fx):
    root = new_path(spark, "refused-star")
    version = load_batch(spark, _rows(fx, 1, 60), root)
    star = read_star(spark, root)
    orphans = star.fact_orders.withColumn("row_id", F.col("row_id") + 10**6).withColumn("customer_key", F.lit(-1).cast("long"))
    with pytest.raises(AuditFailed):
        publish_increment(star, orphans, root)
    with pytest.raises(AuditFailed):
        publish_star(star.with_(dim_customer=star.dim_customer.union(star.dim_customer)), root)
    assert published(spark, root).version == version
    assert read_star(spark, root).fact_orders.count() == star.fact_orders.count()


def test_load_leaves_no_intermediate_tables(spark, fx):
    base = Path(new_path(spark, "x").removeprefix("file:")).parent
    before = {p.name for p in base.glob("clean-*")}
    load_batch(spark, _rows(fx, 1, 30), new_path(spark, "tidy-star"))
    assert {p.name for p in base.glob("clean-*")} == before


def test_work_dir_needs_a_shared_folder_off_local_masters():
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    spark = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(spark)
