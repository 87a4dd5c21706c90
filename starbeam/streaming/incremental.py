"""Incremental star loads from a folder of order-line CSV files, with
Structured Streaming.

New files in ``source_dir`` are picked up by the streaming file source; each
micro-batch runs the same load as a batch re-run -- S1 decoding, E1-E5
cleaning, E12/E13 dimension upserts, E14/E15 fact rows, E15b insert-if-absent
-- and publishes a new star version that appends only the batch's new fact
rows (``publish_increment``).

Exactly once: the stream's checkpoint records which files each batch read,
and the load itself is idempotent (existing row ids and keys are skipped,
upserts write the same values), so a batch that is replayed after a failure
changes nothing.  Batch ids play no part: they start again with every new
checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import clean_orders
from ..plans.star import build_star, increment
from ..session import scratch, written
from ..sources.csv import decode_orders, read_orders_csv
from ..sources.star_store import publish_increment, publish_star, published, read_star


def order_file_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The stream of new files under ``source_dir`` (path); their contents are read by the load, file by file's own header."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir).select("path")


def load_clean(spark: SparkSession, rows: DataFrame, star_root: str) -> str:
    """One incremental load of a batch of text records into the star at ``star_root``; returns the version.

    The clean rows are written once; every dimension and the fact read that copy.
    Intermediate tables are removed once the version is published.
    """
    with scratch(spark), written(clean_orders(rows), "clean") as clean:
        if published(spark, star_root) is None:
            return publish_star(build_star(clean), star_root)
        star = read_star(spark, star_root)
        dims, new_facts = increment(star, clean)
        return publish_increment(star.with_(**dims), new_facts, star_root)


def load_batch(spark: SparkSession, batch: DataFrame, star_root: str) -> str:
    """``load_clean`` for a (static) batch of raw CSV rows under their header names, as ``decode_orders`` takes them."""
    return load_clean(spark, decode_orders(batch), star_root)


def load_files(spark: SparkSession, paths: list[str], star_root: str, max_surplus: int | None = 0) -> str | None:
    """``load_clean`` for order CSV files, each read by its own header; None where there are none."""
    if not paths:
        return None
    with scratch(spark):
        return load_clean(spark, read_orders_csv(spark, paths, max_surplus), star_root)


def _load_new_files(batch: DataFrame, star_root: str) -> None:
    # the names of one trigger's files, which the file source itself keeps on the driver
    load_files(batch.sparkSession, [r.path for r in batch.collect()], star_root)


def start_incremental_load(
    spark: SparkSession,
    source_dir: str,
    star_root: str,
    checkpoint_location: str,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the stream; ``available_now`` loads what is there and stops."""
    writer = (
        order_file_stream(spark, source_dir)
        .writeStream.foreachBatch(lambda df, epoch: _load_new_files(df, star_root))
        .option("checkpointLocation", checkpoint_location)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
