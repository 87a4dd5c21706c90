"""The training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns the documents that go on,
with the columns of ``documents``; the last one writes the mixed corpus and
returns what it holds of each.  ``run`` writes every stage's result as a
Parquet table in the shared folder and reads it back as the next one's input.

In every stage a null text counts as empty.  Repeated rows are judged alike;
near-duplicate removal leaves one row of each class of texts.  Columns that are not
mentioned pass through.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starbeam.llm.common import fresh, frozen, shared_path, table
from starbeam.llm.decontam import contamination
from starbeam.llm.minhash import one_of_each
from starbeam.llm.mixing import mix_sources
from starbeam.llm.pii import mask_personal_data
from starbeam.llm.quality import quality_filter


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or whose likelihood ratio is below the threshold."""
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each near-duplicate class, that with the smallest id, and rows without an id.

    Rows that share an id and differ in text are judged by their texts.
    """
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents."""
    i, h = fresh(docs, "id", "hash")
    found = contamination(docs, table(spark, sf_dir, "benchmark")).filter("contaminated")
    found = found.select(F.col("doc_id").alias(i), F.col("text_hash").alias(h)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(i)) & (F.xxhash64("text") == F.col(h))
    return docs.join(found, same, "left_anti")


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts; every document stays."""
    return mask_personal_data(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str, corpus: str | None = None) -> DataFrame:
    """Writes the mixed corpus (shard, slot, sid, text, parts) to ``corpus``, or else to a fresh sub-path of the shared folder.

    The result is what it holds of each document: doc_id, size, source_size, target, taken.
    """
    corpus = corpus or shared_path(spark, "pipeline-corpus")
    print(f"mixed corpus: {corpus}", file=sys.stderr)
    return mix_sources(docs, path=corpus)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mask_pii", mask_pii),
    ("mix", mix),
]

#: no SQL: the quality and near-duplicate stages rest on 64-bit hashes that DuckDB doesn't have
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, corpus: str | None = None) -> DataFrame:
    """The last stage's result; the mixed corpus goes to the Parquet folder ``corpus`` (see ``mix``)."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = mix(spark, docs, sf_dir, corpus) if stage is mix else stage(spark, docs, sf_dir)
        docs = frozen(out, f"pipeline-{name}")
    return docs
