"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir

#: ASCII white space, as the word patterns of the contracts name it
SPACE_RUN = r"[ \t\n\x0B\f\r]+"


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{work_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def frozen(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back.

    Cuts the lineage, and lets several consumers read one result even when
    executors are lost in between.
    """
    return written(df, shared_path(df.sparkSession, name))


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as a Parquet table to ``path``, where nothing is yet, and read back."""
    spark, schema = df.sparkSession, df.schema
    # once written, the shuffle files behind the table are of no use
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    return spark.read.schema(schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that ``df`` does not have, nor with an underscore more."""
    mark = "_"
    while any(c.lower().startswith(f"{mark}{n}") for c in df.columns for n in names):
        mark += "_"
    return [mark + n for n in names]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Catalyst may inline a projected array into a lambda that reads it per
    element; bound as a lambda variable, it is a value.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
