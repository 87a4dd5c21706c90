"""Write a star as Parquet and publish it in one step.

Layout under ``root``::

    root/<version>/<table>/part-*.parquet   one folder per table
    root/_published/part-*.parquet          one marker row per published version

A version becomes visible only when its marker is appended, after every
table is written and the audits (D1-D4) found nothing.  Readers take the
highest published version, so they never see dimensions without their facts
or a half-written table; a failed load leaves an unpublished folder behind
and changes nothing.  Task retries after a lost executor rewrite the same
files through Spark's output committer.  A version's name begins with its
number, one more than the version it was built on, so no clock decides which
is newest.

Only a missing folder reads as "nothing published" or "no such table"; any
other failure to read stops the load, which would otherwise publish a batch
as if it were the whole star.

Facts are append-only: a full load writes the whole fact table, an
incremental load (``publish_increment``) writes only its new fact rows and
lists the earlier fact folders in its marker (``fact_parts``), so a small
batch never rewrites a large fact table.  Dimensions are rewritten per
version (copy-on-write).  Roll-ups (``operators.rollups``) are written from a
version's own fact folder after the audits, and the marker lists their folders
(``rollup_parts``) as it does the facts'; a star on facts published without
them has none, and its queries read the fact.  One writer per ``root`` is
assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rollups as RU
from ..operators.audit import audit_all
from ..plans.star import Star
from ..session import COMPRESSION

MARKERS = "_published"
MARKER_SCHEMA = "version string, published_at timestamp, fact_parts array<string>, rollup_parts array<string>"
ROLL_UPS = "rollups"
MAX_RECORDS_PER_FILE = 20_000_000


class AuditFailed(RuntimeError):
    pass


def _next_version(spark: SparkSession, root: str) -> str:
    """The name of the version after the newest published one."""
    row = published(spark, root)
    number = int(row.version.split("-")[0]) + 1 if row else 1
    return f"{number:012d}-{uuid.uuid4().hex[:8]}"


def _if_there(read) -> DataFrame | None:
    """What ``read()`` gives, or None where its folder does not exist."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_tables(star: Star, root: str, version: str, skip: tuple[str, ...] = ()) -> dict[str, str]:
    """Write each table once (dimensions first, then facts)."""
    paths = {}
    tables = star.tables()
    for name in sorted(set(tables) - set(skip), key=lambda t: (t == "fact_orders", t)):
        df = tables[name]
        if name == "fact_orders":
            # clustered on the order date inside each file: row-group min/max
            # statistics then skip date ranges a filter excludes
            df = df.sortWithinPartitions("order_date_key")
        path = f"{root.rstrip('/')}/{version}/{name}"
        # bounded file sizes however large a task's share is
        df.write.mode("errorifexists").option("compression", COMPRESSION).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)
        paths[name] = path
    return paths


DIMENSIONS = ["dim_date", "dim_customer", "dim_geography", "dim_product", "dim_ship_mode"]
OPTIONAL = ["dim_product_recommendations"]


def _path(root: str, version: str, name: str) -> str:
    return f"{root.rstrip('/')}/{version}/{name}"


def _write_rollups(spark: SparkSession, root: str, version: str, names: Collection[str] = tuple(RU.ROLL_UPS), mode: str = "errorifexists") -> list[str]:
    """Write roll-ups of a version's own fact folder, all or some; [version], or [] where it has no rows."""
    fact = spark.read.parquet(_path(root, version, "fact_orders"))
    if fact.isEmpty():
        return []
    # rows of one roll-up lie in every task's output, so each gets a few files as sorted by its keys
    out = RU.roll_up(fact, names).sortWithinPartitions(RU.NAME, *RU.KEYS)
    out.write.mode(mode).partitionBy(RU.NAME).option("compression", COMPRESSION).option(
        "maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(_path(root, version, ROLL_UPS))
    return [version]


def write_rollups(spark: SparkSession, root: str, names: Collection[str] = tuple(RU.ROLL_UPS)) -> dict[str, DataFrame] | None:
    """Roll-ups of the newest published facts, those of ``names``, written now and in no marker; None where there are no rows."""
    row = published(spark, root)
    parts = [p for part in row.fact_parts for p in _write_rollups(spark, root, part, names, "append")]
    return _read_rollups(spark, root, parts, names)


def _read_rollups(spark: SparkSession, root: str, parts: list[str] | None, names: Collection[str] = tuple(RU.ROLL_UPS)) -> dict[str, DataFrame] | None:
    if not parts:
        return None
    found, reader = {}, spark.read
    for name in names:
        keys = RU.ROLL_UPS[name]
        df = reader.parquet(*[f"{_path(root, p, ROLL_UPS)}/{RU.NAME}={name}" for p in parts])
        reader = spark.read.schema(df.schema)  # the same for all
        found[name] = df.select(*keys, *RU.MEASURES)
    return found


def read_version(
    spark: SparkSession, root: str, version: str, fact_parts: list[str] | None = None, rollup_parts: list[str] | None = None
) -> Star:
    found = {n: spark.read.parquet(_path(root, version, n)) for n in DIMENSIONS}
    for n in OPTIONAL:
        df = _if_there(lambda n=n: spark.read.parquet(_path(root, version, n)))
        if df is not None:
            found[n] = df
    found["fact_orders"] = spark.read.parquet(*[_path(root, p, "fact_orders") for p in (fact_parts or [version])])
    return Star(**found, rollups=_read_rollups(spark, root, rollup_parts))


def markers(spark: SparkSession, root: str) -> DataFrame | None:
    """One row per published version; None where nothing was ever published."""
    return _if_there(lambda: spark.read.schema(MARKER_SCHEMA).parquet(f"{root.rstrip('/')}/{MARKERS}"))


def published(spark: SparkSession, root: str):
    """(version, fact_parts, rollup_parts) of the newest published version, or None."""
    m = markers(spark, root)
    # one small row per published version
    return None if m is None else m.orderBy(F.col("version").desc()).select("version", "fact_parts", "rollup_parts").first()


def published_version(spark: SparkSession, root: str) -> str:
    row = published(spark, root)
    if row is None:
        raise FileNotFoundError(f"no published star under {root}")
    return row.version


def _audit_or_fail(tables: dict[str, DataFrame], version: str) -> None:
    bad = audit_all(tables).filter(F.col("n") > 0)
    problems = bad.limit(20).collect()  # at most 20 small audit rows
    if problems:
        raise AuditFailed(f"star {version} not published: {[r.asDict() for r in problems]}")


def _mark(spark: SparkSession, root: str, version: str, parts: list[str], rollup_parts: list[str] | None) -> None:
    def texts(values: list[str] | None):
        return F.lit(None if values is None else values).cast("array<string>")

    marker = spark.range(1).select(
        F.lit(version).alias("version"),
        F.current_timestamp().alias("published_at"),
        texts(parts).alias("fact_parts"),
        texts(rollup_parts).alias("rollup_parts"),
    )
    marker.write.mode("append").parquet(f"{root.rstrip('/')}/{MARKERS}")


def publish_star(star: Star, root: str, audit: bool = True, rollups: bool = True) -> str:
    """Write every table, audit, then publish; returns the version name.  Without ``rollups``
    neither this version nor its increments get any."""
    spark = star.fact_orders.sparkSession
    version = _next_version(spark, root)
    write_tables(star, root, version)
    if audit:
        _audit_or_fail(read_version(spark, root, version).tables(), version)
    _mark(spark, root, version, [version], _write_rollups(spark, root, version) if rollups else None)
    return version


def publish_increment(star: Star, new_facts: DataFrame, root: str, audit: bool = True) -> str:
    """E16 for an incremental load: dimensions of ``star`` in full, only
    ``new_facts`` as the fact folder of this version.

    The audit covers the new dimensions and the new fact rows (not-NULL,
    keys resolve, ``row_id`` unique within the batch; overlap with loaded
    rows is excluded by the insert-if-absent load itself).
    """
    spark = new_facts.sparkSession
    base = published(spark, root)
    if base is None:
        return publish_star(star.with_(fact_orders=new_facts), root, audit)
    version = _next_version(spark, root)
    write_tables(star.with_(fact_orders=new_facts), root, version)
    if audit:
        _audit_or_fail(read_version(spark, root, version).tables(), version)
    # facts published without roll-ups stay without: those of the increment alone would answer wrongly
    rolled = base.rollup_parts
    if rolled is not None:
        rolled = [*rolled, *_write_rollups(spark, root, version)]
    _mark(spark, root, version, [*base.fact_parts, version], rolled)
    return version


def publish_recommendations(star: Star, root: str, audit: bool = True) -> str:
    """A version with the dimensions and recommendations of ``star`` on the facts already published: none is rewritten."""
    spark = star.dim_date.sparkSession
    base = published(spark, root)
    if base is None:
        raise FileNotFoundError(f"no published star under {root}")
    version = _next_version(spark, root)
    write_tables(star, root, version, skip=("fact_orders",))
    if audit:
        tables = read_version(spark, root, version, list(base.fact_parts)).tables()
        _audit_or_fail({**tables, "fact_orders": tables["fact_orders"].limit(0)}, version)
    _mark(spark, root, version, list(base.fact_parts), base.rollup_parts)
    return version


def read_star(spark: SparkSession, root: str) -> Star:
    """The newest published star under ``root``."""
    row = published(spark, root)
    if row is None:
        raise FileNotFoundError(f"no published star under {root}")
    return read_version(spark, root, row.version, list(row.fact_parts), row.rollup_parts)
