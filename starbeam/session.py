"""Spark session settings and the shared work folder.

On a cluster the session already names ``spark.checkpoint.dir`` (a shared
folder every executor can reach); we only read it.  Local runs and tests
leave it unset, so ``work_dir`` creates a private scratch folder once per
process and points the session at it.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: codec of the tables that a load writes
COMPRESSION = "zstd"

_LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "starbeam") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("STARBEAM_DRIVER_MEMORY", "16g"))
    )
    for k, v in _LOCAL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Uses the cluster's ``spark.checkpoint.dir``; where it is unset, a local
    master (tests, local bench) gets a private folder, and any other is refused:
    a machine-local folder would scatter written tables over the executors.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not d:
            d = tempfile.mkdtemp(prefix="starbeam-ckpt-", dir=os.environ.get("STARBEAM_SCRATCH", "/tmp"))
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir()
    return d


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared work folder."""
    base = work_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives the Python workers this package (once a session), wherever they start.

    Spark distributes the archive; no worker reads the folder it came from.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="starbeam-ship-")  # the driver serves the archive from here as long as it runs
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/starbeam.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


# the paths that ``new_path`` gave out in each open ``scratch`` block
_SCOPES: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the folders that the block wrote under ``new_path`` (numbered tables, prefix sums) when it ends."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove_path(spark, path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared work folder, through the file system it is on."""
    base = work_dir(spark).rstrip("/") + "/"
    if not path.startswith(base):
        raise ValueError(f"{path} is not in the work folder {base}")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def written(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written to the work folder and read back, for as long as the block runs."""
    spark = df.sparkSession
    path = new_path(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_path(spark, path)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the work folder and read back: several readers then share one run of it."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: rows of a join side that is broadcast whatever Spark estimates: some 200 MB in each executor at most, for a few short columns
MAX_BROADCAST_ROWS = 2_000_000


def few_rows(df: DataFrame) -> bool:
    """Whether ``df`` is small enough to be broadcast whatever Spark estimates."""
    return df.count() <= MAX_BROADCAST_ROWS


def broadcast_within(df: DataFrame) -> DataFrame:
    """``df`` as the broadcast side of a join where it has ``few_rows``; else as Spark decides."""
    return F.broadcast(df) if few_rows(df) else df


def size_in_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the size of ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
