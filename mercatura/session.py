"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# The plans carry no broadcast hint on data that can grow and no salt: join inputs are left
# as plain shuffles so that AQE can turn small ones into broadcasts and split skewed ones.
# "force" lets it split even where a following aggregation then needs one more shuffle.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows that reach Python at once: whole texts are among them.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the run-time options the plans rely on. All of them can change in a live session.

    They stay set: the plans are lazy, so nobody here knows when the last of them has run.
    """
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _is_local(spark: SparkSession) -> bool:
    """Whether driver and tasks are one process. The executors of ``local-cluster`` have folders of their own."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


@cache
def _local_scratch() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="mercatura-")


def _means_local_disk(spark: SparkSession, path: str) -> bool:
    """A path without a scheme, where the default file system is the local one."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    return "://" not in path and not path.startswith("file:") and default.startswith("file:")


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


# What was found out about a folder, by application.
_shared: dict[tuple[str, str], bool] = {}


def _is_shared(spark: SparkSession, base: str) -> bool:
    """Whether rows that tasks write under ``base`` are all found again. Tried once, by two small jobs."""
    asked = (spark.sparkContext.applicationId, base)
    if asked not in _shared:
        _shared[asked] = _rows_return(spark, base)
    return _shared[asked]


def _rows_return(spark: SparkSession, base: str) -> bool:
    path = f"{base.rstrip('/')}/probe-{uuid.uuid4().hex}"
    rows = 2 * max(spark.sparkContext.defaultParallelism, 2)
    try:
        spark.range(0, rows, 1, rows).write.parquet(path)
        return spark.read.schema("id long").parquet(path).count() == rows
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    finally:
        _delete(spark, path)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``; if there is none, a scratch one in local mode,
    and one in the warehouse on a cluster.

    A path without a scheme may be a mount or a machine's own disk, which is tried out; so is the warehouse.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if base is None and _is_local(spark):
        # Goes when the interpreter ends.
        base = _local_scratch().name
    elif base is None:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_mercatura"
        if not _is_shared(spark, base):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    elif not _is_local(spark) and _means_local_disk(spark, base) and not _is_shared(spark, base):
        raise ValueError(f"{base} is on a machine's own disk: rows that executors wrote there are missing")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder. What is written there stays until ``drop_scratch``."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a path that ``scratch_path`` gave, once nothing reads it any more."""
    if not path.startswith(shared_dir(spark) + "/"):
        raise ValueError(f"{path} is no scratch path")
    _delete(spark, path)


# Has Spark delete an action's shuffle files with its end, not when the driver next collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What actions shuffle goes when they end. Only for DataFrames made here that no other action runs."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def checkpointed(df):
    """Write ``df`` to the shared folder once and go on from the files. What that shuffled goes at once."""
    shared_dir(df.sparkSession)
    with shuffles_go(df.sparkSession):
        # A frame follows the options it was made under.
        return df.select("*").checkpoint()
