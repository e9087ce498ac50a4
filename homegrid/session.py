"""Session settings and the shared work folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "homegrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings which the operators rely on.

    The session zone is UTC: ``timestamp_ntz`` columns are UTC wall time, and local
    dates come from the ``tz`` parameter of each operator.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new path below the folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local master may go without that setting: its executors share this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="homegrid-")
    return f"{base.rstrip('/')}/homegrid-{purpose}-{uuid.uuid4().hex}"


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries made and run inside go when each of them ends.

    For queries that run once: a table that is stored and read back, or a result that is
    taken to the driver. Otherwise the files stay until the driver's memory is cleaned up.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


@contextmanager
def batches_of(spark: SparkSession, most: int) -> Iterator[None]:
    """Arrow batches of the queries run inside hold ``most`` bytes or one row, for rows that are long.

    A batch lies in the memory of the executor and of its Python worker, however many rows it has.
    """
    before = spark.conf.get(BATCH_BYTES, None)
    spark.conf.set(BATCH_BYTES, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_BYTES)
        else:
            spark.conf.set(BATCH_BYTES, before)


def stored_copy(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back, for plans which use it often.

    It cuts the lineage, and unlike a cache it outlives the executors that wrote it. Its shuffle
    files go as soon as it is written.
    """
    path = shared_dir(df.sparkSession, purpose)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    copy = df.sparkSession.read.parquet(path)
    copy.stored_at = path
    return copy


def drop_stored(*copies: DataFrame) -> None:
    """Deletes stored copies that no later plan reads; a result that still reads one would fail."""
    for copy in copies:
        spark = copy.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(copy.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Collects the driver's garbage, so that broadcasts and plans of ended queries leave its memory.

    Spark drops them only when the driver's JVM collects those objects, for which the JVM takes
    its time while its heap may still grow. For long series of queries, between their rounds.
    """
    gc.collect()
    spark._jvm.System.gc()
