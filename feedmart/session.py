"""Session settings the jobs rely on, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def pin(spark: SparkSession) -> SparkSession:
    """Fix the session zone: feed times are wall-clock text that is shifted to UTC explicitly."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A new place that every executor can reach, removed when the application ends.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``. A local session may leave
    that unset; then a fresh temporary folder of this machine is enough.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="feedmart-")
        _until_the_end(spark, base)
    folder = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _until_the_end(spark, folder)
    return f"{folder}/data"


def _until_the_end(spark: SparkSession, folder: str) -> None:
    """Make a folder that its file system deletes as the driver's JVM ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path)
    store.deleteOnExit(path)


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read from there: what follows from it does not compute it again."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def reused(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` for the several outputs built from it, and let it go afterwards.

    Blocks spill to disk, and a lost executor's blocks are computed again from the lineage.
    """
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
