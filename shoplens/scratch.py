"""Folders for files that a query writes and reads back."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Where it is unset, a session whose executors are threads of the driver gets a
    temporary folder, removed when Python ends.  On a cluster nothing is guessed:
    executors and driver would see different local folders.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    own = tempfile.mkdtemp(prefix="shoplens-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", own)
    return own


_made: list[str] = []


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A name for a fresh folder below the shared one."""
    path = f"{shared_dir(spark)}/shoplens-{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Removes the folders that this process has named, once the results read from them are written; how many there were."""
    removed = 0
    while _made:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        removed += bool(folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True))
    return removed


def written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage."""
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
