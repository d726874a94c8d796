"""Intermediate tables in the storage all executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="loanloom-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables, below the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    return f"{_own_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/loanloom/{spark.sparkContext.applicationId}"


def materialise(df: DataFrame) -> DataFrame:
    """Write an aggregate to the shared folder and read it back.

    The result is a table scan: the planner knows its true size, so joins to it
    broadcast below ``spark.sql.autoBroadcastJoinThreshold`` and shuffle
    otherwise; it is computed once, and a lost executor loses nothing of it.
    """
    path = shared_folder(df.sparkSession, "aggregate")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _own_folders(df: DataFrame) -> list[str]:
    own = f"/loanloom/{df.sparkSession.sparkContext.applicationId}/"
    return sorted({folder for name in df.inputFiles() if own in (folder := name.rpartition("/")[0])})


def _filesystem(spark: SparkSession, folder: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def delete_folder(spark: SparkSession, folder: str) -> None:
    files, where = _filesystem(spark, folder)
    files.delete(where, True)


def will_broadcast(df: DataFrame) -> bool:
    """Whether a table that ``materialise`` has written is small enough for Spark to broadcast it by itself."""
    spark, size = df.sparkSession, 0
    for folder in _own_folders(df):
        files, where = _filesystem(spark, folder)
        size += files.getContentSummary(where).getLength()
    return size <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def release(df: DataFrame) -> None:
    """Delete what ``materialise`` has written for ``df``, once nothing reads it any more; other tables stay."""
    for folder in _own_folders(df):
        delete_folder(df.sparkSession, folder)
