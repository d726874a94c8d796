"""What several of the training-data operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but space and the ASCII controls tab to carriage return.
SEPARATORS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body mentions it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text in order; null is the empty text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
