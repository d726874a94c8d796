"""Table, macro-series and scenario readers."""

from __future__ import annotations

import time
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Scenario(NamedTuple):
    scenario: str
    delta_pp: float
    source: str


# Published unemployment moves, in percentage points, and where they come from.
SCENARIOS = [
    Scenario("baseline", 0.2, "Fed 2025 baseline scenario: unemployment to 4.3% (Q1 2025) vs ~4.1% prevailing"),
    Scenario(
        "adverse", 3.1, "Fed 2019 adverse scenario (last year published separately): peaks at 7% vs ~3.9% start"
    ),
    Scenario("severely_adverse", 5.9, "Fed 2025 severely adverse scenario: +5.9pp to a peak of 10%"),
]


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table; a given schema fixes types and adds columns older files lack."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_macro(spark: SparkSession, path: str, value_col: str = "UNRATE") -> DataFrame:
    """``observation_date, value`` from a headed two-column CSV."""
    layout = T.StructType(
        [T.StructField("observation_date", T.DateType()), T.StructField(value_col, T.DoubleType())]
    )
    return (
        spark.read.schema(layout)
        .option("header", True)
        .csv(path)
        .select("observation_date", F.col(value_col).alias("value"))
    )


def scenarios(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SCENARIOS, "scenario string, delta_pp double, source string")


class TableCache:
    """Persisted table reads that are refreshed after ``ttl_seconds``."""

    def __init__(self, spark: SparkSession, ttl_seconds: float = 300.0):
        self._spark, self._ttl = spark, ttl_seconds
        self._held: dict[str, tuple[float, DataFrame]] = {}

    def read(self, path: str) -> DataFrame:
        held = self._held.get(path)
        if held is not None and time.monotonic() - held[0] < self._ttl:
            return held[1]
        self.release(path)
        df = read_table(self._spark, path).persist()
        self._held[path] = (time.monotonic(), df)
        return df

    def release(self, path: str) -> None:
        held = self._held.pop(path, None)
        if held is not None:
            held[1].unpersist()
