"""An index from integer keys to the files that hold them, as bitmaps.

Keys are cut into ranges of 32,768; for each file and range that the file has keys of, the index holds one row
with a bitmap. A look-up reads the rows of one range and opens the files whose bit is set: none for an absent key, one
for a unique key. The bitmaps are an aggregate with partial sums; dense ids take about a bit each.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INDEX = "_key_index"


def build_key_index(spark: SparkSession, path: str, key: str, schema: T.StructType) -> None:
    """Write the index of the Parquet table at ``path`` into its hidden folder ``_key_index``.

    Null keys are in no bitmap; a table without files gets an empty index.
    """
    rows = spark.read.schema(schema).parquet(path)
    bit = F.bitmap_bit_position(F.col(key))
    index = (
        rows.filter(F.col(key).isNotNull())
        .groupBy(F.bitmap_bucket_number(F.col(key)).alias("bucket"), F.col("_metadata.file_path").alias("file"))
        .agg(F.bitmap_construct_agg(bit).alias("bits"))
    )
    ordered = index.repartitionByRange("bucket").sortWithinPartitions("bucket")
    ordered.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{INDEX}")


def _place(value: int) -> tuple[int, int]:
    """Range and bit of a key, as the bitmap functions count them."""
    return (1 + (value - 1) // 32768, (value - 1) % 32768) if value > 0 else (-(-value // 32768), -value % 32768)


def files_with(spark: SparkSession, path: str, value: int) -> list[str]:
    """The files that hold a key, by the index alone."""
    bucket, bit = _place(value)
    byte = F.conv(F.hex(F.substring("bits", bit // 8 + 1, 1)), 16, 10).cast("int")
    index = spark.read.parquet(f"{path.rstrip('/')}/{INDEX}").filter(F.col("bucket") == bucket)
    found = index.filter(F.getbit(byte, F.lit(bit % 8)) == 1).select("file").collect()
    return [unquote(r.file) for r in found]


def indexed_lookup(spark: SparkSession, path: str, key: str, value: int, schema: T.StructType) -> DataFrame:
    """The rows of one key, from the files that the index names; partition columns of the table are left out."""
    files = files_with(spark, path, value)
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*files)
    return rows.filter(F.col(key) == F.lit(value)).select(*[f.name for f in schema.fields])
