"""Look-ups of many rows in a table with one row per key, whatever share of the rows a key holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.functions.ordered import null_safe_join

#: Pieces that a partition's worth of rows is cut into, when a key with more rows than that is salted.
PIECES = 8
_SALT = "__salt"


def hot_keys(counts: DataFrame, keys: Sequence[str], n_rows: Column, rows: str = "n") -> Column | None:
    """The number of salts of a row's key, from stored counts per key; None if no key needs any.

    Hot is a key with more than a partition's share of all ``n_rows`` rows. There are fewer of them than shuffle
    partitions, whatever the data, so they travel as a literal map.
    """
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = n_rows / partitions
    salts = F.ceil(F.col(rows) * PIECES / share).cast("int").alias("__salts")
    found = counts.filter(F.col(rows) > share).select(*keys, salts).collect()
    if not found:
        return None
    types = [counts.schema[k].dataType for k in keys]
    entries = [
        x for r in found for x in (F.struct(*[F.lit(v).cast(t).alias(k) for k, v, t in zip(keys, r, types)]), F.lit(r[-1]))
    ]
    return F.coalesce(F.try_element_at(F.create_map(*entries), F.struct(*keys)), F.lit(1))


def salted_lookup(rows: DataFrame, small: DataFrame, keys: Sequence[str], salts: Column | None) -> DataFrame:
    """Left join of ``rows`` with ``small`` (unique per key; NULL keys match) that deals out hot keys by itself.

    ``salts`` is what ``hot_keys`` gives for the counts of ``rows``. A hot key's rows get one of its salts by
    their content, its row in ``small`` is copied to all of them; the other keys stay as they are. No key then makes a
    task much longer than the others, with or without adaptive execution.
    """
    if salts is None:
        return null_safe_join(rows, small, keys, "left")
    dealt = rows.withColumn(_SALT, F.pmod(F.xxhash64(*rows.columns), salts).cast("int"))
    copied = small.withColumn(_SALT, F.explode(F.sequence(F.lit(0), salts - 1)))
    return null_safe_join(dealt, copied, [*keys, _SALT], "left").drop(_SALT)
