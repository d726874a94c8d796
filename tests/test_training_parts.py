"""The rows that a model is trained on lie in equal parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanloom.operators.model import TASK_ROWS, _spread
from test_model import _rows


def test_training_rows_lie_in_equal_parts(spark):
    rows = _rows(spark, 4 * TASK_ROWS).coalesce(1)
    sizes = _spread(rows).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 1.1 * TASK_ROWS
    assert _spread(_rows(spark, 50)).rdd.getNumPartitions() == 1 and _spread(rows.filter("false")).count() == 0
