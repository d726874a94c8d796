"""The raw file of ``rejected_records`` is written by many tasks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loanloom.plans import queries
from loanloom.sources import raw_loans


def _lines(n):
    def build(spark, d):
        fields = {c: F.lit("1") for c in raw_loans.RAW_COLUMNS}
        return spark.range(0, n, 1, 6).select(F.col("id").alias("loan_id"), *[v.alias(c) for c, v in fields.items()])

    return build


@pytest.mark.parametrize("n", [0, 1, 6000])
def test_the_raw_file_is_written_by_many_tasks_with_a_header_each(spark, tmp_path, n):
    lines = _lines(n)(spark, "").select(F.concat_ws(",", *raw_loans.RAW_COLUMNS).alias("value"))
    queries._with_headers(lines, ",".join(raw_loans.RAW_COLUMNS)).write.text(str(tmp_path / "loan.csv"))
    files = [f.read_text().splitlines() for f in (tmp_path / "loan.csv").glob("part-*") if f.stat().st_size]
    header = ",".join(raw_loans.RAW_COLUMNS)
    assert all(f[0] == header and header not in f[1:] for f in files)
    assert len(files) == min(n, 6) + 1 and sum(len(f) - 1 for f in files) == n
    good, rejects = raw_loans.read_checked_loans(spark, str(tmp_path / "loan.csv"))
    assert (good.count(), rejects.count()) == (n, 0)


def test_rejected_records_sort_no_rows_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(queries.sample_book, "raw_file_rows", _lines(300))
    got = {r.reason: r.n_records for r in queries.QUERIES["rejected_records"](spark, "").collect()}
    kinds = [next((k for m, k in ((97, "short"), (89, "quote"), (83, "number"), (79, "rate")) if i % m == 0), "good") for i in range(300)]
    malformed = kinds.count("short") + kinds.count("quote")
    assert got == {"none": kinds.count("good"), "malformed record": malformed, "annual_inc: no number": kinds.count("number"), "int_rate: no number": kinds.count("rate")}
