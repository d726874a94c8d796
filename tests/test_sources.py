"""Versioned tables, the key index, rejected records and ids that go on over loads."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.operators.quality import audit_keys
from loanloom.plans import jobs
from loanloom.schemas import TABLES
from loanloom.sources import key_index, raw_loans, versions
from loanloom.sources.tables import read_table

SCHEMA = T.StructType(
    [T.StructField("version", T.StringType()), T.StructField("part", T.StringType()), T.StructField("v", T.LongType())]
)


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def _read(spark, path, **how):
    return sorted(map(tuple, versions.read_keyed(spark, path, SCHEMA, **how).collect()), key=repr)


def test_upserts_replace_whole_keys_and_keep_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    assert _read(spark, path) == []
    versions.upsert(_rows(spark, ("007", "a", 1), ("007", "b", 2), ("8", "a", 3), (None, "x/y=z", 4)), path, ["version", "part"])
    versions.upsert(_rows(spark, ("007", "a", 10), ("007", "a", 11)), path, ["version", "part"])
    want = [("007", "a", 10), ("007", "a", 11), ("007", "b", 2), ("8", "a", 3), (None, "x/y=z", 4)]
    assert _read(spark, path) == sorted(want, key=repr)
    versions.upsert(_rows(spark).limit(0), path, ["version", "part"])
    assert len(_read(spark, path)) == 5
    # Nothing but live data is left, and a plain reader sees the same.
    assert spark.read.parquet(path).count() == 5


def test_a_job_that_dies_between_two_keys_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.upsert(_rows(spark, ("1", "a", 1), ("2", "a", 2)), path, ["version"])
    dies = F.when(F.col("version") == "2", F.raise_error(F.lit("dies"))).otherwise(F.lit(9)).cast("long")
    # One task per key, so that one key's file is written before the other's task fails.
    for k in range(2):
        with pytest.raises(PySparkException, match="dies"):
            versions.upsert(_rows(spark, ("1", "a", 5), ("2", "a", 6)).repartition(2, "version").withColumn("v", dies), path, ["version"])
        assert _read(spark, path) == [("1", "a", 1), ("2", "a", 2)]


def test_a_job_that_dies_after_writing_commits_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.upsert(_rows(spark, ("1", "a", 1), ("2", "a", 2)), path, ["version"])
    with monkeypatch.context() as m:
        m.setattr(versions.Log, "create", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            versions.upsert(_rows(spark, ("1", "a", 5), ("2", "a", 6)), path, ["version"])
    assert _read(spark, path) == [("1", "a", 1), ("2", "a", 2)]
    # A state whose writer died inside it is none; the next job goes on behind it and cleans up.
    (tmp_path / "t" / "_log" / f"{2:020d}.json").write_text('{"version=1": "comm')
    assert _read(spark, path) == [("1", "a", 1), ("2", "a", 2)]
    versions.upsert(_rows(spark, ("2", "a", 7)), path, ["version"])
    assert _read(spark, path) == [("1", "a", 1), ("2", "a", 7)]
    versions.vacuum(spark, path)  # a writer that is still at work looks alike
    assert spark.read.parquet(path).count() == 4
    versions.vacuum(spark, path, older_than_s=-1)
    assert spark.read.parquet(path).count() == 2 and len(_read(spark, path)) == 2


def test_writers_at_the_same_time_lose_nothing(spark, tmp_path, monkeypatch):
    path, create = str(tmp_path / "t"), versions.Log.create
    versions.upsert(_rows(spark, ("1", "a", 1)), path, ["version"])
    raced = []

    def late(self, number, state):
        if not raced:
            raced.append(number)
            versions.upsert(_rows(spark, ("2", "a", 2)), path, ["version"], keep=9)
        return create(self, number, state)

    monkeypatch.setattr(versions.Log, "create", late)
    versions.upsert(_rows(spark, ("3", "a", 3)), path, ["version"], keep=9)
    assert _read(spark, path) == [("1", "a", 1), ("2", "a", 2), ("3", "a", 3)]
    assert not versions.Log(spark, path).create(1, {}) and _read(spark, path, version=1) == [("1", "a", 1)]


def test_key_index_opens_the_file_of_a_key_and_no_other(spark, tmp_path):
    path, ids = str(tmp_path / "with space"), [0, 1, 2, -1, -32768, -32769, 32768, 32769, 65536, 65537, 10**12, None]
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])
    rows = [(i, n) for n, i in enumerate(ids)] + [(7 * i, 100) for i in range(100, 4000)]
    spark.createDataFrame(rows, schema).repartition(6, F.xxhash64("v", "k")).write.parquet(path)
    key_index.build_key_index(spark, path, "k", schema)
    for n, i in enumerate(ids[:-1]):
        assert len(key_index.files_with(spark, path, i)) == 1
        assert [tuple(r) for r in key_index.indexed_lookup(spark, path, "k", i, schema).collect()] == [(i, n)]
    for i in (3, -2, 701, 98_304, 10**12 + 1, -(10**9)):
        assert key_index.files_with(spark, path, i) == [] and key_index.indexed_lookup(spark, path, "k", i, schema).count() == 0


def _file(tmp_path, name, lines):
    (tmp_path / name).write_text("\n".join([",".join(raw_loans.RAW_COLUMNS), *lines]) + "\n")
    return str(tmp_path / name)


def _line(**fields):
    good = dict(zip(raw_loans.RAW_COLUMNS, "50000,3 years,CA,12.5,RENT,1000,13.5%, 36 months,A,A1,car,Mar-2015,Default,1,NA,2,,0".split(",")))
    return ",".join((good | fields).values())


def test_every_broken_record_is_rejected_once(spark, tmp_path):
    lines = [_line(), _line(annual_inc="n/a", issue_d="soon"), _line(annual_inc="fifty"), "1,2,3", _line(purpose='"car'), _line() + ",extra"]
    lines += [_line(int_rate="high", term="long"), _line(dti=" NaN "), _line(purpose='"a ""quoted"", text"')]
    good, rejects = raw_loans.read_checked_loans(spark, _file(tmp_path, "loan.csv", lines))
    assert good.count() == 4 and rejects.count() == len(lines) - 4
    found = {r.record: list(r.reasons) for r in rejects.collect()}
    assert found["1,2,3"] == ["malformed record"] and found[_line(purpose='"car')] == ["malformed record"]
    assert sorted(map(tuple, found.values())) == [
        ("annual_inc: no number",), ("int_rate: no number", "term: no number"),
        ("malformed record",), ("malformed record",), ("malformed record",),
    ]
    assert {r.purpose for r in good.select("purpose").collect()} == {"car", 'a "quoted", text'}
    assert all(r.file.endswith("loan.csv") for r in rejects.collect())


def test_loads_continue_ids_and_may_come_again(spark, tmp_path):
    parts = {name: [_line(loan_amnt=str(1000 * k + i)) for i in range(n)] for k, (name, n) in enumerate((("a", 7), ("b", 5), ("c", 0)))}
    parts["b"] += [_line(loan_status="Current"), "broken"]
    whole = str(tmp_path / "w")
    for name in ("a", "b", "c"):
        counts = jobs.append_load(spark, _file(tmp_path, f"{name}.csv", parts[name]), whole, name)
    assert counts == {"n_read": 0, "n_rejected": 0, "n_records": 0, "n_loans": 0, "first_id": 13}
    again = jobs.append_load(spark, str(tmp_path / "b.csv"), whole, "b")
    assert again == {"n_read": 6, "n_rejected": 1, "n_records": 7, "n_loans": 5, "first_id": 8}
    customers, loans, repayments = (read_table(spark, f"{whole}/{n}", TABLES[n]) for n in ("customers", "loans", "repayments"))
    for df, key in ((loans, "loan_id"), (customers, "customer_id"), (repayments, "loan_id")):
        assert sorted(r[0] for r in df.select(key).collect()) == list(range(1, 13))
    assert audit_keys(loans, customers, "customer_id").count() == audit_keys(repayments, loans, "loan_id").count() == 0
    assert sorted(int(r[0]) for r in loans.select("loan_amount").collect()) == [*range(7), *range(1000, 1005)]
    with pytest.raises(ValueError, match="had 5 rows"):
        versions.claim_ids(spark, f"{whole}/loads", "b", 6)
