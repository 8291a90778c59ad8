"""Money that is exact or loud, reconciliation that counts every summary, and
stores that survive a cut-off switch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimsflow.functions import money
from claimsflow.operators import reconcile, submissions
from claimsflow.sinks import export, store


def _one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


@pytest.mark.parametrize("text, out", [("1.0049996", "1.00"), ("0.0049999", "0.00"), ("0.005", "0.01"),
                                       ("12345678901234567.00", "12345678901234567.00"), (None, None)])
def test_money_is_rounded_once_and_kept(spark, text, out):
    assert _one(spark, text, lambda c: money.money2(money.num(c)).cast("string")) == out


@pytest.mark.parametrize("text", ["NaN", "ten", "123456789012345678901.5"])
def test_unreadable_money_raises(spark, text):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|NUMERIC_VALUE_OUT_OF_RANGE|NUMERIC_OUT"):
        _one(spark, text, lambda c: money.num(c).cast("string"))


def test_vat_is_exact_or_raises(spark):
    rows = [("100.00", "17.5"), ("33.33", "20"), ("12345678901234567.00", "20"), (None, "20"), ("1", None)]
    got = [r[0] for r in spark.createDataFrame(rows, "a string, r string").select(money.vat_text(F.col("a"), F.col("r"))).collect()]
    assert got == ["17.50", "6.67", "2469135780246913.40", "", ""]
    with pytest.raises(Exception, match="not exact"):
        spark.createDataFrame([("1.123456789", "20")], "a string, r string").select(money.vat_text(F.col("a"), F.col("r"))).collect()


def test_summary_of_an_uncounted_table_fails(spark):
    as_of = dt.date(2024, 1, 2)
    stamp = dt.datetime(2024, 1, 1, 12)
    claim = spark.createDataFrame([(stamp, None)], "created_on timestamp, updated_on timestamp")
    day, _, _ = reconcile.day_bounds(as_of)
    rows = [("claims.claim", day, 1, 0, "0/1"), ("claims.matter_start", day, 999, 0, "0/1")]
    summary = spark.createDataFrame(rows, "table_name string, summary_date date, record_count long, updated_count long, wal_lsn string")
    found = {r.table_name: r for r in reconcile.counts({"claim": claim}, summary, as_of).collect()}
    assert found["claims.claim"].ok
    assert found["claims.matter_start"].ok is False and found["claims.matter_start"].message == reconcile.NOT_COUNTED


def test_valid_counts_counts_before_the_semi_join(spark):
    claim = spark.createDataFrame([("a", "VALID"), ("a", "BAD"), ("b", "VALID")], "submission_id string, status string")
    chosen = spark.createDataFrame([("a",)], "submission_id string")
    counted = submissions.valid_counts(claim, chosen)
    assert [tuple(r) for r in counted.collect()] == [("a", 1)]


def test_store_pointer_is_never_missing(spark, tmp_path):
    root = f"file://{tmp_path}"
    with pytest.raises(FileNotFoundError):
        store.current(spark, root, "R")
    for n in (1, 2, 3):
        store.refresh(spark, spark.range(n), root, "R")
        assert store.current(spark, root, "R").count() == n
    assert len(list((tmp_path / "R").glob("run-*"))) == 2 and len(list((tmp_path / "R").glob("_CURRENT.*"))) == 2
    for pointer in (tmp_path / "R").glob("_CURRENT.*"):
        pointer.rename(pointer.with_name("_lost" + pointer.suffix))
    with pytest.raises(OSError, match="no pointer"):
        store.current(spark, root, "R")


def test_part_files_sort_by_number():
    names = ["part-100000-x.txt", "part-20000-x.txt", "part-00003-x.txt"]
    assert sorted(names, key=export.part_number) == ["part-00003-x.txt", "part-20000-x.txt", "part-100000-x.txt"]


def test_field_length_counts_utf16_units(spark):
    text = "\U0001F600" * 13
    assert _one(spark, text, export.csv_field) == f'"{text}"'
    assert _one(spark, text[:12], export.csv_field) == text[:12]
    assert export.header_line([text]) == f'"{text}"'
