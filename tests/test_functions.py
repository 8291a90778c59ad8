"""Column functions on the cases the reference does not test (FIXTURES.md §2)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimsflow.functions import money, periods, text
from claimsflow.operators.reconcile import lsn_value
from claimsflow.sinks.export import csv_field


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("p,expected", [
    ("2025-04", dt.date(2025, 4, 1)), ("apr-2025", dt.date(2025, 4, 1)), ("APR-2025", dt.date(2025, 4, 1)),
    ("2025-04-15", None), ("", None), ("2025-13", None), ("APR-2025\n", None), ("UNKNOWN", None),
])
def test_month_start_strict(spark, p, expected):
    assert one(spark, periods.month_start_strict, p) == expected


@pytest.mark.parametrize("p,expected", [
    ("2025-04-15", dt.date(2025, 4, 15)), ("2025-04", dt.date(2025, 4, 1)), ("sep-2025", dt.date(2025, 9, 1)),
    ("", None), ("2025-04-15\n", None),
])
def test_period_date_wide(spark, p, expected):
    assert one(spark, periods.period_date_wide, p) == expected


def test_bad_period_fails_like_the_database_unless_lenient(spark):
    with pytest.raises(Exception):
        one(spark, periods.period_date_wide, "2025-13")
    with pytest.raises(Exception):
        one(spark, periods.month_start_strict, "XYZ-2025")
    assert one(spark, lambda c: periods.period_date_wide(c, "null"), "2025-13") is None
    assert one(spark, lambda c: periods.month_start_strict(c, "null"), "XYZ-2025") is None


def test_mon_yyyy_and_sort_key(spark):
    assert one(spark, periods.mon_yyyy, dt.date(2025, 9, 1), "v date") == "SEP-2025"
    assert one(spark, periods.yyyymm_key, "APR-2025") == "202504"
    assert one(spark, periods.yyyymm_key, "") is None


@pytest.mark.parametrize("p,month,year", [("APR-2025", 4, 2025), ("2025-04", 99, -4), ("xyz-2025", 99, 2025)])
def test_month_and_year_order(spark, p, month, year):
    assert one(spark, periods.month_order, p) == month
    assert one(spark, periods.year_order, p) == year


def test_year_order_day_form_fails_unless_lenient(spark):
    with pytest.raises(Exception):
        one(spark, periods.year_order, "2025-04-01")
    assert one(spark, lambda c: periods.year_order(c, "null"), "2025-04-01") is None


@pytest.mark.parametrize("v,expected", [
    ("2.345", "2.35"), ("-2.345", "-2.35"), ("2.344", "2.34"), ("1000", "1000.00"), ("NaN", ""),
    ("Infinity", ""), (" 5", "5.00"), ("+1.5", "1.50"), (None, ""),
])
def test_guarded_money(spark, v, expected):
    assert one(spark, money.guarded_money, v) == expected


def test_vat_text(spark):
    df = spark.createDataFrame([("100.00", "20"), ("10.05", "17.5"), ("5", None), (None, "20")],
                               "a string, r string")
    got = [r[0] for r in df.select(money.vat_text(F.col("a"), F.col("r"))).collect()]
    assert got == ["20.00", "1.76", "", ""]


def test_nil_override_and_cell_text(spark):
    df = spark.createDataFrame([(True, "5.555"), (None, "5.555"), (False, None)], "nil boolean, t string")
    got = [str(r[0]) for r in df.select(money.month_total(F.col("nil"), money.num(F.col("t")))).collect()]
    assert got == ["0.00", "5.56", "0.00"]
    assert one(spark, lambda c: money.cell_text(money.num(c)), None) == ""


def test_cell_overflow_is_an_error(spark):
    with pytest.raises(Exception):
        one(spark, lambda c: money.cell_text(c.cast("decimal(20,2)")), "12345678901.00")


@pytest.mark.parametrize("v,expected", [
    ("x" * 24, "x" * 24), ("x" * 25, '"' + "x" * 25 + '"'), ("a,b", '"a,b"'), ('say "hi"', '"say ""hi"""'),
    ("a+b", '"a+b"'), ("a\nb", '"a\nb"'), ("APR-2025", "APR-2025"), ("01/04/2025", "01/04/2025"),
    ("", ""), (None, ""),
])
def test_csv_quoting(spark, v, expected):
    assert one(spark, csv_field, v) == expected


def test_lsn_order_is_numeric(spark):
    df = spark.createDataFrame([("1/0",), ("0/FF",), ("0/16B6C40",)], "l string")
    got = [int(r[0]) for r in df.select(lsn_value(F.col("l"))).collect()]
    assert got == [1 << 32, 255, 0x16B6C40]


def test_flags_and_text(spark):
    df = spark.createDataFrame([("VOID", None, "ECF1"), (None, "x", ""), ("R", None, None)],
                               "s string, m string, e string")
    got = df.select(text.yn_equals(F.col("s"), "VOID"), text.yn_present(F.col("m")),
                    text.yn_nonblank(F.col("e"))).collect()
    assert [tuple(r) for r in got] == [("Y", "N", "Y"), ("N", "Y", "N"), ("N", "N", "N")]
    assert one(spark, text.left4, "MT001") == "MT00" and one(spark, text.right4, "MT001") == "T001"
    assert one(spark, text.canonical_area, "crime lower") == "CRIME"
    assert one(spark, text.canonical_area, "Legal Help") == "CIVIL"
    assert one(spark, text.canonical_area, "mediation") == "MEDIATION"
    assert one(spark, lambda c: text.rowkey_part(text.pack_rowkey(F.lit("CIVIL"), c), 2), "OA|1") == "OA"


def test_london_date_of_a_late_summer_upload(spark):
    ts = dt.datetime(2025, 6, 30, 23, 30)
    assert one(spark, text.dmy_local, ts, "v timestamp") == "01/07/2025"
    assert one(spark, text.dmy, ts, "v timestamp") == "30/06/2025"


def test_retention_boundary(spark):
    from claimsflow.plans.combined import within_years
    df = spark.createDataFrame([(dt.datetime(2022, 11, 3, 0, 0, 0),), (dt.datetime(2022, 11, 2, 23, 59, 59),)],
                               "created_on timestamp")
    kept = within_years(df, "created_on", "2025-11-03").collect()
    assert [r[0] for r in kept] == [dt.datetime(2022, 11, 3)]
