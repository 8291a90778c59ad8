"""Property tests: Spark column functions against brute-force Python on
random inputs (one Spark job per property, all examples in one frame)."""

from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimsflow.functions import money, periods
from claimsflow.operators.reconcile import lsn_value
from claimsflow.sinks.export import csv_field

SETTINGS = settings(max_examples=3, deadline=None, phases=[Phase.generate])


def spark_map(spark, fn, values, ddl="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {ddl}")
    return [r[1] for r in df.select("i", fn(F.col("v"))).orderBy("i").collect()]


def py_csv(v):
    if v is None or v == "":
        return ""
    if len(v) > 24 or any(ord(c) < 0x2D for c in v):
        return '"' + v.replace('"', '""') + '"'
    return v


texts = st.lists(st.one_of(st.none(), st.text(alphabet=st.characters(min_codepoint=9, max_codepoint=0x7E),
                                              max_size=40)), min_size=200, max_size=200)


@SETTINGS
@given(values=texts)
def test_csv_field_matches_rule(spark, values):
    assert spark_map(spark, csv_field, values) == [py_csv(v) for v in values]


lsns = st.lists(st.tuples(st.integers(0, 0xFFFFFFFF), st.integers(0, 0xFFFFFFFF)), min_size=200, max_size=200)


@SETTINGS
@given(pairs=lsns)
def test_lsn_value_is_the_64_bit_position(spark, pairs):
    text = [f"{hi:X}/{lo:X}" for hi, lo in pairs]
    assert [int(x) for x in spark_map(spark, lsn_value, text)] == [(hi << 32) + lo for hi, lo in pairs]


amounts = st.lists(st.one_of(
    st.decimals(min_value=-10 ** 9, max_value=10 ** 9, places=4, allow_nan=False).map(str),
    st.sampled_from(["NaN", "Infinity", "-Infinity", "", "1e5", " 7", "+3.25", "1.", ".5"])),
    min_size=200, max_size=200)


def py_guard(v):
    import re
    if v is None or not re.fullmatch(r"[\s+-]?\d+(\.\d+)?", v):
        return ""
    try:
        q = Decimal(v.strip()).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    except InvalidOperation:
        return ""
    # PostgreSQL numeric has no negative zero: ROUND(-0.001, 2) prints 0.00
    return str(abs(q) if q == 0 else q)


@SETTINGS
@given(values=amounts)
def test_guarded_money_matches_half_up(spark, values):
    assert spark_map(spark, money.guarded_money, values) == [py_guard(v) for v in values]


MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]
period_texts = st.lists(st.one_of(
    st.tuples(st.sampled_from(MONTHS + ["XYZ", "Jan", "dec"]), st.integers(1990, 2030)).map(
        lambda t: f"{t[0]}-{t[1]}"),
    st.tuples(st.integers(1990, 2030), st.integers(1, 12)).map(lambda t: f"{t[0]}-{t[1]:02d}")),
    min_size=200, max_size=200)


def py_month_order(p):
    head = p[:3].upper()
    return MONTHS.index(head) + 1 if head in MONTHS else 99


@SETTINGS
@given(values=period_texts)
def test_period_sort_keys(spark, values):
    assert spark_map(spark, periods.month_order, values) == [py_month_order(p) for p in values]
    assert spark_map(spark, periods.year_order, values) == [int(p[4:]) for p in values]
