"""Key bitmap, retention by folders, and amounts of many decimal places."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimsflow import catalog
from claimsflow.functions import money
from claimsflow.operators import key_filter
from claimsflow.plans import combined
from claimsflow.sources import retention, snapshot, testbed

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(str, df.collect()))


def test_bitmap_keeps_every_row_of_the_keys(spark):
    df = spark.range(50_000).select(F.concat(F.lit("k"), "id").alias("claim_id"), "id")
    df = df.unionByName(spark.createDataFrame([(None, -1)], "claim_id string, id long"))
    keys = df.where("id % 50 = 0 OR id < 0").select("claim_id")
    found = key_filter.blocks(keys, "claim_id", 1001)
    left = {r.id for r in key_filter.cut_to(df, "claim_id", found).collect()}
    assert left >= set(range(0, 50_000, 50)) and len(left) < 6000 and -1 not in left
    assert key_filter.cut_to(df, "claim_id", found).columns == df.columns
    none = key_filter.blocks(keys.limit(0), "claim_id", 0)
    assert key_filter.cut_to(df, "claim_id", none).count() == 0
    # too many keys for the largest bitmap: no filter, all rows
    assert key_filter.blocks(keys, "claim_id", key_filter.MOST_BITS + 1) is None
    assert key_filter.cut_to(df, "claim_id", None).count() == 50_001
    assert key_filter.bits_for(10**12) == key_filter.MOST_BITS and key_filter.bits_for(0) == 1 << 15


def test_reduced_extract_has_the_same_rows_and_moves_fewer(spark):
    t = catalog.tables(spark, SF)
    cut, whole = (combined.combined_extract(t, testbed.AS_OF, reduce=r) for r in (True, False))
    assert _rows(cut) == _rows(whole) and cut.count() > 100
    kept = key_filter.blocks(combined.surviving_claims(t, testbed.AS_OF), "claim_id", t["claim"].count())
    fee = t["calculated_fee_detail"]
    moved = key_filter.cut_to(fee, "claim_id", kept).count()
    least = fee.join(combined.surviving_claims(t, testbed.AS_OF), "claim_id", "left_semi").count()
    assert least <= moved < 1.2 * least < 0.7 * fee.count()
    # the cut is below the exchange of the fee window
    plan = cut._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("Window [") < plan.index("_block#", plan.index("Window [")) and "Python" not in plan


def test_months_outside_the_window_are_not_read(spark, out_dir):
    t = catalog.tables(spark, SF)
    retention.write(t, out_dir)
    by_month = snapshot.read_tables(spark, out_dir)
    assert all(retention.UPLOAD_MONTH in df.columns for df in by_month.values())
    for n, df in by_month.items():  # a plain read has all rows
        assert _rows(df.drop(retention.UPLOAD_MONTH)) == _rows(t[n])
    got = combined.combined_extract(by_month, testbed.AS_OF)
    assert _rows(got) == _rows(combined.combined_extract(t, testbed.AS_OF))
    for n, df in retention.window(by_month, testbed.AS_OF, combined.RETENTION_YEARS).items():
        files = {r[0] for r in df.select(F.input_file_name()).distinct().collect()}
        months = {f.split(f"{retention.UPLOAD_MONTH}=")[1].split("/")[0] for f in files}
        assert min(months) == "1997-05" and len(files) < len(by_month[n].inputFiles())
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(upload_month") >= 7  # the folders are left out of each scan


def test_rows_without_a_parent_and_the_edges_of_the_window(spark, out_dir):
    from tests import fixture
    t = fixture.tables(spark)
    t = {**t, "claim": t["claim"].unionByName(t["claim"].limit(1).withColumns({"id": F.lit("orphan"), "submission_id": F.lit("gone")}))}
    retention.write({n: t[n] for n in snapshot.REPORT_TABLES}, out_dir)
    back = snapshot.read_tables(spark, out_dir)
    assert back["claim"].where("id = 'orphan' AND upload_month IS NULL").count() == 1
    for as_of in ("2025-11-03", "2028-02-29", "2028-11-03", "2030-01-01"):
        a, b = (combined.combined_extract(x, as_of) for x in (back, t))
        assert _rows(a) == _rows(b)
    day = retention.window(back, dt.date(2028, 2, 29), 3)
    assert set(day) == set(back)


@pytest.mark.parametrize(("text", "want"), [("0.0049999999999999999999", "0.00"), ("-0.0049999999999999999999", "0.00"),
                                            ("0.00500000000000000000001", "0.01"), ("1.9949999999999999999999999", "1.99"),
                                            ("-2.0050000000000000000000", "-2.01")])
def test_rounding_of_many_places_is_postgresqls(spark, text, want):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(money.guarded_money(F.col("x")).alias("y")).first().y == want


def test_sums_refuse_digits_they_would_lose(spark):
    df = spark.createDataFrame([("0.1234567890123456789",)], "x string")
    with pytest.raises(Exception, match="18 decimal places"):
        df.select(F.sum(money.num(F.col("x")))).collect()
    ok = spark.createDataFrame([("1.1000000000000000000000",), (None,)], "x string")
    assert str(ok.select(F.sum(money.num(F.col("x"))).alias("y")).first().y).startswith("1.1000")
