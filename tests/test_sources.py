"""Sources: the fixed-schema snapshot reader and the JDBC query text."""

import pytest

from claimsflow.schemas import SCHEMAS
from claimsflow.sources import jdbc, snapshot
from tests.fixture import tables as fixture_tables


def test_jdbc_select_keeps_numeric_text_and_splits_by_key_hash():
    sel = jdbc.select_list("calculated_fee_detail")
    assert '"total_amount"::text AS "total_amount"' in sel
    assert '"created_on"' in sel and '"created_on"::text' not in sel
    preds = jdbc.predicates("replication_summary", 4)
    assert len(preds) == 4 and all("hashtext" in p for p in preds)
    assert preds[3].endswith("= 3") and '"table_name"::text' in preds[0] and '"summary_date"::text' in preds[0]


def test_snapshot_roundtrip_and_schema_guard(spark, out_dir):
    t = fixture_tables(spark)
    snapshot.write_snapshot(t, out_dir)
    back = snapshot.read_tables(spark, out_dir)
    # file sources read every column as nullable; NOT NULL is checked by DQ-3
    assert all([(f.name, f.dataType) for f in back[n].schema] ==
               [(f.name, f.dataType) for f in SCHEMAS[n]] for n in back)
    summary = {r["table_name"]: (r["row_count"], r["column_count"])
               for r in snapshot.ingest_summary(back).collect()}
    assert summary["calculated_fee_detail"] == (4, 40) and summary["submission"] == (3, 18)
    t["claim"].drop("version").write.mode("overwrite").parquet(f"{out_dir}/claim")
    with pytest.raises(snapshot.SchemaMismatch):
        snapshot.read_table(spark, out_dir, "claim")


def test_nightly_command_on_a_snapshot(spark, out_dir):
    import datetime as dt

    from claimsflow.__main__ import main
    from tests.fixture import AS_OF, T
    t = fixture_tables(spark)
    snapshot.write_snapshot(t, f"{out_dir}/replica")
    day = AS_OF - dt.timedelta(days=1)
    rows = [(f"claims.{n}", day, r, u, "0/16B6C40", T) for n, (r, u) in {
        "claim": (2, 1), "client": (2, 1), "claim_summary_fee": (2, 2), "submission": (0, 0),
        "bulk_submission": (0, 0), "claim_case": (2, 0), "calculated_fee_detail": (4, 0)}.items()]
    spark.createDataFrame(rows, SCHEMAS["replication_summary"]).write.parquet(
        f"{out_dir}/replica/replication_summary")
    code = main(["--snapshot", f"{out_dir}/replica", "--out", f"{out_dir}/out", "--as-of", AS_OF.isoformat(),
                 "--current-lsn", "0/16B6C50", "--single-file"])
    assert code == 0
    with open(f"{out_dir}/out/reports/report_013.csv", encoding="utf-8") as f:
        assert f.read().splitlines()[2] == "OA001,CRIME,8000.00,0.00"
    bad = main(["--snapshot", f"{out_dir}/replica", "--out", f"{out_dir}/out2", "--as-of", AS_OF.isoformat(),
                "--current-lsn", "0/1"])
    assert bad == 2


def test_tune_for_input_sizes_partitions_and_keeps_fixed_settings(spark):
    from claimsflow.session import tune_for_input
    keys = ["spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")  # fixed by the deployment
        applied = tune_for_input(spark, 100 * 1024 ** 4)
        assert applied["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == str(800 * 1024)
        assert "spark.sql.files.maxPartitionBytes" not in applied
        assert tune_for_input(spark, 1) == {}  # already set now: left alone
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        assert tune_for_input(spark, 1)["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "200"
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
