"""Report semantics the reference relies on but never tests."""

import datetime as dt

from pyspark.sql import functions as F

from claimsflow.operators import fees, quality, submissions
from claimsflow.plans import combined, monthly_matrix, original_values
from claimsflow.sinks import export, store
from claimsflow.streaming import changes
from tests.fixture import frame

T = dt.datetime(2025, 5, 1, 12, 0)


def sub(i, period="APR-2025", area="CIVIL", status="VALIDATION_SUCCEEDED", prev=None, nil=False,
        created=T, office="OA001"):
    return dict(id=i, bulk_submission_id="B1", office_account_number=office, submission_period=period,
                area_of_law=area, status=status, previous_submission_id=prev, is_nil_submission=nil,
                created_by_user_id="u", created_on=created, provider_user_id="p")


def claim(i, s, status="VALID", line=1):
    return dict(id=i, submission_id=s, status=status, line_number=line, matter_type_code="MT1",
                created_by_user_id="u", created_on=T, is_amended=False, has_assessment=False, version=0)


def fee(i, c, amount, updated=None, created=T):
    return dict(id=i, claim_summary_fee_id="X", claim_id=c, created_by_user_id="u", created_on=created,
                updated_on=updated, total_amount=amount)


def tables(spark, subs, claims, fee_rows, cases=None, clients=None, bulk_created=T):
    cases = cases if cases is not None else [dict(id=f"K{c['id']}", claim_id=c["id"], created_by_user_id="u",
                                                  created_on=T) for c in claims]
    return {
        "submission": frame(spark, "submission", subs),
        "bulk_submission": frame(spark, "bulk_submission", [dict(id="B1", status="X", created_by_user_id="u",
                                                                  created_on=bulk_created)]),
        "claim": frame(spark, "claim", claims),
        "calculated_fee_detail": frame(spark, "calculated_fee_detail", fee_rows),
        "claim_case": frame(spark, "claim_case", cases),
        "claim_summary_fee": frame(spark, "claim_summary_fee", []),
        "client": frame(spark, "client", clients or []),
    }


def test_failed_replacement_still_hides_original_and_nil_rules(spark):
    t = tables(spark,
               [sub("S1"), sub("S2", status="VALIDATION_FAILED", prev="S1"),
                sub("S3", period="MAY-2025", nil=True), sub("S4", period="JUN-2025", nil=None),
                sub("S5", area="crime lower"), sub("S6", area="OTHER")],
               [claim("C3", "S3"), claim("C4", "S4"), claim("C5", "S5", status="INVALID")],
               [fee("F3", "C3", "100"), fee("F4", "C4", "50.005"), fee("F5", "C5", "7")])
    cur = {r["id"]: r for r in submissions.current_submissions(t["submission"]).collect()}
    assert set(cur) == {"S3", "S4", "S5"}
    assert cur["S5"]["area_of_law"] == "CRIME"
    long = {r["id"]: str(r["month_total"]) for r in monthly_matrix.month_totals(t).collect()}
    assert long == {"S3": "0.00", "S4": "50.01", "S5": "0.00"}


def test_two_submissions_in_one_cell_newest_wins(spark):
    t = tables(spark, [sub("S1", created=T), sub("S2", created=T + dt.timedelta(hours=1))],
               [claim("C1", "S1"), claim("C2", "S2")], [fee("F1", "C1", "1"), fee("F2", "C2", "2")])
    m = monthly_matrix.monthly_matrix(t).collect()
    assert [(r[0], r[1], r[2]) for r in m] == [("OA001", "CIVIL", "2.00")]


def test_matrix_columns_include_every_succeeded_period(spark):
    t = tables(spark, [sub("S1", period="MAY-2025"), sub("S2", period="APR-2025", area="OTHER"),
                       sub("S3", period="MAR-2024", prev=None, status="VALIDATION_FAILED")],
               [], [])
    m = monthly_matrix.monthly_matrix(t)
    assert m.columns == ["Provider Office Account Number", "Area of Law", "APR-2025", "MAY-2025"]
    assert [tuple(r) for r in m.collect()] == [("OA001", "CIVIL", "", "0.00")]


def test_empty_matrix_is_an_empty_report(spark, out_dir):
    t = tables(spark, [sub("S1", status="VALIDATION_FAILED")], [], [])
    m = monthly_matrix.monthly_matrix(t)
    assert m.count() == 0
    info = export.publish(spark, m, out_dir, "report_013.csv", monthly_matrix.sort_keys(m))
    assert info["rows"] == 0 and info["bytes"] == 0
    with open(f"{out_dir}/reports/report_013.csv", "rb") as f:
        assert f.read() == b""


def test_publish_rejects_non_csv_names(spark, out_dir):
    import pytest
    df = spark.createDataFrame([("a",)], "x string")
    with pytest.raises(ValueError):
        export.publish(spark, df, out_dir, "report.CSV", [])


def test_rep012_all_statuses_all_fees_and_day_periods(spark):
    t = tables(spark,
               [sub("S1", period="2025-04-15", area="CRIME LOWER"), sub("S2", period="2025-04", area="CRIME LOWER"),
                sub("S3", area="LEGAL HELP"), sub("S4", area="crime lower")],
               [claim("C1", "S1", status="INVALID"), claim("C2", "S2")],
               [fee("F1", "C1", "10.004"), fee("F1b", "C1", None), fee("F2", "C2", "2.5")])
    got = sorted(tuple(str(x) for x in r) for r in original_values.original_values(t).collect())
    # a kept day makes its own group, so APR-2025 prints twice
    assert got == [("OA001", "APR-2025", "CRIME LOWER", "10.00", "01/05/2025"),
                   ("OA001", "APR-2025", "CRIME LOWER", "2.50", "01/05/2025")]


def test_latest_fee_prefers_updated_on_and_breaks_ties_by_id(spark):
    rows = [fee("A", "C1", "1", updated=dt.datetime(2025, 4, 20), created=dt.datetime(2025, 10, 20)),
            fee("B", "C1", "2", updated=dt.datetime(2025, 4, 21), created=dt.datetime(2025, 10, 1)),
            fee("C", "C2", "3", created=dt.datetime(2025, 1, 1)),
            fee("D", "C2", "4", created=dt.datetime(2025, 1, 1))]
    df = frame(spark, "calculated_fee_detail", rows)
    got = {r["claim_id"]: r["id"] for r in fees.latest_fee(df).collect()}
    assert got == {"C1": "B", "C2": "D"}


def test_rep000_fanout_inner_case_and_sort(spark):
    claims = [claim("C2", "S1", line=2), claim("C10", "S1", line=10), claim("C3", "S1", line=3)]
    cases = [dict(id="K2", claim_id="C2", created_by_user_id="u", created_on=T),
             dict(id="K10", claim_id="C10", created_by_user_id="u", created_on=T)]
    clients = [dict(id=f"L{i}", claim_id="C2", client_forename=n, created_by_user_id="u", created_on=T)
               for i, n in enumerate(["A", "B"])]
    t = tables(spark, [sub("S1")], claims, [], cases=cases, clients=clients)
    rep = combined.combined_extract(t, "2025-11-03")
    rows = rep.orderBy(*combined.sort_keys(rep)).select("Claim ID", "Line Number", "Client Forename").collect()
    # no case row -> C3 dropped; two clients -> two rows (tied on every key);
    # text order puts 10 before 2
    assert [tuple(r)[:2] for r in rows] == [("C10", "10"), ("C2", "2"), ("C2", "2")]
    assert sorted(r[2] for r in rows[1:]) == ["A", "B"]


def test_rep000_retention_uses_as_of(spark):
    t = tables(spark, [sub("S1")], [claim("C1", "S1")], [], bulk_created=dt.datetime(2022, 11, 2, 23, 59, 59))
    assert combined.combined_extract(t, "2025-11-03").count() == 0
    assert combined.combined_extract(t, "2025-11-02").count() == 1


def test_store_switch_keeps_old_result_until_new_is_written(spark, out_dir):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([("p", "q")], "y string, `MAY-2025` string")
    store.refresh(spark, a, out_dir, "R")
    assert store.current(spark, out_dir, "R").columns == ["x"]
    store.refresh(spark, b, out_dir, "R")
    assert store.current(spark, out_dir, "R").columns == ["y", "MAY-2025"]


def test_change_feed_ignores_older_versions(spark):
    cur = spark.createDataFrame([(1, 5, "new")], "k int, v int, s string")
    chg = spark.createDataFrame([(1, 3, "old"), (2, 1, "a"), (2, 2, "b")], "k int, v int, s string")
    got = sorted(tuple(r) for r in changes.apply_changes(cur, chg, ["k"], ["v"]).collect())
    assert got == [(1, 5, "new"), (2, 2, "b")]


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), ("b", "y")], "id string, p string")
    assert [tuple(r) for r in quality.duplicate_keys(df, ("id",)).collect()] == [("a", 2)]
    parent = spark.createDataFrame([("x",)], "id string")
    assert [r["id"] for r in quality.orphans(df, "p", parent, "id").collect()] == ["b"]
    assert {r["column"]: r["nulls"] for r in quality.null_counts(df, ["id", "p"]).collect()} == {"id": 0, "p": 1}
    old = spark.createDataFrame([("S1", "CSN9")], "id string, crime_schedule_number string")
    up = quality.upgrade(old, "submission")
    assert up.first()["crime_lower_schedule_number"] == "CSN9" and len(up.columns) == 18


def test_period_list_is_chronological(spark):
    t = tables(spark, [sub("S1", period="MAY-2025"), sub("S2", period="DEC-2024"), sub("S3", period="2025-04")],
               [], [])
    assert monthly_matrix.period_list(t["submission"]).first()[0] == "2025-04, DEC-2024, MAY-2025"
    assert monthly_matrix.ordered_periods(t["submission"]) == ["2025-04", "DEC-2024", "MAY-2025"]
    counts = submissions.valid_counts(t["claim"], submissions.pick_latest(t["submission"]))
    assert counts.count() == 0


def test_exported_rep012_is_in_report_order(spark, out_dir):
    from claimsflow.catalog import tables as snapshot_tables
    t = snapshot_tables(spark, "/root/testdata/sf0.001")
    rep = original_values.original_values(t)
    info = export.publish(spark, rep, out_dir, "report_012.csv", original_values.sort_keys(rep))
    with open(info["path"], encoding="utf-8") as f:
        lines = f.read().splitlines()
    assert len(lines) == info["rows"] + 1 > 2
    keys = []
    for line in lines[1:]:
        office, month, area = line.split(",")[:3]
        d = dt.datetime.strptime(month.title(), "%b-%Y")
        keys.append((office, d.strftime("%Y%m"), area.strip('"')))
    assert keys == sorted(keys)
    folder = export.publish(spark, rep, out_dir, "report_012_parts.csv", original_values.sort_keys(rep),
                            single_file=False)
    import glob
    text = "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(folder["path"] + "/part-*")))
    assert text.splitlines() == lines


def test_stream_created_per_day(spark, out_dir):
    from claimsflow.streaming.summaries import created_per_day
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    stream = (spark.readStream.schema(ev.schema).option("basePath", "/root/testdata/sf0.001")
              .parquet("/root/testdata/sf0.001/events.parque[t]")
              .select(F.col("ts").cast("timestamp").alias("created_on")))
    q = (created_per_day(stream).writeStream.outputMode("append").format("memory")
         .queryName("created_per_day").option("checkpointLocation", f"{out_dir}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r["day"]: r["created"] for r in spark.table("created_per_day").collect()}
    batch = {r[0]: r[1] for r in ev.groupBy(F.to_date("ts")).count().collect()}
    # days within the one-day delay of the newest event stay open; every
    # day the watermark has closed agrees with the batch count
    assert got and all(batch[d] == n for d, n in got.items())
    assert len(batch) - 2 <= len(got) < len(batch)


def test_bucketed_change_state_rewrites_only_touched_buckets(spark, out_dir):
    import json
    from claimsflow.sinks import store as st
    first = spark.createDataFrame([(k, 1, "a") for k in range(40)], "k int, v int, s string")
    changes.start_copy(spark, first, out_dir, "S", ["k"], ["v"], buckets=8)
    before = json.loads(st._read_text(spark, st.pointed(spark, f"{out_dir}/S")))
    upd = spark.createDataFrame([(3, 2, "b"), (3, 0, "old"), (99, 1, "new")], "k int, v int, s string")
    changes._merge(spark, upd, out_dir, "S", ["k"], ["v"], 8)
    after = json.loads(st._read_text(spark, st.pointed(spark, f"{out_dir}/S")))
    moved = [b for b in after["buckets"] if after["buckets"][b] != before["buckets"].get(b)]
    assert 1 <= len(moved) <= 2
    state = {r["k"]: (r["v"], r["s"]) for r in changes.current_state(spark, out_dir, "S").collect()}
    assert len(state) == 41 and state[3] == (2, "b") and state[99] == (1, "new") and state[7] == (1, "a")


def test_failing_refresh_skips_its_export_and_not_the_others(spark, out_dir):
    from claimsflow.plans import batch
    from tests import fixture as fx

    def broken(_t):
        raise RuntimeError("boom")
    reports = [batch.Report("BROKEN", "broken.csv", broken, lambda df: []),
               *batch.standard_reports(fx.AS_OF)[1:2]]
    rows = {r["report"]: r for r in batch.run(spark, fx.tables(spark), reports, out_dir).collect()}
    assert rows["BROKEN"]["ok"] is False and rows["BROKEN"]["error"].startswith("refresh: boom")
    assert rows["REPORT012"]["ok"] and rows["REPORT012"]["rows"] == 3
    import os
    assert not os.path.exists(f"{out_dir}/reports/broken.csv")
    assert batch.run(spark, fx.tables(spark), [], out_dir).count() == 0


def test_unhealthy_copy_stops_the_run(spark, out_dir):
    import pytest
    from claimsflow.plans import batch
    with pytest.raises(batch.ReplicationUnhealthy):
        batch.run(spark, {}, [], out_dir, verdict={"healthy": False, "lsn_ok": False, "summary": "x"},
                  ignore_rowcount_mismatch=True)


def test_hot_submission_join_is_split(spark):
    """One submission holds a third of all claims: AQE splits its partition."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 3000
        subs = [sub(f"S{i}") for i in range(200)]
        claims = [claim(f"C{i}", "S0" if i % 3 == 0 else f"S{i % 200}") for i in range(n)]
        t = tables(spark, subs, claims, [])
        df = combined.combined_extract(t, "2025-11-03")
        assert len(df.collect()) == n
        final = df._jdf.queryExecution().executedPlan().toString()
        assert "isSkewJoin=true" in final or "skew=true" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_matrix_keeps_case_variant_periods_apart(spark):
    t = tables(spark, [sub("S1", period="APR-2025"), sub("S2", period="apr-2025", office="OA002"),
                       sub("S3", period="MAY`2025", office="OA003")],
               [claim("C1", "S1"), claim("C2", "S2")], [fee("F1", "C1", "1"), fee("F2", "C2", "2")])
    m = monthly_matrix.monthly_matrix(t)
    assert m.columns[2:] == ["APR-2025", "apr-2025", "MAY`2025"]
    rows = {r[0]: tuple(r[2:]) for r in m.collect()}
    assert rows == {"OA001": ("1.00", "", ""), "OA002": ("", "2.00", ""), "OA003": ("", "", "0.00")}


def test_day_period_fails_the_matrix_unless_lenient(spark):
    import pytest
    t = tables(spark, [sub("S1", period="APR-2025"), sub("S2", period="2025-04-01", office="OA002")],
               [claim("C1", "S1")], [fee("F1", "C1", "1")])
    with pytest.raises(Exception):
        monthly_matrix.monthly_matrix(t).collect()
    m = monthly_matrix.monthly_matrix(t, on_bad_period="null")
    assert m.columns[2:] == ["APR-2025", "2025-04-01"]  # null year sorts last (D7)
    assert {r[0]: tuple(r[2:]) for r in m.collect()} == {"OA001": ("1.00", ""), "OA002": ("", "0.00")}


def test_case_variant_periods_survive_store_and_export(spark, out_dir):
    t = tables(spark, [sub("S1", period="APR-2025"), sub("S2", period="apr-2025", office="OA002")],
               [claim("C1", "S1")], [fee("F1", "C1", "1")])
    store.refresh(spark, monthly_matrix.monthly_matrix(t), f"{out_dir}/store", "R13")
    stored = store.current(spark, f"{out_dir}/store", "R13")
    assert stored.columns[2:] == ["APR-2025", "apr-2025"]
    info = export.publish(spark, stored, out_dir, "m.csv", monthly_matrix.sort_keys(stored))
    with open(info["path"], encoding="utf-8") as f:
        assert f.read().splitlines() == ['"Provider Office Account Number","Area of Law",APR-2025,apr-2025',
                                         "OA001,CIVIL,1.00,", "OA002,CIVIL,,0.00"]
