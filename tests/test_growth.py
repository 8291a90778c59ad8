"""What a query does must not grow faster than its tables, nor break where they are large."""

import datetime as dt
import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from claimsflow import catalog
from claimsflow.operators import key_filter, ordering, quality, reconcile
from claimsflow.plans import combined, original_values
from claimsflow.schemas import REPORT_TABLES
from claimsflow.sinks import store
from claimsflow.sources import retention, testbed
from claimsflow.streaming import changes, summaries

SF = "/root/testdata/sf0.001"


def lineitem(spark):
    day = dt.datetime(1999, 1, 5)
    rows = [(k, p, 1, n, 30.0, 100.25 + p, 0.05, 0.04, "A", "F", day + dt.timedelta(days=p)) for k in range(1, 40) for n in (1, 2) for p in range(n)]
    rows += [rows[0], (None, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "A", "F", day)]
    return spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
                                 " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")


def _exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_a_query_writes_only_the_tables_it_reads(spark, out_dir):
    t = catalog.Snapshot(spark, SF, f"{out_dir}/snapshot")
    assert list(t) == list(REPORT_TABLES) and "claim" in t and "matter_start" not in t and not os.path.exists(t.root)
    assert t["submission"].count() > 0 and os.listdir(t.root) == ["submission"]
    with pytest.raises(KeyError):
        t["matter_start"]
    # the stored claim groups give the rows that the groups themselves give
    for name, df in testbed.claims_tables(spark, SF).items():
        assert sorted(map(str, df.collect())) == sorted(map(str, t[name].collect())), name


def test_shaping_shuffles_narrow_rows_and_only_once(spark):
    li = lineitem(spark)
    groups = testbed._claim_groups(li)
    fees = testbed.summary_fees(groups)
    assert _exchanges(fees) == 1
    got = {r.claim_id: r.net_profit_costs_amount for r in fees.collect()}
    sums = li.groupBy("l_orderkey", "l_linenumber").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("s")).collect()
    assert got == {f"C{r[0] * 10 + r[1]:011d}": str(r.s) for r in sums if r[0] is not None and (r[0] * 10 + r[1]) % 17}
    # the fee texts are made after the rows are numbered
    plan = testbed.fee_details(li)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window"):]
    assert "Description" not in below and "FEE" not in below


def test_the_run_goes_ahead_where_the_tables_have_grown(spark):
    schema = "table_name string, summary_date date, record_count bigint, updated_count bigint, wal_lsn string"
    day = dt.date(2000, 5, 31)
    small = spark.createDataFrame([("claims.a", day, 1, 1, "0/1000")], schema)
    assert testbed.source_lsn(small) == testbed.CURRENT_LSN == testbed.source_lsn(small.limit(0))
    large = small.unionByName(spark.createDataFrame([("claims.b", day, 2_000_000, 1, "0/1E8480000")], schema))
    assert not reconcile.lsn_progress(large, testbed.CURRENT_LSN).first().ok
    assert reconcile.lsn_progress(large, testbed.source_lsn(large)).first().ok


def test_line_items_are_grouped_without_a_sort(spark):
    day = dt.datetime(1999, 1, 5)
    flags = {1: "RR", 2: "RS", 3: "AR", 4: "NA", 5: [None], 6: [None, "R"], 7: ["R", "Q"], 8: ["r", "R"], 9: ["", "R"]}
    rows = [(k, 1, n, 1.0, f, day) for k, fs in flags.items() for n in (1, 2) for f in fs]
    li = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_linenumber int, l_extendedprice double, l_returnflag string, l_shipdate timestamp")
    groups = testbed._claim_groups(li)
    assert "SortAggregate" not in groups._jdf.queryExecution().executedPlan().toString()
    got = {(r.submission_id, r.line_number): r.status for r in testbed.claims(groups).collect()}
    assert got == {(f"S{k:010d}", n): "INVALID" if min((f for f in fs if f is not None), default="") == "R" else "VALID"
                   for k, fs in flags.items() for n in (1, 2)}


def test_the_snapshot_is_stored_small(spark, out_dir):
    t = catalog.Snapshot(spark, SF, f"{out_dir}/snapshot")
    assert all(".zstd." in f for f in t["claim"].inputFiles()) and t["claim"].count() > 0
    assert ".zstd." in t._groups.inputFiles()[0]


def test_the_bits_of_a_key_filter_are_dealt_before_they_are_set(spark):
    keys = spark.range(5000).select(F.concat(F.lit("C"), "id").alias("claim_id"))
    plan = key_filter.bitmap(keys, "claim_id", 1 << 18)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_bitmap_construct_agg") < plan.index("Exchange hashpartitioning(_block")


def test_the_claims_are_cut_before_their_shuffle_too(spark):
    t = catalog.tables(spark, SF)
    cut = combined.combined_extract(t, testbed.AS_OF)
    assert cut._jdf.queryExecution().sparkPlan().toString().count("ReadSchema: struct<_block:bigint,_bits:binary>") == 5


def test_months_come_from_the_written_parent_without_a_sort_of_the_rows(spark, out_dir):
    child = spark.createDataFrame([("c1", "p1", "x"), ("c2", "p2", "y"), ("c3", None, "z"), ("c4", "gone", "w")], "id string, parent_id string, t string")
    path = f"{out_dir}/parent"
    spark.createDataFrame([("p1", "1999-01"), ("p2", None), (None, "1999-02")], "id string, upload_month string").write.partitionBy("upload_month").parquet(path)
    got = retention._with_parents_month(child, "parent_id", retention._months_of(spark, path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort [" not in plan
    assert sorted(map(tuple, got.collect())) == [("c1", "p1", "x", "1999-01"), ("c2", "p2", "y", None), ("c3", None, "z", None), ("c4", "gone", "w", None)]


def test_batches_and_state_of_the_summaries_do_not_grow_with_the_files(spark, out_dir):
    made = dt.datetime(2025, 1, 1)
    rows = spark.createDataFrame([(f"r{k}", made + dt.timedelta(days=k), None) for k in range(24)], "id string, created_on timestamp, updated_on timestamp")
    rows.repartition(24).write.parquet(f"{out_dir}/in/claim")
    files = summaries.files_a_batch(spark, f"{out_dir}/in", ["claim"], 3)
    streams = summaries.table_streams(spark, f"{out_dir}/in", {"claim": rows.schema}, files_per_batch=files)
    before = spark.conf.get(summaries.SHUFFLES)
    spark.conf.set(summaries.SHUFFLES, "40")
    try:
        q = summaries.start(streams, f"{out_dir}/out", f"{out_dir}/cp")
        q.awaitTermination()
        assert spark.conf.get(summaries.SHUFFLES) == "40"
    finally:
        spark.conf.set(summaries.SHUFFLES, before)
    assert 1 < len([p for p in q.recentProgress if p["numInputRows"]]) <= 3
    assert len([d for d in os.listdir(f"{out_dir}/cp/state/0") if d.isdigit()]) == summaries.STATE_STORES
    assert summaries.table_summaries(spark, f"{out_dir}/out").where("summary_date = '2025-01-24' AND record_count = 24").count() == 1


def test_the_order_is_proved_on_the_columns_it_reads(spark, monkeypatch):
    sorted_with = []
    whole = catalog.ordering.sorted_ranges
    monkeypatch.setattr(catalog.ordering, "sorted_ranges", lambda df, keys: sorted_with.append(df.columns) or whole(df, keys))
    rows = combined.combined_extract(catalog.tables(spark, SF), testbed.AS_OF).count()
    assert catalog.QUERIES["report_lines_000"](spark, SF).count() == rows
    assert {r.report: (r.rows, r.out_of_order) for r in catalog.QUERIES["report_order_breaks"](spark, SF).collect()}["REPORT000"] == (rows, 0)
    assert sorted_with == [[*combined.ORDER_COLUMNS], [*combined.ORDER_COLUMNS], [*original_values.ORDER_COLUMNS]]


def test_rows_of_fixed_width_are_reduced_without_a_sort(spark):
    made = dt.datetime(2025, 3, 1)
    rows = [(f"k{k}" if k else None, v, made + dt.timedelta(days=10 * k + n), n % 3 == 0, old)
            for k in range(6) for n, (v, old) in enumerate([(2, False), (None, False), (3, False), (3, True), (None, True), (1, True)]) if k != 4 or v is None]
    df = spark.createDataFrame(rows, "id string, version int, created_on timestamp, gone boolean, old boolean")
    for kind in ("int", "bigint", "timestamp", "date", "decimal(9,2)"):  # the last is no rank of its own: the whole row is compared
        number = F.col("version")
        version = F.timestamp_seconds(number * 90_000) if kind == "timestamp" else F.date_add(F.lit("2025-01-01"), number) if kind == "date" else number.cast(kind)
        got = changes.latest_per_key(df.withColumn("version", version), ["id"], ["version"], F.col("old"))
        assert ("SortAggregate" in got._jdf.queryExecution().executedPlan().toString()) == (kind == "decimal(9,2)")
        # the stored row of equal versions, also where all versions are null
        want = {f"k{k}" if k else None: (made + dt.timedelta(days=10 * k + (4 if k == 4 else 3)), k != 4) for k in range(6)}
        assert {r.id: (r.created_on, r.gone) for r in got.collect()} == want
    assert changes.latest_per_key(df, ["id"], ["version", "created_on"]).where("created_on = '2025-03-04 00:00:00'").count() == 1


def test_a_batch_is_reduced_once_together_with_the_state(spark, out_dir, monkeypatch):
    reduced = []
    whole = changes.latest_per_key
    monkeypatch.setattr(changes, "latest_per_key", lambda *a: reduced.append(a) or whole(*a))
    made = dt.datetime(2025, 3, 1)
    for n in (1, 2):
        rows = spark.createDataFrame([(f"k{k}", made + dt.timedelta(days=n), None, n) for k in range(20 * n)], "id string, created_on timestamp, updated_on timestamp, version int")
        changes._merge(spark, rows, out_dir, "T", ["id"], ["version"], 3, days="claims.t")
        assert len(reduced) == n and not spark.sparkContext._jsc.getPersistentRDDs()
    assert [(r.day, r.created, r.updated_count) for r in changes.day_totals(spark, out_dir, "T").collect()] == [(dt.date(2025, 3, 3), 40, 0)]


def test_keys_are_not_broadcast_from_a_guess(spark):
    t = catalog.tables(spark, SF)
    found = quality.orphans(t["claim"], "submission_id", t["submission"], "id")
    for df in (found, catalog.QUERIES["dq_foreign_key"](spark, SF)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    child = spark.createDataFrame([("a", "p1"), ("b", None), ("c", "gone"), ("d", "gone")], "id string, parent string")
    parent = spark.createDataFrame([("p1",), ("p1",), (None,)], "id string")
    assert sorted(r.id for r in quality.orphans(child, "parent", parent, "id").collect()) == ["c", "d"]


def test_upgraded_submissions_are_not_broadcast_from_a_guess(spark):
    got = catalog.QUERIES["schema_upgrade"](spark, SF)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == catalog.tables(spark, SF)["claim"].count()


def test_computed_sort_keys_are_made_once_a_row(spark, out_dir):
    rows = [("MAR-2025", "b", "1", "c1"), ("APR-2024", "a", "1", "c2"), ("", "a", "1", "c3"), (None, "a", None, "c4"), ("MAR-2025", None, "1", "c5"), ("MAR-2025", "b", "1", "c0")]
    rep = spark.createDataFrame(rows, [*combined.ORDER_COLUMNS])
    keys = combined.sort_keys(rep)
    got = ordering.ordered(rep, keys)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "to_date" not in plan[plan.index("Sort ["):].splitlines()[0] and got.columns == rep.columns
    assert [r["Claim ID"] for r in got.collect()] == [r["Claim ID"] for r in rep.orderBy(*keys).collect()] == ["c2", "c0", "c1", "c5", "c3", "c4"]
    lines = ordering.numbered(ordering.sorted_ranges(rep, keys)).orderBy("line_number")
    assert [r["Claim ID"] for r in lines.collect()] == ["c2", "c0", "c1", "c5", "c3", "c4"]
    assert [r.id for r in ordering.ordered(spark.range(3), [F.col("id").desc()]).collect()] == [2, 1, 0]


def test_shuffle_files_go_with_their_query(spark):
    held = lambda: {f for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
                    for f in glob.glob(f"{d.toString()}/*/shuffle_*.data")}
    before = held()
    df = spark.range(100_000).repartition(5, "id").withColumn("x", F.col("id") % 7)
    assert df.groupBy("x").count().count() == 7 and [len(df.collect()) for _ in range(2)] == [100_000] * 2  # an action again, after its files went
    deadline = time.time() + 20
    while held() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not held() - before


def test_claim_groups_go_once_their_tables_are_stored(spark, out_dir):
    t = catalog.Snapshot(spark, SF, f"{out_dir}/snapshot")
    counts = {n: t[n].count() for n in testbed.GROUPED}
    assert all(counts.values()) and not os.path.exists(f"{t.root}/_claim_groups")
    assert counts == {n: t[n].count() for n in testbed.GROUPED} and t["submission"].count() > 0


def test_reports_and_months_are_stored_small(spark, out_dir):
    run = store.refresh(spark, spark.range(5), out_dir, "R")
    retention.write({"bulk_submission": spark.createDataFrame([("b1", dt.datetime(1999, 1, 5))], "id string, created_on timestamp")}, f"{out_dir}/months")
    files = glob.glob(f"{run}/*.parquet") + glob.glob(f"{out_dir}/months/bulk_submission/*/*.parquet")
    assert len(files) >= 2 and all(".zstd." in f for f in files)
    assert sorted(r.id for r in store.current(spark, out_dir, "R").collect()) == [0, 1, 2, 3, 4]
