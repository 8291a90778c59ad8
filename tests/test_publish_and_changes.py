"""Deletes in the change feed, atomic publishing, tables that only the check counts."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from claimsflow.schemas import REPORT_TABLES, SCHEMAS
from claimsflow.sinks import export
from claimsflow.sources import snapshot
from claimsflow.streaming import changes


def _merge(spark, out_dir, rows):
    df = spark.createDataFrame(rows, "k int, v int, s string, op string")
    changes._merge(spark, df, out_dir, "D", ["k"], ["v"], 4, deleted="op = 'D'")


def _state(spark, out_dir):
    return {r["k"]: r["s"] for r in changes.current_state(spark, out_dir, "D").collect()}


def test_deletes_are_tombstones(spark, out_dir):
    _merge(spark, out_dir, [(1, 1, "a", None), (2, 1, "b", "I"), (3, 1, "c", "I")])
    _merge(spark, out_dir, [(1, 5, None, "D"), (9, 1, None, "D")])
    assert _state(spark, out_dir) == {2: "b", 3: "c"}
    _merge(spark, out_dir, [(1, 3, "late", "U")])  # older than the delete
    assert _state(spark, out_dir) == {2: "b", 3: "c"}
    _merge(spark, out_dir, [(1, 6, "again", "I"), (2, 0, None, "D")])  # a newer row; an old delete
    assert _state(spark, out_dir) == {1: "again", 2: "b", 3: "c"}
    assert changes.TOMBSTONE not in changes.current_state(spark, out_dir, "D").columns


def test_all_rows_deleted_leaves_an_empty_state(spark, out_dir):
    _merge(spark, out_dir, [(1, 1, "a", "I")])
    _merge(spark, out_dir, [(1, 2, None, "D")])
    assert _state(spark, out_dir) == {}


def test_published_folder_is_switched_and_numbered(spark, out_dir):
    rows = spark.range(1000).select(F.format_string("%05d", "id").alias("k"), F.lit("x").alias("v")).repartition(7)
    first = export.publish(spark, rows, out_dir, "r.csv", ["k"], single_file=False)
    second = export.publish(spark, rows.where("k < '00500'"), out_dir, "r.csv", ["k"], single_file=False)
    assert os.path.isdir(first["path"])  # readers of the old report are not cut off
    assert export.published(spark, out_dir, "r.csv") == second["path"] != first["path"]
    export.publish(spark, rows.where("k < '00500'"), out_dir, "r.csv", ["k"], single_file=False)
    assert not os.path.exists(first["path"])
    lines = sorted((r["line_number"], r["line"]) for r in export.published_lines(spark, out_dir, "r.csv").collect())
    assert lines == [(0, "k,v"), *((i + 1, f"{i:05d},x") for i in range(500))]
    names = sorted(os.path.basename(p) for p in glob.glob(export.published(spark, out_dir, "r.csv") + "/part-*"))
    assert names[0] == "part-0000000000.csv" and {len(n) for n in names} == {19}


def test_lines_are_numbered_over_split_files(spark, out_dir):
    rows = spark.range(3000).select(F.format_string("%08d", "id").alias("k")).coalesce(1)
    export.publish(spark, rows, out_dir, "s.csv", [], single_file=False)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        got = sorted((r["line_number"], r["line"]) for r in export.published_lines(spark, out_dir, "s.csv").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [(0, "k"), *((i + 1, f"{i:08d}") for i in range(3000))]


def test_single_file_is_replaced_whole_and_its_limit_is_explicit(spark, out_dir):
    rows = spark.range(20).select(F.col("id").cast("string").alias("k"))
    info = export.publish(spark, rows, out_dir, "f.csv", ["k"])
    with open(info["path"], encoding="utf-8") as f:
        before = f.read()
    with pytest.raises(ValueError, match="single-file limit"):
        export.publish(spark, rows, out_dir, "f.csv", ["k"], max_bytes=5)
    with open(info["path"], encoding="utf-8") as f:
        assert f.read() == before  # the refused report left the old one
    export.publish(spark, rows.where("id < 3"), out_dir, "f.csv", ["k"])
    with open(info["path"], encoding="utf-8") as f:
        assert f.read() == "k\n0\n1\n2\n"
    export.publish(spark, rows.where("false"), out_dir, "f.csv", ["k"])
    assert os.path.getsize(info["path"]) == 0


def test_nightly_run_reads_counted_tables_the_copy_holds(spark, out_dir):
    assert snapshot.names_to_check(spark, out_dir) == REPORT_TABLES
    spark.createDataFrame([], SCHEMAS["matter_start"]).write.parquet(f"{out_dir}/matter_start")
    assert snapshot.names_to_check(spark, out_dir) == (*REPORT_TABLES, "matter_start")
