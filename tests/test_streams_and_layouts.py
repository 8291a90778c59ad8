"""Stream summaries against the batch form; folders with files of several layouts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimsflow.operators import reconcile
from claimsflow.schemas import SCHEMAS
from claimsflow.sources import layouts, snapshot
from claimsflow.streaming import summaries
from tests import fixture

ROW = "id string, created_on timestamp, updated_on timestamp"


def _rows(spark, first, n, day0=dt.datetime(2025, 1, 1)):
    rows = []
    for k in range(first, first + n):
        made = day0 + dt.timedelta(days=(k * 7) % 23, hours=k % 24)
        moved = [None, made + dt.timedelta(days=2), dt.datetime.combine(made.date(), dt.time()) + dt.timedelta(days=k % 3)][k % 3]
        rows.append((f"r{k}", made, moved))
    return spark.createDataFrame(rows, ROW)


def _same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_stream_summaries_equal_the_batch_form(spark, out_dir):
    root = f"{out_dir}/in"
    schemas = dict.fromkeys(("claim", "client", "quiet"), spark.createDataFrame([], ROW).schema)
    for k in range(5):
        _rows(spark, 40 * k, 40).coalesce(1).write.mode("append").parquet(f"{root}/claim")
        _rows(spark, 13 * k, 13).coalesce(1).write.mode("append").parquet(f"{root}/client")
    spark.createDataFrame([], schemas["quiet"]).write.parquet(f"{root}/quiet")

    def run():
        q = summaries.start(summaries.table_streams(spark, root, schemas, files_per_batch=1), f"{out_dir}/out", f"{out_dir}/cp")
        q.awaitTermination()
        return q
    q = run()
    assert len([p for p in q.recentProgress if p["numInputRows"]]) > 1  # several micro-batches
    read = lambda: {n: spark.read.schema(s).parquet(f"{root}/{n}") for n, s in schemas.items()}
    got = summaries.table_summaries(spark, f"{out_dir}/out")
    assert _same(got, reconcile.daily_summaries(read())) and got.where("updated_count > 0").count() > 10
    # late rows, months before all others, come after the query has stopped
    _rows(spark, 500, 9, dt.datetime(2024, 10, 5)).coalesce(1).write.mode("append").parquet(f"{root}/client")
    run()
    got = summaries.table_summaries(spark, f"{out_dir}/out")
    assert _same(got, reconcile.daily_summaries(read())) and got.agg(F.min("summary_date")).first()[0] < dt.date(2024, 11, 1)
    run()  # nothing new
    assert _same(summaries.table_summaries(spark, f"{out_dir}/out"), got)
    last = {r.table_name: r.open_day for r in summaries.closed_before(spark, f"{out_dir}/out").collect()}
    assert set(last) == {"claims.claim", "claims.client"}


def _claims(spark):
    return fixture.tables(spark)["claim"]


def test_layouts_of_one_folder_give_the_final_schema(spark, out_dir):
    path = f"{out_dir}/claim"
    claim = _claims(spark)
    new = claim.withColumns({"version": F.lit(3).cast("bigint"), "is_amended": F.lit(True)})
    new.write.mode("append").parquet(path)
    claim.drop("is_amended", "has_assessment", "version").write.mode("append").parquet(path)
    # the same columns in another order and type are a layout of their own
    new.withColumn("version", F.lit(4)).select(*reversed(new.columns)).write.mode("append").parquet(path)
    # a null that breaks the contract stays one: no default hides it
    new.withColumn("has_assessment", F.lit(None).cast("boolean")).write.mode("append").parquet(path)
    assert len(layouts.layouts(spark, path)) == 3
    got = snapshot.read_table(spark, out_dir, "claim")
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in SCHEMAS["claim"]]
    n = claim.count()
    rows = [(r.version, r.is_amended, r.has_assessment) for r in got.collect()]
    assert sorted(rows, key=str) == sorted([(3, True, False), (0, False, False), (4, True, False), (3, True, None)] * n, key=str)


def test_old_submission_layouts(spark, out_dir):
    sub = fixture.tables(spark)["submission"]
    old = sub.withColumnsRenamed({"crime_lower_schedule_number": "crime_schedule_number", "legal_help_submission_reference": "civil_submission_reference"})
    old.drop("provider_user_id").write.parquet(f"{out_dir}/submission")
    sub.write.mode("append").parquet(f"{out_dir}/submission")
    got = snapshot.read_table(spark, out_dir, "submission")
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r.id, []).append(r)
    for r in sub.collect():
        a, b = by_id[r.id]
        assert a.crime_lower_schedule_number == b.crime_lower_schedule_number == r.crime_lower_schedule_number
        assert {a.provider_user_id, b.provider_user_id} == {None, r.provider_user_id}


@pytest.mark.parametrize("change", [lambda d: d.withColumn("surprise", F.lit(1)), lambda d: d.drop("status"), lambda d: d.drop("created_on"),
                                    lambda d: d.withColumn("crime_schedule_number", F.lit("x"))])
def test_unknown_layouts_raise_wherever_the_file_is(spark, out_dir, change):
    sub = fixture.tables(spark)["submission"]
    sub.write.parquet(f"{out_dir}/submission")
    change(sub).write.mode("append").parquet(f"{out_dir}/submission")
    with pytest.raises(snapshot.SchemaMismatch):
        snapshot.read_table(spark, out_dir, "submission")


def test_empty_folders_and_hidden_files(spark, out_dir):
    import os
    os.makedirs(f"{out_dir}/claim/_temporary")
    with pytest.raises(FileNotFoundError):
        snapshot.read_table(spark, out_dir, "claim")
    open(f"{out_dir}/claim/_temporary/part-0.parquet", "w").close()
    open(f"{out_dir}/claim/.part-0.crc", "w").close()
    _claims(spark).limit(0).write.mode("append").parquet(f"{out_dir}/claim")
    assert snapshot.read_table(spark, out_dir, "claim").count() == 0


def test_footers_of_stores_that_only_spark_opens(spark, out_dir, monkeypatch):
    path = f"{out_dir}/claim"
    _claims(spark).write.parquet(path)
    _claims(spark).drop("version", "is_amended", "has_assessment").write.mode("append").parquet(path)
    names = {frozenset(layouts.names_of(x)) for x in layouts.layouts(spark, path)}
    monkeypatch.setattr(layouts, "_footers", _unopened)
    assert {frozenset(layouts.names_of(x)) for x in layouts.layouts(spark, path)} == names
    assert layouts.read_mixed(spark, path, "claim").count() == 2 * _claims(spark).count()


def _unopened(batches):
    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("file"), pa.array([None] * b.num_rows, pa.list_(pa.string()))], names=["file", "layout"])


def test_runs_of_other_writers_and_other_spellings_of_the_folder_stay(spark, out_dir):
    from claimsflow.sinks import store
    df = spark.range(3)
    first = store.refresh(spark, df, f"{out_dir}/", "R")  # the same folder, spelt in two ways
    filling = f"{out_dir}/R/run-of-another-writer"
    df.write.parquet(filling)
    second = store.refresh(spark, df, out_dir, "R")
    assert spark.read.parquet(first).count() == spark.read.parquet(second).count() == spark.read.parquet(filling).count() == 3
    third = store.refresh(spark, df, out_dir, "R")
    import os
    assert {n for n in os.listdir(f"{out_dir}/R") if n.startswith("run-")} == {os.path.basename(x) for x in (second, third, filling)}
    store.prune_runs(spark, f"{out_dir}/R", set(), lease_s=-60)  # past the lease
    assert not os.path.exists(filling) and store.current(spark, out_dir, "R").count() == 3
