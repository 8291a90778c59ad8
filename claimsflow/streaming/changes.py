"""Keep a copy current from a change feed (STM-1, re-aimed from the
reference's database subscription).

Initial copy, then every change: per key the row with the highest version
wins.  A replayed or late change whose version is not newer than the stored
row changes nothing, so replays after a lost executor or a restarted query
are harmless.

A delete is a change with its own version that carries the key; ``deleted`` says
which changes are deletes (null: not one).  Its row stays in the state as a
tombstone, so that an older change that arrives late does not bring the key
back; :func:`current_state` leaves tombstones out.

State layout: rows are spread over ``buckets`` by a hash of the key and each
bucket lives in its own folder; a small manifest (bucket -> folder) names the
current folders and is switched all at once through ``sinks.store``'s
pointer.  Only the buckets that the keys of a micro-batch fall into are read, and
reduced together with the batch to one row per key (partial aggregation: a hot key
never lands whole in one task), and rewritten -- the cost of a batch follows the
batch, not the size of the state.  Writing the new bucket folders also cuts the
lineage between batches.  Folders and manifests that neither the current nor the
previous manifest names are removed.

With ``days`` (the full name of the table) the state also keeps how many of its
rows were created and updated on each day: a batch takes away the marks of the
buckets it rewrites as they were and adds those of what it wrote, so the totals
change by the rows it replaces, deletes and brings.  The totals are
switched together with the rows, so a replayed batch changes neither.
"""

from __future__ import annotations

import functools
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from claimsflow.operators import reconcile
from claimsflow.sinks import store

DEFAULT_BUCKETS = 64
TOMBSTONE = "_deleted"
# Types that a hash aggregate updates in place.
_FIXED_WIDTH = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def marked(df: DataFrame, deleted: Column | str | None = None) -> DataFrame:
    """``df`` with the tombstone column: true where ``deleted`` holds."""
    condition = F.expr(deleted) if isinstance(deleted, str) else F.lit(False) if deleted is None else deleted
    return df.withColumn(TOMBSTONE, F.coalesce(condition, F.lit(False)))


def _rank(df: DataFrame, version: list[str], stored: Column) -> Column | None:
    """One number that orders rows as their version does, a null version below all
    and ``stored`` rows before others of theirs; None where the version is not one
    whole number, date or instant."""
    kind, at = df.schema[version[0]].dataType, F.col(version[0])
    if len(version) > 1:
        return None
    if isinstance(kind, T.ByteType | T.ShortType | T.IntegerType):
        number, least = at.cast("bigint") * 2, F.lit(-(1 << 62))
    elif isinstance(kind, T.DateType):
        number, least = F.unix_date(at).cast("bigint") * 2, F.lit(-(1 << 62))
    elif isinstance(kind, T.LongType | T.TimestampType):
        whole = F.unix_micros(at) if isinstance(kind, T.TimestampType) else at
        number, least = whole.cast("decimal(20,0)") * F.lit(2).cast("decimal(1,0)"), F.lit("-1e20").cast("decimal(21,0)")
    else:
        return None
    return F.coalesce(number, least) + stored.cast("int")


def latest_per_key(df: DataFrame, key: list[str], version: list[str], stored: Column | None = None) -> DataFrame:
    """Per key the whole row with the greatest ``version`` tuple; of equal ones a
    ``stored`` row, where given.  Rows of fixed width are reduced by a hash
    aggregate: all columns follow one rank, so they come from one row."""
    others = [c for c in df.columns if c not in key]
    stored = F.lit(False) if stored is None else stored
    rank = _rank(df, version, stored)
    if rank is not None and all(isinstance(df.schema[c].dataType, _FIXED_WIDTH) for c in others):
        best = [F.max_by(c, "_rank").alias(c) for c in others]
        return df.select(*key, *others, rank.alias("_rank")).groupBy(*key).agg(*best).select(*key, *others)
    row = F.max_by(F.struct(*[F.col(c) for c in others]), F.struct(*[F.col(v) for v in version], stored.alias("_stored")))
    return df.groupBy(*key).agg(row.alias("_row")).select(*key, *[F.col(f"_row.{c}").alias(c) for c in others])


def apply_changes(current: DataFrame | None, changes: DataFrame, key: list[str],
                  version: list[str]) -> DataFrame:
    """Batch form: new state = latest per key over (state ∪ changes)."""
    merged = changes if current is None else current.unionByName(changes)
    return latest_per_key(merged, key, version)


def _bucket(key: list[str], buckets: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(buckets)).cast("int")


def _manifest(spark: SparkSession, root: str, name: str) -> dict | None:
    text = store.pointed(spark, f"{root}/{name}")
    if text is None:
        return None
    return json.loads(store._read_text(spark, text))


def _folders(manifest: dict) -> set[str]:
    """Names of the batch folders that a manifest points into."""
    paths = [p.rsplit("/", 1)[0] for p in manifest["buckets"].values()] + [p for p in [manifest.get("days")] if p]
    return {store._name(p) for p in paths}


def _switch(spark: SparkSession, root: str, name: str, manifest: dict) -> None:
    home = f"{root}/{name}"
    path = f"{home}/manifest-{uuid.uuid4().hex}.json"
    store._write_text(spark, path, json.dumps(manifest))
    gone = store.switch_pointer(spark, home, path)
    kept = {store._name(store._read_text(spark, p)) for _, p in store._pointers(spark, home)}
    used = set().union(*[_folders(json.loads(store._read_text(spark, f"{home}/{m}"))) for m in kept])
    fs, _, jvm = store._fs(spark, home)
    for old in gone:  # manifests that no pointer names, and what only they used
        folders = _folders(json.loads(store._read_text(spark, f"{home}/{old}"))) - used
        for item in (*folders, old):
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{home}/{item}"), True)


def _live(df: DataFrame) -> DataFrame:
    return df.where(~F.col(TOMBSTONE))


def _new_days(spark: SparkSession, totals: str | None, before: DataFrame | None, after: DataFrame, table_name: str, path: str) -> str:
    """Write the day totals once ``before`` (rows as they were, if any) became ``after``."""
    signed = [reconcile.day_marks(_live(df), table_name).select("table_name", "day", (F.col("c") * sign).alias("c"), (F.col("u") * sign).alias("u"))
              for df, sign in ((before, -1), (after, 1)) if df is not None]
    delta = reconcile.day_totals(functools.reduce(DataFrame.unionByName, signed))
    if totals:
        delta = (spark.read.schema(_DAYS).parquet(totals).unionByName(delta).groupBy("table_name", "day")
                 .agg(F.sum("created").alias("created"), F.sum("updated_count").alias("updated_count")))
    delta.where("created <> 0 OR updated_count <> 0").select("table_name", "day", "created", "updated_count").write.parquet(path)
    return path


_DAYS = "table_name string, day date, created bigint, updated_count bigint"


def day_totals(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``table_name, day, created, updated_count`` of the rows of the current state."""
    m = _manifest(spark, root, name)
    if m is None or not m.get("days"):
        raise FileNotFoundError(f"no day totals for {name}")
    return spark.read.schema(_DAYS).parquet(m["days"])


def _write_buckets(df: DataFrame, folder: str, key: list[str], buckets: int) -> None:
    # A large bucket is split over tasks and files, small ones share a task (AQE's rebalance).
    df.withColumn("_bucket", _bucket(key, buckets)).hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(folder)


def current_state(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The whole current state (union of the manifest's bucket folders), without
    deleted keys."""
    m = _manifest(spark, root, name)
    if m is None:
        raise FileNotFoundError(f"no state for {name}")
    schema = T.StructType.fromJson(m["schema"])
    paths = list(m["buckets"].values())
    if not paths:
        return spark.createDataFrame([], schema).drop(TOMBSTONE)
    state = spark.read.schema(schema).parquet(*paths)
    return state.where(~F.col(TOMBSTONE)).drop(TOMBSTONE) if TOMBSTONE in state.columns else state


def _merge(spark: SparkSession, changes: DataFrame, root: str, name: str, key: list[str],
           version: list[str], buckets: int, deleted: Column | str | None = None, days: str | None = None) -> None:
    changes = marked(changes, deleted)
    folder = f"{root}/{name}/batch-{uuid.uuid4().hex}"
    m = _manifest(spark, root, name)
    if m is None:
        m = {"schema": None, "buckets": {}}
    # the touched bucket numbers, from the keys alone: at most ``buckets`` small ints
    touched = [r[0] for r in changes.select(_bucket(key, buckets)).distinct().collect()]
    old_paths = [m["buckets"][str(b)] for b in touched if str(b) in m["buckets"]]
    if days and m["buckets"] and not m.get("days"):
        raise ValueError(f"the state of {name} has no day totals; start its copy again")
    old = spark.read.schema(T.StructType.fromJson(m["schema"])).parquet(*old_paths) if old_paths else None
    if old is None:
        merged = latest_per_key(changes, key, version)
    elif TOMBSTONE not in old.columns:  # a state written before deletes were kept
        raise ValueError(f"the state of {name} has no tombstones; start its copy again")
    else:
        # one reduction of both: a change counts where it is newer than the stored row
        both = old.withColumn("_stored", F.lit(True)).unionByName(changes.withColumn("_stored", F.lit(False)))
        merged = latest_per_key(both, key, version, F.col("_stored")).drop("_stored")
    m["schema"] = m["schema"] or merged.schema.jsonValue()
    _write_buckets(merged, folder, key, buckets)
    written = [f"{folder}/_bucket={b}" for b in touched]
    if days:
        # unchanged rows are in both, the touched buckets as they were and as written, and cancel out
        schema = T.StructType.fromJson(m["schema"])
        after = spark.read.schema(schema).parquet(*written) if written else spark.createDataFrame([], schema)
        m["days"] = _new_days(spark, m.get("days"), old, after, days, f"{root}/{name}/days-{uuid.uuid4().hex}")
    for b, path in zip(touched, written, strict=True):
        m["buckets"][str(b)] = path
    _switch(spark, root, name, m)


def start_copy(spark: SparkSession, initial: DataFrame, root: str, name: str,
               key: list[str], version: list[str], buckets: int = DEFAULT_BUCKETS,
               deleted: Column | str | None = None, days: str | None = None) -> None:
    """Write the initial copy (one row per key) as the first state."""
    _merge(spark, initial, root, name, key, version, buckets, deleted, days)


def apply_stream(spark: SparkSession, changes: DataFrame, root: str, name: str,
                 key: list[str], version: list[str], checkpoint: str,
                 available_now: bool = True, buckets: int = DEFAULT_BUCKETS,
                 deleted: Column | str | None = None, days: str | None = None) -> StreamingQuery:
    """Run the change feed into the stored state with ``foreachBatch``."""

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        _merge(batch.sparkSession, batch, root, name, key, version, buckets, deleted, days)

    writer = changes.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
