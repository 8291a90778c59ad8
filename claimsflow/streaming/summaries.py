"""Daily table summaries from streams (STM-2, stream form).

The rows of several tables come in as streams; one stateful aggregation keeps, for
every table and day, how many rows were created and how many updated.  The state
has one entry a table and day, whatever the number of rows, so it needs no
watermark: late rows count on their day, and no day waits for a later one to be
closed.  In update mode every micro-batch emits the days it changed with their
totals so far.  The sink keeps the newest totals of each day in a stored table
that is replaced as a whole after each batch; a replayed batch writes the same
totals again.

:func:`table_summaries` turns the stored days into summaries.  Once the input has
ended (``availableNow``, or a stopped query) they equal the batch form
(``operators.reconcile.daily_summaries``), the last days and the update counts
included.  While rows still come, days before :func:`closed_before` have only late
rows to fear.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimsflow.operators import reconcile
from claimsflow.sinks import store
from claimsflow.sources import layouts

DAYS = "table_days"
SHUFFLES = "spark.sql.shuffle.partitions"
STATE_STORES = 8


def created_per_day(stream: DataFrame, ts_col: str = "created_on", delay: str = "1 day") -> DataFrame:
    """Rows per event-time day, emitted once the watermark passes the day."""
    return (stream.withWatermark(ts_col, delay)
            .groupBy(F.window(ts_col, "1 day").alias("w"))
            .agg(F.count(F.lit(1)).alias("created"))
            .select(F.to_date(F.col("w.start")).alias("day"), "created"))


def table_streams(spark: SparkSession, root: str, schemas: Mapping, files_per_batch: int | None = None) -> dict[str, DataFrame]:
    """A stream for each table of a snapshot folder that is being written."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return {name: reader.schema(schema).parquet(f"{root}/{name}") for name, schema in schemas.items()}


def files_a_batch(spark: SparkSession, root: str, names: Iterable[str], batches: int) -> int:
    """How many files of each table of the folder a batch takes, so that all that is
    there comes in over about ``batches`` batches: their number does not grow with
    the tables, each takes more."""
    most = max(len(layouts.data_files(spark, f"{root}/{n}")) for n in names)
    return max(1, -(-most // batches))


def start(streams: Mapping[str, DataFrame], root: str, checkpoint: str, schema: str = "claims", available_now: bool = True,
          name: str = DAYS) -> StreamingQuery:
    """Keep the day totals of all ``streams`` (table name -> rows) under ``root``."""
    marks = functools.reduce(DataFrame.unionByName, [reconcile.day_marks(df, f"{schema}.{n}") for n, df in streams.items()])

    spark = next(iter(streams.values())).sparkSession

    def keep(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        # Both sides have a row a table and day; the totals are read twice only where state exists.
        if store.pointed(spark, f"{root}/{name}") is not None:
            changed = batch.select("table_name", "day")
            before = store.current(spark, root, name)
            batch = before.join(changed, ["table_name", "day"], "left_anti").unionByName(batch)
        store.refresh(spark, batch, root, name)

    writer = reconcile.day_totals(marks).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    # The state is a row a table and day: its stores are few, whatever the shuffles of
    # the rows need (a query keeps the number it is started with).
    before = spark.conf.get(SHUFFLES)
    spark.conf.set(SHUFFLES, str(min(int(before), STATE_STORES)))
    try:
        return writer.start()
    finally:
        spark.conf.set(SHUFFLES, before)


def table_summaries(spark: SparkSession, root: str, name: str = DAYS) -> DataFrame:
    """The summaries that the totals stored so far give."""
    return reconcile.running_summaries(store.current(spark, root, name))


def closed_before(spark: SparkSession, root: str, name: str = DAYS) -> DataFrame:
    """``table_name, open_day``: the last day each table has rows of; the days
    before it are closed but for late rows."""
    return store.current(spark, root, name).groupBy("table_name").agg(F.max("day").alias("open_day"))
