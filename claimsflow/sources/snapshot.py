"""Read (and write) the replicated claims tables under their fixed schemas (SRC-1).

A snapshot is a folder with one parquet table per claims table.  Reading
checks the columns of every file first (footers only, no data read): a missing
or unexpected column is an error, because a silently different layout would give
silently wrong reports.  Files written under an older layout are brought to the
final schema (``sources.layouts``).
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsflow.schemas import COUNTED_TABLES, REPORT_TABLES
from claimsflow.sources.layouts import SchemaMismatch, read_mixed

__all__ = ["SchemaMismatch", "ingest_summary", "names_to_check", "read_table", "read_tables", "write_snapshot"]


def write_snapshot(tables: dict[str, DataFrame], root: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/{name}")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_mixed(spark, f"{root}/{name}", name)


def read_tables(spark: SparkSession, root: str, names=REPORT_TABLES) -> dict[str, DataFrame]:
    return {n: read_table(spark, root, n) for n in names}


def names_to_check(spark: SparkSession, root: str) -> tuple[str, ...]:
    """The report tables, and the other tables that the snapshot holds."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    held = [n for n in COUNTED_TABLES if (p := path(f"{root}/{n}")).getFileSystem(conf).exists(p)]
    return (*REPORT_TABLES, *held)


def ingest_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table, one aggregation per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(n).alias("table_name"), "row_count", F.lit(len(df.columns)).cast("bigint")
                     .alias("column_count"))
             for n, df in tables.items()]
    return functools.reduce(DataFrame.unionByName, parts)
