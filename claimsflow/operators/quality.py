"""Table contract checks (DQ-1..4): what the database enforced, as jobs.

Each check is one aggregation or one anti join; none collects rows.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsflow.schemas import ADDED_DEFAULTS, RENAMES, SCHEMAS


def duplicate_keys(df: DataFrame, pk: tuple[str, ...]) -> DataFrame:
    """DQ-1: key values held by more than one row, with their row count."""
    return (df.groupBy(*pk).agg(F.count(F.lit(1)).alias("count"))
            .where(F.col("count") > 1))


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """DQ-2: child rows whose non-null foreign key has no parent row.  The keys are
    shuffled, never broadcast: the planner guesses the size of one column from the
    compressed files, many times too small."""
    keys = parent.select(F.col(pk).alias("_parent_key")).hint("merge")
    return (child.where(F.col(fk).isNotNull())
            .join(keys, F.col(fk) == F.col("_parent_key"), "left_anti"))


def null_counts(df: DataFrame, required: list[str]) -> DataFrame:
    """DQ-3: nulls per NOT NULL column, all columns in one pass."""
    if not required:
        return df.sparkSession.createDataFrame([], "column string, nulls bigint")
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    pairs = ", ".join(f"'{c}', `{c}`" for c in required)
    return agg.selectExpr(f"stack({len(required)}, {pairs}) as (column, nulls)")


def upgrade(df: DataFrame, table: str) -> DataFrame:
    """DQ-4: read a frame written under an older layout into the final schema:
    apply later renames, give added NOT NULL columns their default, add the
    other new columns as null, and cast to the final types."""
    for old, new in RENAMES.get(table, {}).items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    defaults = ADDED_DEFAULTS.get(table, {})
    cols = []
    for f in SCHEMAS[table].fields:
        if f.name in df.columns:
            c = F.col(f.name)
        elif f.name in defaults:
            c = F.lit(defaults[f.name])
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)
