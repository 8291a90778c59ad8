"""Line deduplication over levelled sorted runs (operator 12).

The corpus comes in batches.  A batch's line keys are hashed and counted (in how
many documents each is found); the counts are merge-anti-joined against the runs
written before, which drops hashes that a run already knows as frequent, and what
is left is written as a new run.  A run is a bucketed table sorted by hash, so the
anti join and the compaction read runs bucket by bucket without a shuffle.  When a
level has ``fanout`` runs they are summed into one run of the next level.  At the
end the runs are summed and the hashes of ``min_docs`` documents or more are the
frequent lines; all their occurrences go from every document.

Everything is DataFrame code.  A hash is 128 bits (two xxhash64 of unlike seeds).
A hot line meets a partial count in every task before it is shuffled; the join of
the lines with the frequent hashes is an ordinary join, which AQE splits where a
hash is hot.  Positions of frequent lines are collected per document: bounded by
the document's own lines.

Defined results: null or empty text is one empty line; an empty key is never
frequent.  A document is a row: repeated rows count one by one.  A repeated line
counts once in its document.  An empty table gives no rows.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsflow.llm import common
from claimsflow.session import ensure_checkpoint_dir

MIN_DOCS = 10
#: Parts that the corpus is dealt into, as if it came in so many deliveries.
BATCHES = 4
#: Runs of a level that are compacted into one of the next level.
FANOUT = 2
SPACE = " \t\n\x0b\x0c\r"


def split_lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(text):
    """The lines stripped at both ends, with A-Z lower-cased."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.transform(F.split(low, "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)))


def _hash(column, name: str) -> list:
    return [F.xxhash64(column).alias(f"{name}1"), F.xxhash64(F.lit(1), column).alias(f"{name}2")]


class LineRuns:
    """Runs of ``(h1, h2, n)``: line hashes and the documents that hold them."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        # As many buckets as the deployment sized its shuffles for.
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.made = 0

    def _write(self, counts: DataFrame) -> str:
        table = f"{self.name}_{self.made}"
        self.made += 1
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/{self.name}/{table}"
        (counts.repartition(self.buckets, "h1", "h2").write.option("path", path)
         .bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").format("parquet").saveAsTable(table))
        common.remove_at_end(self.spark, path)
        return table

    def _summed(self, tables: list[str]) -> DataFrame:
        """The runs merged: a hash is once in each, so a full merge join sums it.
        (A union of bucketed tables keeps their bucketing in Spark 4.1's plan but
        not in its rows, so a sum over one is wrong.)"""
        merged = self.spark.table(tables[0])
        for t in tables[1:]:
            more = self.spark.table(t).withColumnRenamed("n", "_more").hint("merge")
            merged = merged.join(more, ["h1", "h2"], "full").select(
                "h1", "h2", (F.coalesce("n", F.lit(0)) + F.coalesce("_more", F.lit(0))).alias("n"))
        return merged

    def add(self, lines: DataFrame) -> None:
        """``lines``: ``h1, h2`` of the distinct lines of each document of a batch."""
        own = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"))
        for table in self.tables():
            known = self.spark.table(table).where(F.col("n") >= self.min_docs).select("h1", "h2")
            own = own.join(known.hint("merge"), ["h1", "h2"], "left_anti")
        self._push(0, self._write(own))

    def _push(self, level: int, table: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(table)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            merged = self._write(self._summed(full))
            self._drop(full)
            self._push(level + 1, merged)

    def tables(self) -> list[str]:
        return [t for level in reversed(self.levels) for t in level]

    def _drop(self, tables: list[str]) -> None:
        for t in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")

    def frequent(self) -> DataFrame:
        """Hashes found in ``min_docs`` documents or more, stored; the runs go."""
        if not self.tables():
            return self.spark.createDataFrame([], "h1 long, h2 long")
        found = self._summed(self.tables()).where(F.col("n") >= self.min_docs).select("h1", "h2")
        found = common.stored(found, "frequent_lines")
        self._drop(self.tables())
        self.levels = []
        return found


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Hashes of the lines found in ``min_docs`` documents or more of ``docs``."""
    # What is computed from a whole text is computed before its lines become rows.
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(batches)).alias("batch"), "text")
    keys = dealt.select("batch", F.explode(F.array_distinct(line_keys(F.col("text")))).alias("key")).where("key <> ''")
    lines = common.stored(keys.select("batch", *_hash(F.col("key"), "h")), "line_hashes", "batch")
    runs = LineRuns(docs.sparkSession, min_docs, fanout)
    for k in range(batches):
        runs.add(lines.where(F.col("batch") == k))
    return runs.frequent()


def drop_frequent(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept``, the text without the
    lines found in ``min_docs`` documents or more."""
    own = ["_d", "_t1", "_t2"]
    gone = frequent_lines(docs.select("doc_id", "text"), min_docs, batches, fanout)
    identity = [F.col("doc_id").alias("_d"), *_hash(F.coalesce("text", F.lit("")), "_t")]
    lines = docs.select(*identity, "text").select(*own, F.posexplode(line_keys(F.col("text"))).alias("_p", "_key")).where("_key <> ''")
    hits = lines.select(*own, "_p", *_hash(F.col("_key"), "h")).join(gone, ["h1", "h2"])
    # Rows of one id and text have the same positions, so they may share a set.
    hits = hits.groupBy(*own).agg(F.collect_set("_p").alias("_gone"))
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    left = docs.select(row, *identity)
    same = left["_d"].eqNullSafe(hits["_d"]) & (left["_t1"] == hits["_t1"]) & (left["_t2"] == hits["_t2"])
    joined = left.join(hits, same, "left").select("_row", split_lines(F.col("_row.text")).alias("_lines"), "_gone")
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.array_join(F.transform(stay, lambda p: F.get(F.col("_lines"), p)), "\n")
    return joined.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped", "kept")],
                         F.size("_lines").cast("long").alias("n_lines"),
                         F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
                         F.when(F.col("_gone").isNull(), F.coalesce(F.col("_row.text"), F.lit(""))).otherwise(kept).alias("kept"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return drop_frequent(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP12_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, r, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= {MIN_DOCS})
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY r, doc_id
"""
