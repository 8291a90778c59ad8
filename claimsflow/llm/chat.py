"""Chat formatting by multi-party perspective rotation (operator 4).

For every participant of a conversation the dialogue is rendered once more, with
that speaker as the assistant and the others as named users; the mask gives the
character ranges the assistant wrote (text and end mark), which a trainer puts
loss on.  DataFrame functions only.

The turns of a conversation are numbered in order, whatever numbers they came with,
and cut into consecutive parts of ``PART_TURNS``, one row each, so that no row and
no task has to hold a long one whole.  The numbering is a range-partitioned sort:
turns are numbered within each range and moved on by those in the ranges before, so
a hot conversation is spread over many tasks.  Offsets are in the part; ``place`` is
the number of its first turn.  ``part_turns=None`` renders every conversation whole,
one row a participant, for conversations that fit a row.

Defined results: equal rows (conversation, turn, role and text) are one turn; turns
with one number are ordered by role, then text, a null number comes first.  A
null role is the speaker ``unknown``, a null text is empty.  ``system`` turns are
rendered as such and have no perspective of their own; a conversation of system
turns only has no rows.  Null ids are one conversation.  ``<|`` in a text or name
is written ``<\\|``, so that texts cannot forge marks.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimsflow.llm import common

PART_TURNS = 256
SYSTEM = "system"
END = "<|end|>\n"


def turns(conversations: DataFrame) -> DataFrame:
    escape = lambda c: F.replace(c, F.lit("<|"), F.lit("<\\|"))
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"),
                                escape(F.coalesce("role", F.lit("unknown"))).alias("speaker"),
                                escape(F.coalesce("text", F.lit(""))).alias("text")).distinct()


def numbered(said: DataFrame) -> DataFrame:
    """``said`` with ``n``, the place of each turn in its conversation from 0."""
    order = [F.col("turn").asc_nulls_first(), F.col("speaker").asc(), F.col("text").asc()]
    ranged = said.repartitionByRange(F.col("conv_id").asc_nulls_first(), *order).withColumn("range", F.spark_partition_id())
    ranged = common.stored(ranged, "turn_ranges")
    ahead = Window.partitionBy("c").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(F.col("conv_id").alias("c"), F.col("range").alias("r")).agg(F.count("*").alias("size"))
    before = sizes.select("c", "r", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("conv_id", "range").orderBy(*order))
    placed = ranged.withColumn("inside", inside).join(before, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("range") == F.col("r")))
    return placed.select("conv_id", "speaker", "text", (F.col("before") + F.col("inside") - 1).alias("n"))


def parts(said: DataFrame, part_turns: int | None = PART_TURNS) -> DataFrame:
    """``conv_id, part, place, turns``: ``part_turns`` turns a row, the last of a
    conversation fewer."""
    part = F.floor(F.col("n") / part_turns) if part_turns else F.lit(0).cast("long")
    return (numbered(said).groupBy("conv_id", part.alias("part"))
            .agg(F.min("n").alias("place"), F.array_sort(F.collect_list(F.struct("n", "speaker", "text"))).alias("turns"))
            .select("conv_id", "part", "place", "turns"))


def header(speaker: Column, perspective: Column) -> Column:
    return (F.when(speaker == perspective, F.lit("<|assistant|>\n")).when(speaker == SYSTEM, F.lit("<|system|>\n"))
            .otherwise(F.concat(F.lit("<|user name="), speaker, F.lit("|>\n"))))


def rotate(conversations: DataFrame, part_turns: int | None = PART_TURNS) -> DataFrame:
    """``conv_id, perspective, part, place, n_turns, rendered, mask``; ``mask``
    is an array of (start, end) in code points, end exclusive."""
    said = turns(conversations)
    people = said.where(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("speaker").alias("perspective")).distinct()
    rows = parts(said, part_turns).join(people, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    who = F.col("perspective")
    rendered = F.array_join(F.transform("turns", lambda t: F.concat(header(t["speaker"], who), t["text"], F.lit(END))), "")
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc, t):
        start = acc["at"] + F.length(header(t["speaker"], who))
        end = start + F.length(t["text"]) + F.lit(len(END))
        span = F.struct(start.alias("start"), end.alias("end"))
        spans = F.when(t["speaker"] == who, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return rows.select("conv_id", "perspective", "part", "place", F.size("turns").alias("n_turns"), rendered.alias("rendered"),
                       F.aggregate("turns", empty, step)["spans"].alias("mask"))


def op4_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rotate(common.table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("mask", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return rows.select("conv_id", "perspective", "part", "place", F.col("n_turns").cast("long").alias("n_turns"), "rendered", spans.alias("mask"))


OP4_SQL = """
WITH said AS (
  SELECT DISTINCT conv_id, CAST(turn AS BIGINT) AS turn, replace(coalesce(role, 'unknown'), '<|', '<\\|') AS speaker,
         replace(coalesce(text, ''), '<|', '<\\|') AS text FROM conversations),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, text) - 1 AS n FROM said),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
lines AS (
  SELECT o.conv_id, p.perspective, CAST(o.n // 256 AS BIGINT) AS part, o.n, o.speaker = p.perspective AS own, o.text,
         CASE WHEN o.speaker = p.perspective THEN '<|assistant|>' || chr(10) WHEN o.speaker = 'system' THEN '<|system|>' || chr(10)
              ELSE '<|user name=' || o.speaker || '|>' || chr(10) END AS head
  FROM ordered o JOIN people p ON o.conv_id IS NOT DISTINCT FROM p.conv_id),
measured AS (
  SELECT *, sum(length(head) + length(text) + 8) OVER (PARTITION BY conv_id, perspective, part ORDER BY n) AS stop FROM lines)
SELECT conv_id, perspective, part, CAST(min(n) AS BIGINT) AS place, count(*) AS n_turns,
       string_agg(head || text || '<|end|>' || chr(10), '' ORDER BY n) AS rendered,
       coalesce(string_agg(CAST(CAST(stop - length(text) - 8 AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(stop AS BIGINT) AS VARCHAR), ',' ORDER BY n)
                FILTER (WHERE own), '') AS mask
FROM measured GROUP BY conv_id, perspective, part
"""
