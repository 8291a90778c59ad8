"""Spelling variants by permuterm rotations (operator 13).

A word is marked with a terminator and all its rotations are sorted.  The rotation
that starts behind character ``c`` of ``x c y`` is ``y$x c``: it sorts into the
range of the prefix ``y$x``, which skips the edited character.  All words that
differ by a replacement there share the prefix with a last character of their
own, and the word ``xy`` (``c`` deleted) has the prefix as a whole rotation.  So a
scan over the sorted groups of one prefix sees every pair of near words once; a
deletion inside a run of equal characters is told apart by taking the run's first.

A group holds at most one word a character of the alphabet and the word without
it (under 100), so no group grows with the corpus.  The scan gives each member
the number of its neighbours and the best of them, not the pairs (``pairs=True``
of :func:`neighbours` emits them).  Words are counted with a partial sum in every
task, so a hot word is no hot key; forms are followed by pointer doubling.

Rotations of a word take the square of its length, so words of over ``LONG``
letters (junk, as a rule) have them as hashes of the letters before and behind the
terminator, which fall into the same groups and cost the same for every letter.

Defined results: null text has no words, a null id is written as empty text.  Rows
are counted one by one.  Ties of the largest count go to the smallest word in
code-point order.  No words give an empty table.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimsflow.llm import common

MIN_LENGTH = 6
MIN_COUNT = 5
#: A form is met at least so many times as often as the word.
RATIO = 5
TYPO_DIVISOR = 199
#: Marks the end of a word; no letter, and below all letters.
END = "$"
#: Letters up to which rotations are sorted as texts; longer ones by their hashes.
LONG = 64
ROWS_AT_ONCE = 20_000


def words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, typos: int | None = TYPO_DIVISOR) -> DataFrame:
    """``word, n``: letter runs (A-Z lower-cased) of ``min_length`` or more and
    ``min_count`` occurrences or more.  ``typos``: where the crc32 of id and run is
    divisible by it, the run loses a letter."""
    low = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    # Shorter runs cannot become words, so the pattern skips them whole.
    runs = F.regexp_extract_all(low, F.lit(f"[a-zÀ-ÿ]{{{min_length},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text").select("id", F.explode(runs).alias("word"))
    if typos:
        rows = rows.select("word", F.crc32(F.concat("id", F.lit(":"), "word").cast("binary")).alias("h"))
        at = (F.col("h") % F.char_length("word")).cast("int")
        cut = F.concat(F.substring(F.col("word"), F.lit(1), at), F.substring(F.col("word"), at + 2, F.char_length("word")))
        rows = rows.select(F.when(F.col("h") % typos == 0, cut).otherwise(F.col("word")).alias("word"))
    counted = rows.groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.char_length("word") >= min_length) & (F.col("n") >= min_count))


def named(vocabulary: DataFrame) -> DataFrame:
    """``word, n, w``, stored: ``w`` is a short name that sorts like the word, so
    that the rotations of a very long word do not carry it along: its first
    ``LONG`` letters, and for longer words a number in word order."""
    size = F.char_length("word")
    long = vocabulary.where(size > LONG).repartitionByRange("word").sortWithinPartitions("word")
    numbers = F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")
    rows = [vocabulary.where(size <= LONG).select("word", "n", F.lit("").alias("id")), long.select("word", "n", numbers.alias("id"))]
    rows = rows[0].unionByName(rows[1])
    return common.stored(rows.select("word", "n", F.struct(F.substring("word", 1, LONG).alias("word"), "id").alias("w")), "variant_names")


def rotations(names: DataFrame) -> DataFrame:
    """``key, w, n, whole, first``: every rotation of the marked words as a
    whole, and without its last character (``whole`` false; ``first``: that
    character does not repeat the one before it).  Keys of over ``LONG`` letters
    are two hashes, of the letters before and behind the terminator."""
    size = F.char_length("word")
    rows = names.where(size <= LONG + 1).select("word", "n", "w", F.explode(F.sequence(F.lit(0), size)).alias("i"))
    marked = F.concat("word", F.lit(END))
    rows = rows.select("word", "n", "w", "i", F.substring(F.concat(marked, marked), F.col("i") + 1, size + 1).alias("rotation"))
    before = F.substring(F.col("word"), F.col("i") - 1, F.lit(1))
    skipped = F.substring(F.col("word"), F.col("i"), F.lit(1))
    whole = F.struct(F.col("rotation").alias("key"), F.lit(True).alias("whole"), F.lit(False).alias("first"))
    edited = F.struct(F.substring(F.col("rotation"), F.lit(1), size).alias("key"), F.lit(False).alias("whole"),
                      ((F.col("i") == 1) | (before != skipped)).alias("first"))
    # The rotation by 0 ends with the terminator, which is no edit.
    both = F.concat(F.when(size <= LONG, F.array(whole)).otherwise(F.array()), F.when(F.col("i") > 0, F.array(edited)).otherwise(F.array()))
    short = rows.select("n", "w", F.explode(both).alias("e")).select("e.key", "w", "n", "e.whole", "e.first")
    long = LONG
    hashed = names.where(size > long).select("word", "w", "n").mapInArrow(lambda batches: _hashed_rotations(batches, long), short.schema)
    return short.unionByName(hashed)


def _hashed_rotations(batches: Iterator[pa.RecordBatch], long: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for word, w, n in zip(*(batch.column(c).to_pylist() for c in ("word", "w", "n")), strict=True):
            data, size = np.frombuffer(word.encode("utf-32-le"), np.uint8), len(word)
            at = 4 * np.arange(size + 1)
            first = np.array([True, *(a != b for a, b in zip(word, word[1:], strict=False))])
            head, tail = (common.run_hashes(data, at * k, at * k + (at if not k else 4 * size - at)) for k in (0, 1))
            kinds = [(head, tail, True, np.zeros(size + 1, bool))]
            if size > long + 1:
                kinds.append((head[:-1], tail[1:], False, first))
            for x, y, whole, firsts in kinds:
                for k in range(0, len(x), ROWS_AT_ONCE):
                    keys = [f"{a:016x}{b:016x}" for a, b in zip(x[k:k + ROWS_AT_ONCE].tolist(), y[k:k + ROWS_AT_ONCE].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys), pa.array([w] * len(keys), batch.column("w").type), pa.array([n] * len(keys), pa.int64()),
                         pa.array([whole] * len(keys)), pa.array(firsts[k:k + ROWS_AT_ONCE])], names=["key", "w", "n", "whole", "first"])


def neighbours(names: DataFrame, pairs: bool = False) -> DataFrame:
    """``w, n_near, best, best_n`` of the words (:func:`named`) that have a near
    word; with ``pairs`` the rows ``w, near`` instead, both ways."""
    rows = rotations(names).repartitionByRange("key")
    group = Window.partitionBy("key").orderBy(F.desc("n"), "w").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if pairs:
        member = F.struct("w", "whole", "first")
        rows = rows.withColumn("others", F.collect_list(member).over(group)).select("w", "whole", "first", F.explode("others").alias("other"))
        replaced = ~F.col("whole") & ~F.col("other.whole") & (F.col("w") != F.col("other.w"))
        inserted = (F.col("whole") & F.col("other.first")) | (F.col("other.whole") & F.col("first"))
        return rows.where(replaced | inserted).select("w", F.col("other.w").alias("near"))
    edited = F.count_if(~F.col("whole")).over(group)
    whole = F.count_if("whole").over(group)
    firsts = F.count_if("first").over(group)
    near = F.struct("n", "w")
    seen = rows.select("w", F.when(F.col("whole"), firsts).otherwise(edited - 1 + F.when(F.col("first"), whole).otherwise(0)).alias("near"),
                       F.first(near).over(group).alias("one"), F.nth_value(near, 2).over(group).alias("two"))
    seen = seen.where("two IS NOT NULL").select(
        "w", "near", F.when(F.col("one.w") == F.col("w"), F.col("two")).otherwise(F.col("one")).alias("best"))
    seen = seen.groupBy("w").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best.n")).alias("minus"), F.col("best.w").alias("w"))).alias("best"))
    return seen.select("w", "n_near", F.col("best.w").alias("best"), (-F.col("best.minus")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form`` (no nulls, no cycles): the last form of
    each chain.  Every round doubles the steps taken; counts grow by ``RATIO`` or
    more with each form, so chains are short."""
    at = common.stored(forms.select("word", F.col("form").alias("root")), "variant_roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = at.join(ahead, "root", "left")
        at = common.stored(moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "variant_roots")
        going = at.where("moved").limit(1).count()
        at = at.drop("moved")
        if not going:
            return at


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
             typos: int | None = TYPO_DIVISOR) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``docs``."""
    vocabulary = common.stored(words(docs, min_length, min_count, typos), "variant_words")
    names = named(vocabulary)
    longer = names.where("w.id <> ''").select(F.col("w").alias("best"), F.col("word").alias("long_word"))
    takes = F.col("best_n") >= ratio * F.col("n")
    found = names.join(neighbours(names), "w", "left").join(longer, "best", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.coalesce("long_word", "best.word")).alias("form"), F.when(takes, F.col("best_n")).alias("form_n"))
    found = common.stored(found, "variant_forms")
    last = roots(found.where("form IS NOT NULL"))
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(common.table(spark, sf_dir, "documents").select("doc_id", "text"))


# The crc32 of a text, byte by byte over the table of its polynomial.
OP13_SQL = f"""
WITH RECURSIVE steps AS (SELECT i, i AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM steps WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS tab FROM steps WHERE k = 8),
runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS id,
                unnest(regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[a-zÀ-ÿ]+')) AS run
         FROM documents),
once AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL),
coded AS (SELECT run, n, hex(encode(id || ':' || run)) AS x FROM once),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(
             list_prepend(4294967295, list_transform(range(length(x) // 2), lambda j: ('0x' || x[2 * j + 1:2 * j + 2])::BIGINT)),
             lambda c, b: xor(c // 256, tab[xor(c & 255, b) + 1]))) AS h FROM coded, crc),
cut AS (SELECT CASE WHEN h % {TYPO_DIVISOR} = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed),
w AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
gap AS MATERIALIZED (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
cuts AS MATERIALIZED (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM gap),
pairs AS (SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN w b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {RATIO} * w.n THEN near END AS form,
                          CASE WHEN near_n >= {RATIO} * w.n THEN near_n END AS form_n FROM w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root, 0 AS k FROM f UNION ALL SELECT c.word, f.form, k + 1 FROM chain c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, form, (SELECT last(root ORDER BY k) FROM chain c WHERE c.word = f.word) AS root, n, n_near, form_n FROM f
"""
