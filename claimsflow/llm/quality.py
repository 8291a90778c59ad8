"""Quality rules with risk-controlled thresholds (operator 7).

Each rule compares one text statistic with a cutoff and rejects above it.  The
cutoffs are not hand-set: labelled documents are a holdout, and for every
stratum and rule the cutoffs of a fixed grid are tested from the loosest to the
tightest, each by the exact binomial (Clopper-Pearson) upper bound on the
false-rejection rate against the rule's share of the allowed risk, up to the first
that is not shown to be safe.  The bounds hold together: within a rule the fixed
order needs no correction, the error probability is divided by the number of
(stratum, rule) orders that are still open (Holm: an order tested to its end hands
its part to the others), and the risk by the number of rules (union bound), so with
probability ``1 - delta`` no stratum loses more than ``risk`` of its good documents
to the chosen rules.

Defined results: null or empty text has no words, so its statistics are 0 and
the base rule rejects it.  A null or unlisted stratum value is stratum
``other``.  A stratum without enough labels gets no cutoffs (nothing beyond
the base rule is rejected).  Repeated rows are judged one by one; repeated label
rows count once; labels that contradict each other for one id are left out.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsflow.llm import common

#: Characters counted as symbols (fixed by the task).
SYMBOLS = "#*$%&|<>"
STAT_NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
STRATA = ("de", "en", "es", "fr")
RISK = 0.05
DELTA = 0.05
#: Cutoffs tried for each rule: the same grid of shares for all of them.
GRID = tuple(round(x, 3) for x in (0.01, 0.02, 0.03, 0.05, 0.075, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9))


def repeated_positions(ids: np.ndarray, n: int = 8) -> int:
    """How many positions lie in a window of ``n`` items that occurs twice or
    more.  Exact: windows are numbered by doubling (pairs of numbered halves),
    not hashed."""
    if len(ids) <= n:
        return 0
    level, width = ids.astype(np.int64), 1
    while width < n:  # n is a power of two
        left, right = level[:-width], level[width:]
        level = np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1]
        width *= 2
    hit = np.bincount(level)[level] > 1
    if not hit.any():
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """The statistics in ``STAT_NAMES`` of one whole text."""
    if not text:
        return (0,) * len(STAT_NAMES)
    raw = text.encode()
    words = raw.split()
    number = defaultdict(itertools.count().__next__)
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    blanks = sum(text.count(c) for c in " \t\n\v\f\r")
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    return (len(words), len(text) - blanks, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)),
            repeated_positions(ids), len(lines), len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
            raw.count(b"!") + raw.count(b"?"))


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [text_stats(t) for t in batch.column("text").to_pylist()]
        columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(STAT_NAMES))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("stratum"), *columns],
                                         names=["doc_id", "stratum", *STAT_NAMES])


def statistics(docs: DataFrame, stratum: str = "lang", strata: tuple[str, ...] = STRATA) -> DataFrame:
    """``doc_id``, the stratum and the statistics of every row of ``docs``."""
    common.small_batches(docs.sparkSession)
    level = F.when(F.col(stratum).isin(*strata), F.col(stratum)).otherwise(F.lit("other"))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), level.alias("stratum"), "text")
    schema = "doc_id long, stratum string, " + ", ".join(f"{n} long" for n in STAT_NAMES)
    return slim.mapInArrow(_stats, schema)


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.col(part) / F.nullif(F.col(whole), F.lit(0)).cast("double"), F.lit(0.0))


def rules() -> dict[str, Column]:
    """Rule name -> the statistic it bounds, a share between 0 and 1."""
    return {
        "symbols": _share("n_symbols", "word_chars"),
        "repeated_lines": _share("n_dup_lines", "n_lines"),
        "repeated_words": _share("n_repeat_words", "n_words"),
        "capitals": _share("n_upper", "word_chars"),
        "marks": _share("n_marks", "word_chars"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= k)."""
    logs = [math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p)
            for j in range(min(k, n) + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def clean_labels(labels: DataFrame) -> DataFrame:
    """One row per labelled id; ids whose rows disagree are left out."""
    return (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
            .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.min("quality").alias("quality"), F.max("quality").alias("_max"))
            .where("quality = _max").drop("_max"))


def choose_cutoffs(counts: list[tuple[str, str, int, int, int]], n_strata: int, n_rules: int, risk: float = RISK,
                   delta: float = DELTA, grid: tuple[float, ...] = GRID) -> dict[tuple[str, str], float]:
    """Cutoffs from ``(stratum, rule, bin, quality, documents)`` rows, where
    ``bin`` is how many grid cutoffs the statistic exceeds.

    The hypothesis "this cutoff rejects more than ``risk / n_rules`` of the
    good documents" is tested with the exact binomial tail, loosest cutoff first,
    at level ``delta`` by the number of open (stratum, rule) orders.  Of the
    cutoffs shown to be safe the tightest one wins that rejects more bad than good
    labelled documents; a rule without such a cutoff is not used."""
    share = risk / n_rules
    bins: dict[tuple[str, str], np.ndarray] = {}
    for stratum, rule, at, quality, n in counts:
        bins.setdefault((stratum, rule), np.zeros((2, len(grid) + 1), np.int64))[int(quality > 0), at] += n
    safe = dict.fromkeys(bins, len(grid))  # the first cutoff of the grid that is shown to be safe
    n_open, before = n_strata * n_rules, None  # strata and rules without labels stay open
    while n_open and n_open != before:
        before = n_open
        for key, (_, good) in bins.items():
            while safe[key] and binomial_cdf(int(good[safe[key]:].sum()), int(good.sum()), share) <= delta / before:
                safe[key] -= 1
        n_open = n_strata * n_rules - sum(at == 0 for at in safe.values())
    chosen = {}
    for key, (bad, good) in bins.items():
        for g in range(safe[key], len(grid)):
            if bad[g + 1:].sum() > good[g + 1:].sum():
                chosen[key] = grid[g]
                break
    return chosen


def fit(stats: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA,
        strata: tuple[str, ...] = STRATA) -> dict[tuple[str, str], float]:
    """Cutoffs by (stratum, rule).  Only counts reach the driver: one per
    stratum, rule, grid bin and label."""
    made = rules()
    bins = [F.struct(F.lit(name).alias("rule"),
                     sum((value > F.lit(c)).cast("int") for c in GRID).alias("bin")) for name, value in made.items()]
    judged = (stats.where(~base_failed()).join(clean_labels(labels), "doc_id")
              .select("stratum", "quality", F.explode(F.array(*bins)).alias("b"))
              .groupBy("stratum", "b.rule", "b.bin", "quality").count())
    return choose_cutoffs([tuple(r) for r in judged.collect()], len(strata) + 1, len(made), risk, delta)


def apply(stats: DataFrame, cutoffs: dict[tuple[str, str], float]) -> DataFrame:
    """Adds ``base_failed``, ``rejected_by`` (names of the rules that fire) and ``kept``."""
    fired = []
    for name, value in rules().items():
        over = [(F.col("stratum") == s) & (value > F.lit(c)) for (s, r), c in cutoffs.items() if r == name]
        fired.append(F.when(F.greatest(*over, F.lit(False)) if over else F.lit(False), F.lit(name)))
    out = stats.withColumn("base_failed", base_failed()).withColumn("rejected_by", F.array_compact(F.array(*fired)))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Statistics, verdict and reasons for every document."""
    stats = common.stored(statistics(docs), "quality_stats")
    return apply(stats, fit(stats, labels, risk, delta))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", "stratum", F.concat_ws(",", "rejected_by").alias("rejected_by"))
