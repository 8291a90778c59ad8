"""Mixing sources to target weights by iterative proportional fitting (operator 1).

Documents are counted into cells (source, language, topic) by their tokens.  The
cells' token weights are raked to target shares of each of the three margins in
turn until all hold to ``TOLERANCE``; a document is then drawn with the probability of its cell,
scaled so that the drawn tokens are expected to be ``RATE`` of all.  Probabilities
are cut at 1 and the rest is scaled up to keep the expected total.  DataFrame
functions; cells, not documents, take part in the iteration.  More than
``CELLS_A_TASK`` cells stay distributed, and only margins' errors and the scale reach
the driver; fewer are swept there, as hundreds of sweeps can be needed.

Targets that contradict the cells (or need over ``MAX_SWEEPS`` sweeps) cannot all be
met: ``margin_error`` of the result, the largest relative error of a margin's share
before it was last set, is then over ``TOLERANCE``.  The result is the one at which
the sweeps repeat: the last margin (topics) is met, the others are as near as raking
brings them; ``op1_source_mix`` returns it with its ``margin_error``.

Without given targets a margin's target shares are its token shares to the power
``TEMPER``, renormalised, which lifts small sources and languages.  Given targets
hold for the categories that have tokens, renormalised; a category that they leave
out has target 0, so none of its tokens are drawn.

Defined results: null source, language or topic is the category ``none``; null text
has no tokens and falls into its cell; cells without tokens keep factor 1.
Repeated rows have equal ids, so they are drawn together.  The draw depends only on
the id (md5), so retries agree.  An empty table gives an empty result.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsflow.llm import common

log = logging.getLogger(__name__)

MARGINS = ("source", "lang", "topic")
TEMPER = 0.5
RATE = 0.5
TOLERANCE = 1e-9
MAX_SWEEPS = 20_000
#: Sweeps written out in the SQL, whose rounded weights settle earlier on the given tables.
SQL_SWEEPS = 24
#: Cells that one task, or the driver, takes: the raking is spread over more tasks where there are more.
CELLS_A_TASK = 200_000
#: Sweeps that move no weight by this part of the tolerance only repeat.
STILL = 1e-3
GRID = 64
SALT = "mix:"


def topic_of(text: Column) -> Column:
    """A form topic from the whole text: tables, noise, notes or prose."""
    size = F.length(text)
    marks = size - F.length(F.translate(text, "#*$%&|<>", ""))
    return (F.when(F.instr(text, " | ") > 0, "table").when(marks * 20 > size, "noise").when(size < 600, "note").otherwise("prose"))


def counted(docs: DataFrame) -> DataFrame:
    """``doc_id, source, lang, topic, n_tokens`` of every document."""
    none = lambda c: F.coalesce(c, F.lit("none"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), none(F.col("source")).alias("source"), none(F.col("lang")).alias("lang"),
                       none(F.when(F.col("text").isNotNull(), topic_of(F.col("text")))).alias("topic"),
                       F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("n_tokens"))


def in_tasks(cells: DataFrame, name: str, tasks: int | None = None) -> tuple[DataFrame, int]:
    """``cells`` stored, and read by one task for each ``CELLS_A_TASK`` of them:
    a small table is summed without a shuffle, a large one is spread."""
    if tasks is None:
        tasks = max(1, -(-cells.count() // CELLS_A_TASK))
    return common.stored(cells.coalesce(tasks), name).coalesce(tasks), tasks


def tempered_targets(cells: DataFrame, margin: str, temper: float = TEMPER) -> DataFrame:
    """``margin, target`` shares, from the tokens of the margin's categories."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("t"))
    total = sums.agg(F.sum(F.pow("t", F.lit(temper)))).first()[0] or 1.0
    return sums.select(margin, (F.pow("t", F.lit(temper)) / F.lit(total)).alias("target"))


def met_targets(cells: DataFrame, margin: str, target: DataFrame) -> DataFrame:
    """Given targets over the categories that have tokens, renormalised; the
    categories that they leave out have target 0."""
    there = cells.groupBy(margin).agg(F.sum("tokens").alias("t")).select(margin)
    shares = there.join(target.select(margin, F.col("target").cast("double").alias("target")), margin, "left").fillna(0.0, ["target"])
    total = shares.agg(F.sum("target")).first()[0] or 1.0
    return shares.select(margin, (F.col("target") / F.lit(total)).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE, sweeps: int = MAX_SWEEPS,
         on_driver: int = CELLS_A_TASK) -> tuple[DataFrame, float]:
    """``cells`` (margins, ``tokens``) with ``w``: token weights that have the
    target shares in every margin, and the largest margin error of the last sweep.
    Where missing cells make that impossible, the weights stand at which the
    sweeps repeat: the last margin is met, the others are as near as raking
    brings them, and the error is over ``tolerance``.

    A step sums the weights by one margin and multiplies each cell by target over
    sum; a sweep takes every margin once and, on Spark, is written as a whole."""
    start = cells.where("tokens > 0").withColumns({"w": F.col("tokens").cast("double"), "moved": F.lit(0.0), "error": F.lit(0.0)})
    for m, target in targets.items():
        start = start.join(target.select(m, F.col("target").alias(f"t_{m}")), m)
    cells, tasks = in_tasks(start, "rake")
    total, n = cells.agg(F.sum("w"), F.count("*")).first()
    if n <= on_driver:
        cells, error = _raked_here(cells, [*targets], tolerance, sweeps)
    else:
        cells, error = _raked_on_spark(cells.withColumn("w", F.col("w") / F.lit(total)), [*targets], tolerance, sweeps, tasks)
    if error > tolerance:
        log.warning("the margins cannot all be met: relative error %g", error)
    return cells.drop("moved", "error", *[f"t_{m}" for m in targets]), error


def _raked_here(cells: DataFrame, margins: list[str], tolerance: float, sweeps: int) -> tuple[DataFrame, float]:
    """The sweeps in numpy, for a bounded number of cells."""
    table = cells.toArrow()
    w, error = table.column("w").to_numpy().copy(), 0.0
    w /= w.sum() or 1.0
    codes = {m: table.column(m).combine_chunks().dictionary_encode().indices.to_numpy() for m in margins}
    target = {}
    for m in margins:
        target[m] = np.zeros(codes[m].max(initial=-1) + 1)
        target[m][codes[m]] = table.column(f"t_{m}").to_numpy()
    for _ in range(sweeps if len(w) else 0):
        before, error = w, 0.0
        for m in margins:
            sums, t = np.bincount(codes[m], weights=w), target[m]
            error = max(error, (np.abs(sums - t) / np.where(t > 0, t, 1.0)).max())
            w = w * np.divide(t, sums, out=np.zeros_like(t), where=sums > 0)[codes[m]]
        moved = np.divide(w, before, out=np.ones_like(w), where=before > 0)
        if error <= tolerance or np.abs(moved - 1).max() <= tolerance * STILL:
            break
    table = table.set_column(table.column_names.index("w"), "w", pa.array(w))
    return cells.sparkSession.createDataFrame(table, cells.schema), float(error)


def _raked_on_spark(cells: DataFrame, margins: list[str], tolerance: float, sweeps: int, tasks: int) -> tuple[DataFrame, float]:
    error = 0.0
    for _ in range(sweeps):
        step = cells.withColumns({"before": F.col("w"), "error": F.lit(0.0)})
        for m in margins:
            t = F.col(f"t_{m}")
            step = step.join(step.groupBy(m).agg(F.sum("w").alias("s")), m)
            step = step.withColumn("error", F.greatest("error", F.abs(F.col("s") - t) / F.when(t > 0, t).otherwise(1.0)))
            step = step.withColumn("w", F.when(F.col("s") > 0, F.col("w") * t / F.col("s")).otherwise(0.0)).drop("s")
        moved = F.when(F.col("before") > 0, F.abs(F.col("w") / F.col("before") - 1)).otherwise(0.0)
        cells, _ = in_tasks(step.withColumn("moved", moved).drop("before"), "rake", tasks)
        error, still = (x or 0.0 for x in cells.agg(F.max("error"), F.max("moved")).first())
        if error <= tolerance or still <= tolerance * STILL:
            break
    return cells, error


def scale_for(cells: DataFrame, rate: float) -> float:
    """The scale s with sum(tokens * min(1, s * factor)) = rate * tokens, over
    cells with ``tokens`` and ``factor``: a few grid searches, then exactly."""
    s = cells.agg(F.sum("tokens").alias("n"), F.sum(F.col("tokens") * F.col("factor")).alias("w"), F.min(F.when(F.col("factor") > 0, F.col("factor"))).alias("low")).first()
    if not s.n or not s.w:
        return 0.0
    goal = rate * s.n
    low, high = goal / s.w, max(goal / s.w, 1.0 / s.low)
    for _ in range(6):
        if high <= low * (1 + 1e-12):
            break
        grid = [low * (high / low) ** (k / (GRID - 1)) for k in range(GRID)]
        drawn = cells.agg(*[F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("factor") * x)).alias(f"x{k}") for k, x in enumerate(grid)]).first()
        over = next((k for k in range(GRID) if drawn[k] >= goal), GRID - 1)
        low, high = grid[max(0, over - 1)], grid[over]
    capped = F.col("factor") * high >= 1
    t = cells.agg(F.sum(F.when(capped, F.col("tokens")).otherwise(0)).alias("full"),
                  F.sum(F.when(capped, 0.0).otherwise(F.col("tokens") * F.col("factor"))).alias("part")).first()
    return (goal - t.full) / t.part if t.part else high


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, rate: float = RATE) -> DataFrame:
    """Every document with its cell's ``weight`` (target over present token
    share), its ``probability``, whether it is ``sampled``, and the
    ``margin_error`` of the whole mix."""
    mixed, error = _mix(docs, targets, rate)
    return mixed.withColumn("margin_error", F.lit(error))


def _mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, rate: float = RATE) -> tuple[DataFrame, float]:
    rows = common.stored(counted(docs), "mix_rows")
    cells, tasks = in_tasks(common.stored(rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), "cells"), "mix_cells")
    full = cells.where("tokens > 0")
    targets = {m: tempered_targets(full, m) if targets is None else met_targets(full, m, targets[m]) for m in MARGINS}
    targets = {m: in_tasks(t, "targets", tasks)[0] for m, t in targets.items()}
    raked, error = rake(cells, targets)
    total = float(cells.agg(F.sum("tokens")).first()[0] or 1)
    factors, _ = in_tasks(raked.select(*MARGINS, "tokens", (F.col("w") * F.lit(total) / F.col("tokens")).alias("factor")), "mix_factors", tasks)
    scale = scale_for(factors, rate)
    out = rows.join(factors.drop("tokens"), [*MARGINS], "left")
    weight = F.coalesce("factor", F.lit(1.0))
    probability = F.least(F.lit(1.0), weight * F.lit(scale))
    return out.select("doc_id", *MARGINS, "n_tokens", weight.alias("weight"), probability.alias("probability"),
                      (common.md5_fraction(F.col("doc_id"), SALT) < probability).alias("sampled")), error


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(common.table(spark, sf_dir, "documents"))
    return mixed.withColumns({"weight": F.round("weight", 4), "probability": F.round("probability", 4), "margin_error": F.round("margin_error", 6)})


def _op1_sql(sweeps: int = SQL_SWEEPS) -> str:
    """The same in SQL: the sweeps written out, the scale by sorted totals."""
    steps, last = [], "w0"
    for k in range(sweeps):
        for m in MARGINS:
            name = f"w{k}_{m}"
            steps.append(f"{name} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.tokens, c.w * t.target / s.s AS w FROM {last} c "
                         f"JOIN (SELECT {m} AS m, sum(w) AS s FROM {last} GROUP BY 1) s ON c.{m} = s.m JOIN t_{m} t ON c.{m} = t.m)")
            last = name
    off = " UNION ALL ".join(f"SELECT abs(s.s / t.target - 1) AS e FROM (SELECT {m} AS m, sum(w) AS s FROM {last} GROUP BY 1) s JOIN t_{m} t ON s.m = t.m" for m in MARGINS)
    targets = ",\n".join(f"t_{m} AS MATERIALIZED (SELECT {m} AS m, sqrt(sum(tokens)) / (SELECT sum(sqrt(x)) FROM (SELECT sum(tokens) AS x FROM full_cells GROUP BY {m})) "
                         f"AS target FROM full_cells GROUP BY 1)" for m in MARGINS)
    return f"""
WITH doc_rows AS MATERIALIZED (
  SELECT doc_id, coalesce(source, 'none') AS source, coalesce(lang, 'none') AS lang,
         CASE WHEN text IS NULL THEN 'none' WHEN contains(text, ' | ') THEN 'table'
              WHEN (length(text) - length(translate(text, '#*$%&|<>', ''))) * 20 > length(text) THEN 'noise'
              WHEN length(text) < 600 THEN 'note' ELSE 'prose' END AS topic,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS n_tokens FROM documents),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens) AS tokens FROM doc_rows GROUP BY 1, 2, 3),
full_cells AS MATERIALIZED (SELECT * FROM cells WHERE tokens > 0),
total AS MATERIALIZED (SELECT CAST(sum(tokens) AS DOUBLE) AS n FROM cells),
{targets},
w0 AS MATERIALIZED (SELECT source, lang, topic, tokens, tokens / (SELECT n FROM total) AS w FROM full_cells),
{",".join(steps)},
factors AS MATERIALIZED (SELECT source, lang, topic, tokens, w * (SELECT n FROM total) / tokens AS factor FROM {last}),
sorted AS (SELECT *, coalesce(sum(tokens) OVER (ORDER BY factor DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above,
                  sum(tokens * factor) OVER (ORDER BY factor DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM factors),
scale AS (SELECT arg_max(s, factor) AS s FROM (SELECT ({RATE} * (SELECT n FROM total) - above) / rest AS s, factor FROM sorted) WHERE s * factor <= 1 AND s > 0),
final AS (SELECT r.*, coalesce(f.factor, 1.0) AS weight, least(1.0, coalesce(f.factor, 1.0) * (SELECT s FROM scale)) AS p
          FROM doc_rows r LEFT JOIN factors f ON r.source = f.source AND r.lang = f.lang AND r.topic = f.topic)
SELECT doc_id, source, lang, topic, CAST(n_tokens AS BIGINT) AS n_tokens, round(weight, 4) AS weight, round(p, 4) AS probability,
       CAST('0x' || substr(md5('{SALT}' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0 < p AS sampled,
       (SELECT round(coalesce(max(e), 0.0), 6) FROM ({off})) AS margin_error
FROM final
"""


OP1_SQL = _op1_sql()
