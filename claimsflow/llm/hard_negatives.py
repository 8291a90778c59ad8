"""Hard negatives by exact tiled products (operator 11).

Vectors are cut to integers, packed into tiles of rows and anchors (the query set:
ids divisible by 100) into smaller tiles.  Every candidate tile meets every anchor
tile; their int64 product is taken by Strassen's recursion, zero-padded to even
sizes, with integer additions only, so scores are exact.  The product itself is
never stored: each task keeps, for every anchor, a heap of its best same-label rows
and, in a second pass, one heap for the score window below each positive.  Heaps of
different tasks merge by taking the best rows of their union.

Anchors go through in groups of ``GROUP_BYTES`` of vectors at most; a group's tiles
are broadcast (that is their size bound) and the candidates are read in place, so
no candidate is shuffled.  A task holds one group's heaps.  Work is anchors x rows,
as the query set asks for; in the first pass tiles without a common label are
skipped.

Defined results: rows with a null id, label, vector or component, or with a
component that is not finite, take no part.  Shorter vectors are padded with zeros
(an empty vector scores 0).  Rows that share an id count one by one as candidates
but are never candidates of an anchor of that id; of anchors that share an id the
smallest (label, vector) stays.  Equal scores go by id.  Components so large that a
score could leave int64 raise an error.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimsflow.llm import common

SCALE = 256
ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 5
#: A negative has at least this share of its positive's score, and at most all of it.
LOW_SHARE, FULL_SHARE = 80, 100
TILE_ROWS = 1024
ANCHOR_TILE_ROWS = 256
#: Rows a task sorts by label before it cuts them into tiles.
BUFFER_ROWS = 8192
#: Bytes of anchor vectors that are broadcast at once.
GROUP_BYTES = 16 << 20
#: Sides of at most this size are multiplied directly.
LEAF = 16
#: Pairs of tiles in one Arrow batch.
PAIRS_A_BATCH = 16
NONE = np.iinfo(np.int64).min

TILE = "ids binary, labels binary, vectors binary, width int, reach long"
ROWS = "vec_id long, label int, vector array<double>"


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices with seven products a level."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    h, w, v = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :w], a[:h, w:], a[h:, :w], a[h:, w:]
    b11, b12, b21, b22 = b[:w, :v], b[:w, v:], b[w:, :v], b[w:, v:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * h, 2 * v), np.int64)
    out[:h, :v] = p1 + p4 - p5 + p7
    out[:h, v:] = p3 + p5
    out[h:, :v] = p2 + p4
    out[h:, v:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """The best ``depth`` (score, id) of each of ``n`` owners, mergeable."""

    def __init__(self, n: int, depth: int):
        self.scores = np.full((n, depth), NONE)
        self.ids = np.full((n, depth), np.iinfo(np.int64).max)

    def floor(self) -> np.ndarray:
        """The score below which nothing enters an owner's heap."""
        return self.scores[:, -1]

    def push(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(owner) == 0:
            return
        depth = self.scores.shape[1]
        touched, place = np.unique(owner, return_inverse=True)
        who = np.concatenate([np.repeat(np.arange(len(touched)), depth), place])
        s = np.concatenate([self.scores[touched].ravel(), score])
        i = np.concatenate([self.ids[touched].ravel(), ids])
        order = np.lexsort((i, ~s, who))
        rank = np.arange(len(order)) - np.searchsorted(who[order], who[order])
        best = order[rank < depth]
        self.scores[touched] = s[best].reshape(-1, depth)
        self.ids[touched] = i[best].reshape(-1, depth)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(owner, score, id) of all entries."""
        owner, place = np.nonzero(self.scores != NONE)
        return owner, self.scores[owner, place], self.ids[owner, place]


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~bad).select("vec_id", "label", "vector")


def _pack(ids: list, labels: list, vectors: list) -> tuple:
    width = max(map(len, vectors))
    packed = np.zeros((len(ids), width))
    for row, v in zip(packed, vectors, strict=True):
        row[:len(v)] = v
    reach = float(np.abs(packed).max()) if packed.size else 0.0
    if reach >= 2.0**31:
        raise ValueError(f"vector components up to {reach} are too large for exact scores")
    kind = np.int16 if reach < 2**15 else np.int32
    return (np.array(ids, np.int64).tobytes(), np.array(labels, np.int32).tobytes(), packed.astype(kind).tobytes(), width, int(reach))


def tiles(rows: DataFrame, size: int, extra: int = 0) -> DataFrame:
    """Tiles of up to ``size`` rows, near in label.  With ``extra`` rows have a
    column ``scores`` of at most that many longs, packed as ``scores``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush():
            held.sort(key=lambda r: (r[1], r[0]))
            for k in range(0, len(held), size):
                part = held[k:k + size]
                out = [*_pack([r[0] for r in part], [r[1] for r in part], [r[2] for r in part])]
                if extra:
                    limits = np.full((len(part), extra), NONE)
                    for row, r in zip(limits, part, strict=True):
                        row[:len(r[3])] = r[3]
                    out.append(limits.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(out, fields, strict=True)], schema=fields)
            held.clear()

        fields = pa.schema([("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary()), ("width", pa.int32()), ("reach", pa.int64()),
                            *([("scores", pa.binary())] if extra else [])])
        for batch in batches:
            vectors = batch.column("vector")
            values, ends = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
            cols = [batch.column(c).to_pylist() for c in batch.schema.names]
            cols[2] = [values[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            held += zip(*cols, strict=True)
            if len(held) >= BUFFER_ROWS:
                yield from flush()
        yield from flush()

    return rows.mapInArrow(cut, TILE + (", scores binary" if extra else ""))


class Tile:
    def __init__(self, ids, labels, vectors, width, reach, scores=None):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int32)
        kind = np.int16 if reach < 2**15 else np.int32
        self.vectors = np.frombuffer(vectors, kind).reshape(len(self.ids), width).astype(np.int64)
        self.reach = reach
        self.scores = None if scores is None else np.frombuffer(scores, np.int64).reshape(len(self.ids), -1)


def products(anchors: Tile, rows: Tile) -> np.ndarray:
    """Exact scores, anchors by rows."""
    width = max(anchors.vectors.shape[1], rows.vectors.shape[1], 1)
    if anchors.reach * rows.reach * width * FULL_SHARE >= 2**63:
        raise ValueError("vector components are too large for exact scores")
    wide = lambda x: np.pad(x, ((0, 0), (0, width - x.shape[1])))
    return strassen(wide(anchors.vectors), wide(rows.vectors).T)


def push_positives(heaps: Heaps, anchors: Tile, rows: Tile) -> None:
    """The rows of an anchor's label, but for those of its id."""
    if not np.isin(anchors.labels, rows.labels).any():
        return
    score = products(anchors, rows)
    fits = ((anchors.labels[:, None] == rows.labels) & (anchors.ids[:, None] != rows.ids) & (score >= heaps.floor()[:, None]))
    owner, place = np.nonzero(fits)
    heaps.push(owner, score[owner, place], rows.ids[place])


def push_negatives(heaps: Heaps, anchors: Tile, rows: Tile) -> None:
    """The rows of another label inside the window of each positive's score."""
    slots = anchors.scores.shape[1]
    score = products(anchors, rows)
    score[anchors.labels[:, None] == rows.labels] = NONE
    floor = heaps.floor().reshape(-1, slots)
    for k in range(slots):
        high = anchors.scores[:, k]
        known = high != NONE
        low = -((-LOW_SHARE * np.where(known, high, 0)) // FULL_SHARE)
        least = np.where(known, np.maximum(np.maximum(low, floor[:, k]), NONE + 1), np.iinfo(np.int64).max)
        owner, place = np.nonzero((score >= least[:, None]) & (score <= high[:, None]))
        heaps.push(owner * slots + k, score[owner, place], rows.ids[place])


def heaps_of(candidates: DataFrame, anchor_tiles: DataFrame, slots: int, depth: int) -> DataFrame:
    """``anchor_id, slot, score, vec_id``: what the heaps of all tasks hold.  One
    slot of same-label rows, or (``anchor_tiles`` with ``scores``) a slot a window."""
    windows = "scores" in anchor_tiles.columns
    names = [c.split()[0] for c in TILE.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, tuple[Tile, Heaps]] = {}
        rows, seen = None, None
        for batch in batches:
            for row in batch.to_pylist():
                own = [row["a_" + n] for n in names] + ([row["a_scores"]] if windows else [])
                if row["a_ids"] not in kept:
                    tile = Tile(*own)
                    kept[row["a_ids"]] = (tile, Heaps(len(tile.ids) * slots, depth))
                tile, heaps = kept[row["a_ids"]]
                if seen is None or seen[0] != row["ids"] or seen[1] != row["vectors"]:
                    seen, rows = (row["ids"], row["vectors"]), Tile(*[row[n] for n in names])
                (push_negatives if windows else push_positives)(heaps, tile, rows)
        for tile, heaps in kept.values():
            owner, score, ids = heaps.rows()
            yield pa.RecordBatch.from_arrays(
                [pa.array(tile.ids[owner // slots]), pa.array((owner % slots).astype(np.int32)), pa.array(score), pa.array(ids)],
                names=["anchor_id", "slot", "score", "vec_id"])

    group = anchor_tiles.select(*[F.col(c).alias(f"a_{c}") for c in anchor_tiles.columns], F.lit(1).alias("_one"))
    pairs = candidates.withColumn("_one", F.lit(1)).join(F.broadcast(group), "_one").drop("_one")
    return pairs.mapInArrow(work, "anchor_id long, slot int, score long, vec_id long")


def best_of(candidates: DataFrame, anchors: DataFrame, slots: int, depth: int, groups: int) -> DataFrame:
    """The merged heaps, stored: rank from 1 within anchor and slot."""
    extra = slots if "scores" in anchors.columns else 0
    parts = []
    for g in range(groups):
        own = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == g)
        parts.append(common.stored(heaps_of(candidates, tiles(own, ANCHOR_TILE_ROWS, extra), slots, depth), "heaps"))
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    merged = reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= depth)
    return common.stored(merged, "merged_heaps")


def mine(rows: DataFrame, every: int = ANCHOR_EVERY) -> DataFrame:
    """Hard negatives of the anchors among ``rows`` (``vec_id``, ``label``,
    ``vector`` of whole numbers): ``anchor_id``, ``positive_id``, ``rank``,
    ``negative_id``, ``positive_score``, ``negative_score``."""
    spark = rows.sparkSession
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, str(BUFFER_ROWS // 8))
        rows = usable(rows)
        candidates = common.stored(tiles(rows, TILE_ROWS), "candidate_tiles")
        anchors = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r"))
        anchors = common.stored(anchors.select("vec_id", "r.label", "r.vector"), "anchors")
        size = anchors.agg(F.sum(F.size("vector") * F.lit(8)).alias("b")).first().b or 0
        groups = max(1, -(-size // GROUP_BYTES))
        spark.conf.set(key, str(PAIRS_A_BATCH))
        positives = best_of(candidates, anchors, 1, POSITIVES, groups)
        found = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda r: r["score"]).alias("scores"))
        windows = anchors.join(found, "vec_id")
        negatives = best_of(candidates, windows, POSITIVES, NEGATIVES, groups)
    finally:
        spark.conf.set(key, before)
    named = positives.select("anchor_id", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return negatives.join(named, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def of_embeddings(embeddings: DataFrame) -> DataFrame:
    """Rows of ``embeddings`` as :func:`mine` takes them: components times
    ``SCALE`` cut to whole numbers, the label moved on where 7 divides the id."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("int")
    # A floor of doubles would be a long and raise on what is not finite.
    whole = F.transform(F.col("embedding"), lambda x: F.when(F.abs(x) < 2.0**40, F.floor(x.cast("double") * SCALE).cast("double")).otherwise(x.cast("double")))
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), whole.alias("vector"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(of_embeddings(common.table(spark, sf_dir, "embeddings")))


OP11_SQL = f"""
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
             list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM r a, r c WHERE a.vec_id % {ANCHOR_EVERY} = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND {LOW_SHARE} * positive_score <= {FULL_SHARE} * score AND {FULL_SHARE} * score <= {FULL_SHARE} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
