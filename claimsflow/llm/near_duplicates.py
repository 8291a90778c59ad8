"""N-gram Jaccard join with Bayesian candidate pruning (operator 3).

Documents are sets of five-word shingles (white-space separated words, A-Z
lower-cased; a text with fewer words is one shingle).  Two are linked when their
sets' Jaccard similarity is 0.8 or more.

1. One pass makes a MinHash sketch of each text: 32 band keys of four values for
   candidates and 64 further values for pruning.  Equal sets become one node.
2. Nodes that share a band key are candidates.  Inside a bucket their values are
   compared a few at a time; a pair is dropped as soon as the posterior probability
   (uniform prior) that it reaches the threshold is below ``TOLERANCE``.  A task
   emits a spanning forest of the pairs left, not the pairs.
3. Connected candidate nodes are verified: within a component all pairs are pruned
   again by their values and the rest is verified exactly on whole shingle sets.
   A task emits link counts and a forest of the links.
4. Connected linked nodes are one class, named by the smallest ``doc_id``.

Buckets and components of any size are cut into blocks of at most about
``BLOCK`` rows; tasks take one pair of blocks each, so memory is bounded and a
hot group is spread.  A candidate is missed when no band agrees: at similarity
0.8 with probability (1 - 0.8**4)**32, 5 in 100,000,000, less above it; step 3 looks at
all pairs of a component, also at those no band has brought together.

Defined results: null and empty texts and texts without words have no shingles
and are linked to nothing, also not to each other; each is its own class.
Repeated rows are one node and each gets a row.  A null ``doc_id`` keeps its row;
a class of null ids only has a null ``class_id``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsflow.llm import common

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
COMPARED = 64
STEP = 8
TOLERANCE = 1e-6
BLOCK = 512
#: Shingles in a block of the exact verification (bounds it where texts are long).
BLOCK_SHINGLES = 1_000_000

_RNG = np.random.default_rng(20240501)
_FACTORS = _RNG.integers(0, 2**63, BANDS * ROWS + COMPARED, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out = []
    for first, last in common.blocks(texts):
        words, owner = common.split_hashes(texts[first:last])
        cut = np.searchsorted(owner, np.arange(last - first + 1))
        out += [np.unique(common.window_hashes(words[a:b], SHINGLE)) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return out


def minhash(s: np.ndarray) -> np.ndarray:
    """The smallest value under each hash function, as uint32."""
    low = np.full(len(_FACTORS), np.iinfo(np.uint32).max, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(s), 2048):
            part = (s[at:at + 2048][None, :] * _FACTORS[:, None]) >> np.uint64(32)
            low = np.minimum(low, part.min(axis=1).astype(np.uint32))
    return low


def node_of(s: np.ndarray) -> bytes:
    """128 bits that name a shingle set, whatever its order."""
    with np.errstate(over="ignore"):
        a, b = common.mix(s).sum(dtype=np.uint64), np.bitwise_xor.reduce(common.mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    return a.tobytes() + b.tobytes()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = shingles([t or b"" for t in common.raw_bytes(batch.column("text"))])
        nodes, bands, values = [], [], []
        for s in sets:
            if not len(s):
                nodes.append(None), bands.append(None), values.append(None)
                continue
            m = minhash(s)
            keys = common.mix(common.window_hashes(m[:BANDS * ROWS].astype(np.uint64), ROWS)[::ROWS] + np.arange(BANDS, dtype=np.uint64))
            nodes.append(node_of(s))
            bands.append(keys.view(np.int64))
            values.append(m[BANDS * ROWS:].astype(np.uint16).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(nodes, pa.binary()), pa.array([len(s) for s in sets], pa.int32()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(values, pa.binary())], names=["doc_id", "text_key", "node", "n", "bands", "sig"])


def sketches(docs: DataFrame) -> DataFrame:
    common.small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("text_key"), "text")
    return rows.mapInArrow(_sketch, "doc_id long, text_key string, node binary, n int, bands array<long>, sig binary")


def fewest_matches(compared: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """The fewest of ``compared`` equal values at which a pair is still kept.

    With a uniform prior, P(J >= t | m of n equal) is the upper tail of a
    Beta(m + 1, n - m + 1), that is P(Binomial(n + 1, t) <= m)."""
    n, tail = compared + 1, 0.0
    for m in range(compared + 1):
        tail += math.comb(n, m) * threshold**m * (1 - threshold) ** (n - m)
        if tail >= tolerance:
            return m
    return compared


_FEWEST = {n: fewest_matches(n) for n in range(STEP, COMPARED + 1, STEP)}


def surviving(sig: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that incremental comparison does not drop."""
    matches = np.zeros(len(i), np.int16)
    for at in range(0, COMPARED, STEP):
        matches += (sig[i, at:at + STEP] == sig[j, at:at + STEP]).sum(axis=1, dtype=np.int16)
        keep = matches >= _FEWEST[at + STEP]
        i, j, matches = i[keep], j[keep], matches[keep]
    return i, j


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member of each one's component."""
    label = np.arange(n)
    while True:
        new = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def block_pairs(left: np.ndarray, p: int, q: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of a pair of blocks, a slice at a time: all once if the
    blocks are one, else left with right.  ``left``: the block of each row."""
    rows = np.arange(len(left))
    if p == q:
        for a in range(0, len(rows), 256):
            i, j = np.meshgrid(rows[a:a + 256], rows, indexing="ij")
            keep = i < j
            yield i[keep], j[keep]
    else:
        one, two = rows[left == p], rows[left == q]
        for a in range(0, len(one), 256):
            i, j = np.meshgrid(one[a:a + 256], two, indexing="ij")
            yield i.ravel(), j.ravel()


def groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Runs of equal keys in sorted batches; groups are bounded by the blocks."""
    open_parts: list[pa.RecordBatch] = []
    open_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.array(batch.column(k).to_pylist(), dtype=object) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            key = tuple(c[a] for c in columns)
            if open_parts and key != open_key:
                yield pa.Table.from_batches(open_parts)
                open_parts = []
            open_key = key
            open_parts.append(batch.slice(a, b - a))
    if open_parts:
        yield pa.Table.from_batches(open_parts)


def in_blocks(members: DataFrame, key: str, n_blocks) -> DataFrame:
    """Rows copied to the pairs of blocks that need them, grouped and sorted by
    (key, p, q) within partitions.  ``members`` has ``node``."""
    own = F.pmod(F.xxhash64("node"), F.col("nb")).cast("int")
    cut = members.withColumn("nb", n_blocks).withColumn("block", own)
    other = F.explode(F.when(F.col("nb") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("nb").cast("int") - 1)))
    spread = cut.withColumn("other", other).withColumns({"p": F.least("block", "other"), "q": F.greatest("block", "other")}).drop("other", "nb")
    return spread.repartition(key, "p", "q").sortWithinPartitions(key, "p", "q")


def _signatures(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint16).reshape(t.num_rows, COMPARED)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: list[tuple[bytes, bytes]] = []
    for t in groups(batches, ("bucket", "p", "q")):
        if t.num_rows < 2:
            continue
        sig, nodes = _signatures(t), t.column("node").to_pylist()
        if t.num_rows == 2:
            if len(surviving(sig, np.array([0]), np.array([1]))[0]):
                found.append((max(nodes), min(nodes)))
        else:
            block = t.column("block").to_numpy()
            parts = [surviving(sig, i, j) for i, j in block_pairs(block, t.column("p")[0].as_py(), t.column("q")[0].as_py())]
            i, j = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, int),) * 2
            root = roots(t.num_rows, i, j)
            found += [(nodes[k], nodes[r]) for k, r in enumerate(root) if r != k]
        if len(found) > 5000:
            yield _edges(found)
            found = []
    yield _edges(found)


def _edges(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())], names=["a", "b"])


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """``node, root`` of every node in an edge (``a, b``); the root is the
    smallest node.  Alternates the large-star and small-star steps, each two
    shuffles, until nothing changes; every round is written to the shared folder."""
    edges = common.stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    for _ in range(rounds):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        # Written first: as a plain read it lets AQE split the rows of a hub over tasks.
        low = common.stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(down.select("a", F.col("m").alias("b"))))
        edges = common.stored(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state or not now[0]:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _with_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = shingles([t or b"" for t in common.raw_bytes(batch.column("text"))])
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array([s.tobytes() for s in sets], pa.binary())], names=[*names, "set"])


def linked(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose exact Jaccard similarity reaches the threshold."""
    size = np.array([len(s) for s in sets], np.int64)
    fits = 10 * np.minimum(size[i], size[j]) >= 8 * np.maximum(size[i], size[j])
    i, j = i[fits], j[fits]
    if not len(i):
        return i, j
    if len(i) <= 2 * len(sets):
        common_n = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j, strict=True)], np.int64)
    else:
        used = np.unique(np.concatenate([i, j]))
        local = np.full(len(sets), -1)
        local[used] = np.arange(len(used))
        every = np.concatenate([sets[k] for k in used])
        owner = np.repeat(np.arange(len(used)), size[used])
        _, column, times = np.unique(every, return_inverse=True, return_counts=True)
        shared = times[column] > 1
        rank = np.cumsum(times > 1) - 1
        column, owner = rank[column[shared]], owner[shared]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        inter = np.zeros((len(used), len(used)), np.float32)
        width = 4096
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, [at, at + width])
            matrix = np.zeros((len(used), width), np.float32)
            matrix[owner[a:b], column[a:b] - at] = 1
            inter += matrix @ matrix.T
        common_n = np.rint(inter[local[i], local[j]]).astype(np.int64)
    keep = 10 * common_n >= 8 * (size[i] + size[j] - common_n)
    return i[keep], j[keep]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in groups(batches, ("root", "p", "q")):
        if t.num_rows < 2:
            continue
        sig, nodes = _signatures(t), t.column("node").to_pylist()
        parts = [surviving(sig, i, j) for i, j in block_pairs(t.column("block").to_numpy(), t.column("p")[0].as_py(), t.column("q")[0].as_py())]
        i, j = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, int),) * 2
        i, j = linked([np.frombuffer(s, np.uint64) for s in t.column("set").to_pylist()], i, j)
        if len(i):
            links = np.bincount(i, minlength=len(nodes)) + np.bincount(j, minlength=len(nodes))
            root = roots(len(nodes), i, j)
            at = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array([nodes[k] for k in at], pa.binary()), pa.array(links[at], pa.int64()),
                                              pa.array([nodes[root[k]] for k in at], pa.binary())], names=["node", "links", "b"])


def join(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, class_key, class_id, n_links, n_copies``: one row per
    row of ``docs``; ``class_key`` is null for texts without words.  ``n_links``: linked nodes (different shingle sets); ``n_copies``: rows
    with the same set, itself included."""
    spark = docs.sparkSession
    sketched = common.stored(sketches(docs), "sketches")
    whole = sketched.where("node IS NOT NULL")
    reps = whole.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_copies"))
    buckets = whole.select("node", F.explode("bands").alias("bucket")).distinct()
    crowded = buckets.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1")
    sigs = whole.groupBy("node").agg(F.first("sig").alias("sig"), F.first("n").alias("n"), F.min("text_key").alias("text_key"))
    members = buckets.join(crowded, "bucket").join(sigs.select("node", "sig"), "node")
    common.small_batches(spark)
    edges = in_blocks(members, "bucket", F.ceil(F.col("m") / BLOCK)).select("bucket", "p", "q", "block", "node", "sig").mapInArrow(
        _candidates, "a binary, b binary")
    near = common.stored(components(edges), "candidate_components")
    # The exact check: the text of one row for each candidate node.
    size = near.join(sigs, "node").groupBy("root").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("nb_root"))
    wanted = near.join(sigs, "node").join(size, "root").select("node", "root", "nb_root", "sig", "text_key")
    texts = docs.select(F.md5("text").alias("text_key"), "text").join(wanted, "text_key")
    texts = texts.groupBy("node").agg(*[F.any_value(c).alias(c) for c in ("root", "nb_root", "sig", "text")])
    checked = (in_blocks(texts.mapInArrow(_with_shingles, "node binary, root binary, nb_root long, sig binary, set binary"), "root", F.col("nb_root"))
               .select("root", "p", "q", "block", "node", "sig", "set").mapInArrow(_verified, "node binary, links long, b binary"))
    checked = common.stored(checked, "links")
    classes = components(checked.select(F.col("node").alias("a"), "b"))
    links = checked.groupBy("node").agg(F.sum("links").alias("n_links"))
    named = reps.join(classes, "node", "left").join(links, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("class_id"))
    named = named.join(smallest, "root").select("node", "root", "class_id", "n_copies", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    alone = F.col("node").isNull()
    return sketched.select("doc_id", "text_key", "node").join(named, "node", "left").select(
        "doc_id", "text_key", F.hex("root").alias("class_key"), F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class: the smallest id (null last),
    and of its rows one.  Texts without words all stay."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("s")
    staying = join(docs).where("class_key IS NOT NULL").groupBy("class_key").agg(first)
    staying = common.stored(staying.select("s.doc_id", "s.text_key").distinct(), "staying")
    marked = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_key": F.md5("text")})
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = marked.where(worded).join(staying, F.col("_id").eqNullSafe(staying["doc_id"]) & (F.col("_key") == staying["text_key"]), "left_semi")
    return kept.dropDuplicates(["_id", "_key"]).unionByName(marked.where(~worded)).drop("_id", "_key")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(common.table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies")
