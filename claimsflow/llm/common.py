"""Helpers shared by the training-data operators.

Texts are handled as UTF-8 bytes where only ASCII matters: ``bytes.split()``
splits exactly on ``[\\x20\\x09-\\x0D]+`` and ``bytes.lower()`` changes A-Z only.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsflow.session import ensure_checkpoint_dir

#: Rows in one Arrow batch: bounds what a Python worker holds at once, whatever
#: the partition's size (long texts are megabytes at most).
BATCH_ROWS = 400
#: Entries in a worker's word cache; a word beyond it is computed again.
CACHE_WORDS = 150_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Remove the folder that holds ``path`` when the driver's JVM ends."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder.getParent())


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder (in folders ``by`` columns)
    and read it back: cuts the lineage, survives lost executors, computed once.
    Removed when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"
    df.write.partitionBy(*by).parquet(path)
    remove_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def smallest(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The rows of the ``n`` smallest values of ``key``, one for each value.  The
    bound is found from the keys alone, so that no task takes other tasks' rows."""
    least = rows.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key).limit(n)
    last = least.agg(F.max(key)).first()[0]
    return rows.where(F.col(key) <= F.lit(last)).dropDuplicates([key]) if last is not None else rows.limit(0)


def md5_fraction(col, salt: str = ""):
    """A uniform number in [0, 1) from the md5 of ``col`` as text: the same on
    every run, retry and engine."""
    digest = F.md5(F.concat(F.lit(salt), F.coalesce(col.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def raw_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of an Arrow string column."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


class WordHash(dict):
    """64-bit hashes of words, cached for the common ones."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHE_WORDS:
            self[word] = h
        return h


_WORDS = WordHash()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


_MIX = np.uint64(0x9E3779B97F4A7C15)
_ROT = np.uint64(29)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (xor-shift-multiply rounds)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` items (of all items when fewer than ``n``)."""
    if len(h) == 0:
        return h
    n = min(n, len(h))
    out = np.zeros(len(h) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = (out ^ (out >> _ROT)) * _MIX + h[k:len(h) - n + 1 + k]
    return mix(out)


#: Bytes of text that are worked on at once (one text more where it is longer).
BLOCK_BYTES = 1 << 21
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base % 2**64, np.uint64)
    steps[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(steps)


class _Powers:
    """Powers of the base and of its inverse, as many as were asked for."""

    up = down = np.zeros(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES)
            self.up, self.down = _powers(_BASE, size), _powers(pow(_BASE, -1, 2**64), size)
        return self.up, self.down


_POWERS = _Powers()


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each ``start`` to its ``end`` (exclusive): a
    polynomial over scrambled byte values, equal for equal bytes anywhere."""
    up, down = _POWERS.get(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[data] * up[:len(data)], out=prefix[1:])
        return mix((prefix[end] - prefix[start]) * down[start])


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES):
    """Runs ``(first, last)`` of texts that hold about ``limit`` bytes together."""
    first, size = 0, 0
    for k, t in enumerate(texts):
        if k > first and size + len(t) > limit:
            yield first, k
            first, size = k, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true."""
    edge = np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def split_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the white-space separated words (A-Z lower-cased) of all
    texts, and the text number of each."""
    data = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    start, end = runs(~_SPACE[data])
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return run_hashes(data, start, end), np.searchsorted(np.cumsum(size), start, "right")
