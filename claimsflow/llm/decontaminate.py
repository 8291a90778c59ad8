"""Benchmark decontamination by template canonicalisation (operator 5).

Texts and benchmark items become sequences of template tokens: numbers, units
after a number, and names (capitalised inside a sentence) are replaced by typed
placeholders, other words are lower-cased.  Windows of ``WINDOW`` template tokens
are joined by hash, so a question asked again with other numbers or names still
meets its item.  A second set of windows leaves names as lower-cased words, so a
passage in other case (where nothing or everything looks like a name) meets it too.
A hit counts only where its slots agree: at one alignment, each slot value of the
item must stand for one value in the document.  A document leaks an item when the
consistent windows of either set cover ``MIN_COVERAGE`` of the item's.

A bitmap of fixed size (``BITMAP_BITS``) of the benchmark's window hashes is sent
to the tasks, which drop windows that cannot match before the join; the join
itself decides.  Texts are taken whole.

Defined results: null and empty texts and items match nothing.  Items under
``WINDOW`` template tokens are one window.  Those under ``MIN_TOKENS`` say too little
as templates: they are found word for word (letter case aside), those under
``MIN_RUN`` only where the document says nothing else.
Rows with equal text get equal verdicts.  Repeated items are each reported.  A null
id is kept as such.  Extra columns are ignored by ``leaks`` and kept by ``clean``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsflow.llm import common

WINDOW = 8
MIN_TOKENS, MIN_RUN = 5, 3
MIN_LITERALS = 4
MIN_COVERAGE = 0.5
BITMAP_BITS = 1 << 23
# Words that are units after a number.
UNITS = frozenset("""mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds ton tons
ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years
cent cents dollar dollars euro euros percent degree degrees km2 m2 kmh mph hz khz mhz volt volts watt watts""".split())

CAPITAL, NUMBER, UNIT = 1, 2, 3
#: The two sets of windows: with placeholders for names, and without.
NAMES, PLAIN = 0, 1
_KIND = np.array([0, 0x3C6EF372FE94F82B], np.uint64)


def _marks() -> dict[str, np.ndarray]:
    table = {name: np.zeros(256, bool) for name in ("word", "digit", "upper", "stop")}
    table["word"][[c for c in range(128) if chr(c).isalnum() or c == 95] + list(range(128, 256))] = True
    table["digit"][48:58] = True
    table["upper"][65:91] = True
    table["stop"][[ord(c) for c in ".!?\n"]] = True
    return table


_MARK = _marks()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _hash_of(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return common.run_hashes(data, np.array([0]), np.array([len(data)]))[0]


_PLACEHOLDER = {k: _hash_of(f"<{k}>") for k in (CAPITAL, NUMBER, UNIT)}
_UNIT_HASHES = np.array(sorted(_hash_of(u) for u in UNITS), np.uint64)


class Template:
    """The template tokens of a block of texts: ``hash``, ``slot`` (placeholder
    or not) and ``owner`` (text number), one after another.

    A token is a run of ASCII letters, digits and ``_``, a number with its inner
    points and commas, or a run of non-ASCII letters; the general punctuation
    and Latin-1 signs (``E2 80 xx``, ``C2 xx``, ``E3 80 xx``) part tokens.  Case is
    folded for A-Z and Latin-1."""

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join([*texts, b""])
        data = np.frombuffer(self.raw, np.uint8)
        word, digit = _MARK["word"][data], _MARK["digit"][data]
        upper, low = _MARK["upper"][data], _LOWER[data]
        high = np.flatnonzero(data[:-1] >= 0xC2) if len(data) else data
        lead, after = data[high], data[high + 1]
        two = high[lead == 0xC2]
        word[two], word[two + 1] = False, False
        three = high[((lead == 0xE2) | (lead == 0xE3)) & (after == 0x80)]
        for k in range(3):
            word[three + k] = False
        big = high[(lead == 0xC3) & (after >= 0x80) & (after <= 0x9E)]
        upper[big] = True
        low[big + 1] += 0x20
        inner = np.flatnonzero((data[1:-1] == 46) | (data[1:-1] == 44)) + 1
        word[inner[digit[inner - 1] & digit[inner + 1]]] = True
        self.start, self.end = common.runs(word)
        start, end = self.start, self.end
        self.hash = common.run_hashes(low, start, end)
        size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.owner = np.searchsorted(np.cumsum(size), start, "right")
        count = lambda mark, a, b: (c := np.concatenate([[0], np.cumsum(mark)]))[b] - c[a]
        digits = count(digit, start, end)
        letters = count(word & ~digit & (data != 46) & (data != 44), start, end)
        number = (digits > 0) & (letters == 0)
        opens = np.ones(len(start), bool)  # at the start of a text or sentence
        opens[1:] = count(_MARK["stop"][data] & ~word, end[:-1], start[1:]) > 0
        name = upper[start] & (count(upper, start, end) == 1) & ~opens & ~number
        follows = np.zeros(len(start), bool)
        follows[1:] = number[:-1] & ~opens[1:]
        unit = np.zeros(len(start), bool)
        after_number = np.flatnonzero(follows)
        unit[after_number] = np.isin(self.hash[after_number], _UNIT_HASHES)
        plain = self.hash.copy()
        for k, here in ((NUMBER, number), (UNIT, unit)):
            plain[here] = _PLACEHOLDER[k]
        self.hash = np.where(name & ~unit, _PLACEHOLDER[CAPITAL], plain)
        self.hashes = (self.hash, plain)
        self.slot = (number | unit | name, number | unit)

    def windows(self, n: int, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every window of ``n`` tokens, and whether one text holds it."""
        if len(self.hash) < n:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        mark = _KIND[kind] ^ np.uint64(WINDOW - n)
        return common.window_hashes(self.hashes[kind], n) ^ mark, self.owner[:len(self.hash) - n + 1] == self.owner[n - 1:]

    def slots(self, at: int, n: int, kind: int) -> list[str]:
        """The slot values of a window, lower-cased."""
        return [self.raw[self.start[k]:self.end[k]].decode(errors="replace").lower() for k in range(at, at + n) if self.slot[kind][k]]


def text_key(text: str) -> str:
    """The same as Spark's ``md5`` of the text."""
    return hashlib.md5(text.encode(), usedforsecurity=False).hexdigest()


_SCHEMA = "key string, window long, at int, slots array<string>, kind int, n int, of int"
_WINDOW_SCHEMA = pa.schema([("key", pa.string()), ("window", pa.int64()), ("at", pa.int32()), ("slots", pa.list_(pa.string())),
                            ("kind", pa.int32()), ("n", pa.int32()), ("of", pa.int32())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_WINDOW_SCHEMA)], schema=_WINDOW_SCHEMA)


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Key of each distinct item text, window hash, place, slots, kind and length
    of the window and the item's number of windows of the kind.  Windows with few literal words are left
    out unless the item has no others."""

    def made(batches):
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                parsed = Template([text.encode()])
                n = min(WINDOW, len(parsed.hash))
                key = text_key(text)
                for kind in (NAMES, PLAIN) if n >= MIN_TOKENS else (PLAIN,) if n else ():
                    hashes = parsed.windows(n, kind)[0].view(np.int64)
                    literal = np.convolve(~parsed.slot[kind], np.ones(n, int), "valid") >= min(n, MIN_LITERALS)
                    keep = np.flatnonzero(literal) if literal.any() else np.arange(len(hashes))
                    rows += [(key, int(hashes[k]), int(k), parsed.slots(int(k), n, kind), kind, n, len(keep)) for k in keep]
            yield _rows(rows)

    return (benchmark.where("text IS NOT NULL").select("text").distinct()
            .mapInArrow(made, _SCHEMA))


def _bitmap(windows: DataFrame, bits: int) -> np.ndarray:
    """One bit for each window hash; parts are combined, ``bits`` in size each."""

    def part(batches):
        seen = np.zeros(bits, bool)
        for batch in batches:
            seen[batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) % np.uint64(bits)] = True
        yield pa.RecordBatch.from_pydict({"bits": pa.array([np.packbits(seen).tobytes()], pa.binary())})

    out = np.zeros(bits // 8, np.uint8)
    for row in windows.select("window").coalesce(4).mapInArrow(part, "bits binary").toLocalIterator():
        out |= np.frombuffer(row.bits, np.uint8)
    return np.unpackbits(out).astype(bool)


def document_windows(docs: DataFrame, bitmap, lengths: tuple[tuple[int, int], ...]) -> DataFrame:
    """The windows of every text that the bitmap lets through, keyed by text."""
    common.small_batches(docs.sparkSession)

    def made(batches):
        seen = np.unpackbits(bitmap.value).astype(bool)
        size = np.uint64(len(seen))
        for batch in batches:
            texts = common.raw_bytes(batch.column("text"))
            rows, keys = [], {}
            for first, last in common.blocks(texts):
                parsed = Template(texts[first:last])
                begin = np.searchsorted(parsed.owner, np.arange(last - first))
                size_of = np.bincount(parsed.owner, minlength=last - first)
                for n, kind in lengths:
                    windows, whole = parsed.windows(n, kind)
                    if n < MIN_RUN:  # alone in its text only
                        whole = whole & (size_of[parsed.owner[:len(whole)]] == n)
                    for at in np.flatnonzero(seen[windows % size] & whole):
                        k = int(parsed.owner[at])
                        key = keys.get(first + k) or keys.setdefault(first + k, text_key(texts[first + k].decode()))
                        rows.append((key, int(windows[at].view(np.int64)), int(at - begin[k]), parsed.slots(int(at), n, kind), kind, n, 0))
            yield _rows(rows)

    return (docs.where("text IS NOT NULL").select("text")
            .mapInArrow(made, _SCHEMA).drop("of", "n", "kind"))


def leaking_texts(docs: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """``text_key, item_key, coverage, verbatim``: distinct texts and the distinct items they leak."""
    spark = docs.sparkSession
    items = common.stored(benchmark_windows(benchmark), "benchmark_windows")
    # At most WINDOW lengths of each kind; WINDOW alone unless there are short items.
    lengths = tuple((r.n, r.kind) for r in items.select("n", "kind").distinct().orderBy("n", "kind").collect())
    bitmap = spark.sparkContext.broadcast(np.packbits(_bitmap(items, BITMAP_BITS)))
    hits = document_windows(docs, bitmap, lengths).dropDuplicates(["key", "window", "at"])
    fits = (F.col("d.window") == F.col("b.window")) & ((F.col("b.n") >= MIN_TOKENS) | (F.col("d.slots") == F.col("b.slots")))
    met = hits.alias("d").join(items.alias("b"), fits).select(
        F.col("d.key").alias("text_key"), F.col("b.key").alias("item_key"), F.col("b.kind").alias("kind"), F.col("b.of").alias("of"), F.col("b.at").alias("at"),
        (F.col("d.at") - F.col("b.at")).alias("shift"), F.col("d.slots").alias("ds"), F.col("b.slots").alias("bs"))
    pairs = F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("bs", "ds"))))
    aligned = (met.groupBy("text_key", "item_key", "kind", "of", "shift").agg(F.collect_set("at").alias("ats"), pairs.alias("pairs"))
               .where(F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["bs"])))))
    changed = F.exists("pairs", lambda p: p["bs"] != p["ds"])
    covered = F.size(F.array_distinct(F.flatten(F.collect_list("ats")))) / F.first("of")
    found = (aligned.groupBy("text_key", "item_key", "kind").agg(covered.alias("coverage"), (~F.max(changed)).alias("verbatim"))
             .where(F.col("coverage") >= min_coverage))
    # With names, where they cover enough, tells best whether values changed.
    found = found.groupBy("text_key", "item_key").agg(F.max("coverage").alias("coverage"), F.min_by("verbatim", "kind").alias("verbatim"))
    return common.stored(found, "leaking_texts")


def leaks(docs: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per document and item that it leaks."""
    found = leaking_texts(docs, benchmark, min_coverage)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("text_key"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.md5("text").alias("item_key"))
    return (texts.join(found, "text_key").join(items, "item_key")
            .select("doc_id", "item_id", F.round("coverage", 4).alias("coverage"), "verbatim"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that leak an item."""
    found = leaking_texts(docs, benchmark).select("text_key").distinct()
    return docs.join(found, F.md5(docs["text"]) == found["text_key"], "left_anti")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
