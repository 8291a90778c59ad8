"""Language identification by Bayesian evidence fusion (operator 6).

For every row the log posterior of a language adds up four kinds of evidence:

* the text: byte-trigram likelihoods of all of it, tempered to the weight of
  at most ``TEXT_WEIGHT`` independent trigrams (neighbouring trigrams repeat
  each other's evidence);
* the declared markup language (``<html lang>``, or the ``lang`` column):
  P(declared | language), a confusion table counted over all rows;
* the address: P(language | host), smoothed towards its registered domain, that
  towards the address suffix (last label of the host), and that towards the
  whole corpus, so an unknown host falls back to what its suffix says.

The languages are those that ``MIN_DECLARED`` rows or more declare, by the two-letter
code that a declaration starts with (``pt`` of ``pt-BR``); there are at most 26 * 26, which
bounds the broadcast trigram table (88 MB; 0.5 MB for four).

All tables come from grouped aggregation over every row.  The trigram counts are
learned from rows by their declared language, the other tables from the text
decisions, so a host or a declaration never confirms itself.

Defined results: null or empty text, and text without letters, has no text
evidence, gets language null and is rejected.  Null declarations, those without a
two-letter code and those of too few rows, null hosts and suffixes are no evidence.  Rejected too is text whose best language
has a posterior under ``MIN_POSTERIOR``, or that no known language explains
(``MIN_FIT``).  Repeated rows are judged one by one; ties go to the first code in
alphabetical order; with no language declared often enough nothing is learned and
every row is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsflow.llm import common

#: Rows that must declare a language.
MIN_DECLARED = 5
BINS = 1 << 15
TEXT_WEIGHT = 60.0
HOST_STRENGTH = 20.0
DECLARED_PRIOR = 2.0
MIN_POSTERIOR = 0.5
#: Mean log-likelihood a trigram must reach above the uniform one.
MIN_FIT = 0.5


def _table() -> np.ndarray:
    """Byte -> class: letters lower-cased, everything that is no letter 0."""
    t = np.zeros(256, np.uint32)
    for c in range(256):
        if 65 <= c <= 90:
            t[c] = c - 64
        elif 97 <= c <= 122:
            t[c] = c - 96
        elif c >= 128:
            t[c] = 27 + c - 128
    return t


_CLASS = _table()


def trigram_bins(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram bins of all texts one after another, and the text number of each.
    Trigrams with no letter, and those across texts, are left out."""
    size = np.array([len(t) if t else 0 for t in texts], np.int64)
    data = _CLASS[np.frombuffer(b"".join(t for t in texts if t), np.uint8)]
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), size)
    code = (data[:-2] * np.uint32(24593) + data[1:-1]) * np.uint32(24593) + data[2:]
    keep = (data[1:-1] > 0) & (owner[:-2] == owner[2:])
    code = code[keep]
    code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (code >> np.uint32(17)).astype(np.int64), owner[:-2][keep]


def code_of(declared: Column) -> Column:
    """The two-letter code that a declaration starts with, else null."""
    code = F.lower(F.substring_index(F.trim(declared), "-", 1))
    return F.when(code.rlike("^[a-z]{2}$"), code)


def languages_of(rows: DataFrame, min_rows: int = MIN_DECLARED) -> list[str]:
    """The codes in ``declared`` that enough rows with text have, in alphabetical order."""
    told = rows.where("declared IS NOT NULL AND text IS NOT NULL").groupBy("declared").count()
    return sorted(r.declared for r in told.where(F.col("count") >= min_rows).select("declared").collect())


def learn_text_model(rows: DataFrame, languages: list[str]) -> np.ndarray | None:
    """Log P(trigram bin | language), add-one smoothed, from all rows that declare one
    of ``languages``.  The counts that reach the driver are at most languages x bins."""
    if not languages:
        return None
    common.small_batches(rows.sparkSession)
    number = {x: k for k, x in enumerate(languages)}

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(number), BINS), np.int64)
        for batch in batches:
            bins, owner = trigram_bins(common.raw_bytes(batch.column("text")))
            lang = np.array([number[x] for x in batch.column("declared").to_pylist()], np.int64)
            if len(bins):
                total += np.bincount(lang[owner] * BINS + bins, minlength=total.size).reshape(total.shape)
        lang, at = np.nonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(at, pa.int32()), pa.array(total[lang, at])],
                                             names=["l", "bin", "n"])

    counted = (rows.where("text IS NOT NULL").where(F.col("declared").isin(languages)).select("text", "declared")
               .mapInArrow(counts, "l int, bin int, n long").groupBy("l", "bin").agg(F.sum("n").alias("n"))).toPandas()
    table = np.zeros((len(languages), BINS))
    table[counted.l, counted.bin] = counted.n
    return np.log((table + 0.5) / (table.sum(axis=1, keepdims=True) + 0.5 * BINS)).astype(np.float32)


def text_evidence(rows: DataFrame, model: np.ndarray | None) -> DataFrame:
    """Adds ``n`` (trigrams) and ``ll`` (mean log-likelihood by language) and
    drops the text."""
    common.small_batches(rows.sparkSession)
    spark = rows.sparkSession
    langs = 0 if model is None else len(model)
    shared = spark.sparkContext.broadcast(None if model is None else np.ascontiguousarray(model.T))

    def scored(batches):
        table = shared.value
        for batch in batches:
            n_rows = batch.num_rows
            bins, owner = trigram_bins(common.raw_bytes(batch.column("text")))
            n = np.bincount(owner, minlength=n_rows)
            if table is None:
                n = np.zeros(n_rows, np.int64)
            total = np.zeros((n_rows, langs))
            if table is not None and len(bins):
                for k in range(langs):
                    total[:, k] = np.bincount(owner, weights=table[bins, k], minlength=n_rows)
            mean = total / np.maximum(n, 1)[:, None]
            keep = [i for i, name in enumerate(batch.schema.names) if name != "text"]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n_rows + 1) * langs, pa.int32()),
                                             pa.array(mean.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [pa.array(n, pa.int64()), lists],
                                             names=[batch.schema.names[i] for i in keep] + ["n", "ll"])

    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]
    return rows.mapInArrow(scored, ", ".join([*names, "n long", "ll array<double>"]))


def _tempered(ll: Column, n: Column) -> Column:
    weight = F.least(n.cast("double"), F.lit(TEXT_WEIGHT))
    return F.transform(ll, lambda x: x * weight)


def _best(scores: Column) -> Column:
    """Index of the first largest entry."""
    return F.array_position(scores, F.array_max(scores)).cast("int") - 1


def _shares(counted: DataFrame, key: str, parent: Column, strength: float) -> DataFrame:
    """(counts + strength * parent) / (total + strength), entry by entry."""
    total = F.aggregate("counts", F.lit(0.0), lambda a, x: a + x)
    return counted.select(key, F.zip_with(F.col("counts"), parent, lambda c, p: (c + strength * p) / (total + strength)).alias("p"))


def _by(rows: DataFrame, langs: int, *keys: str) -> DataFrame:
    """Counts of text decisions by ``keys``, as an array in language order."""
    counts = F.array(*[F.count_if(F.col("guess") == k).cast("double") for k in range(langs)])
    return rows.groupBy(*keys).agg(counts.alias("counts"))


def fuse(evidence: DataFrame, languages: list[str]) -> DataFrame:
    """Adds ``language``, ``posterior`` and ``kept`` to rows that have
    ``declared, suffix, domain, host, n, ll`` (in the order of ``languages``)."""
    langs = len(languages)
    if not langs:
        return evidence.drop("ll").withColumns({"posterior": F.lit(None).cast("double"), "language": F.lit(None).cast("string"), "kept": F.lit(False)})
    known = evidence.where("n > 0").withColumn("guess", _best(F.col("ll")))
    flat = F.array(*[F.lit(1.0 / langs)] * langs)
    glob = _shares(_by(known.withColumn("all", F.lit(1)), langs, "all"), "all", flat, 1.0).collect()
    base = list(glob[0].p) if glob else [1.0 / langs] * langs
    base_col = F.array(*[F.lit(float(x)) for x in base])
    # The chain suffix -> domain -> host; each level is one row per key.
    by_suffix = _shares(_by(known.where("suffix IS NOT NULL"), langs, "suffix"), "suffix", base_col, HOST_STRENGTH).withColumnRenamed("p", "p_suffix")
    domains = _by(known.where("domain IS NOT NULL"), langs, "domain", "suffix").join(by_suffix, "suffix", "left")
    domains = domains.withColumn("parent", F.coalesce("p_suffix", base_col))
    by_domain = _shares(domains, "domain", F.col("parent"), HOST_STRENGTH).withColumnRenamed("p", "p_domain")
    hosts = _by(known.where("host IS NOT NULL"), langs, "host", "domain").join(by_domain, "domain", "left")
    hosts = hosts.withColumn("parent", F.coalesce("p_domain", base_col))
    by_host = _shares(hosts, "host", F.col("parent"), HOST_STRENGTH).withColumnRenamed("p", "p_host")
    # Confusion of declarations: P(declared | language), bounded by languages squared.
    told = np.zeros((langs, langs))
    for r in known.where(F.col("declared").isin(languages)).groupBy("declared", "guess").count().collect():
        told[languages.index(r.declared), r.guess] = r["count"]
    prior = np.where(np.eye(langs) > 0, 1.0, 0.75 / max(1, langs - 1)) * DECLARED_PRIOR
    like = (told + prior) / (told.sum(axis=0) + prior.sum(axis=0))
    lists = evidence.sparkSession.createDataFrame([(d, row.tolist()) for d, row in zip(languages, like, strict=True)], "declared string, p_declared array<double>")
    joined = evidence.join(by_host, "host", "left").join(F.broadcast(lists), "declared", "left")
    declared = F.coalesce("p_declared", F.array(*[F.lit(1.0)] * langs))
    prior = F.coalesce("p_host", base_col)
    score = F.zip_with(_tempered(F.col("ll"), F.col("n")), F.zip_with(prior, declared, lambda p, q: F.log(p) + F.log(q)), lambda a, b: a + b)
    out = joined.withColumn("_score", score).withColumn("_top", F.array_max("_score"))
    out = out.withColumn("posterior", F.when(F.col("n") > 0, 1.0 / F.aggregate(
        F.transform("_score", lambda x: F.exp(x - F.col("_top"))), F.lit(0.0), lambda a, x: a + x)))
    best = _best(F.col("_score"))
    names = F.array(*[F.lit(x) for x in languages])
    out = out.withColumn("language", F.when(F.col("n") > 0, F.get(names, best)))
    slack = 5.0 / F.sqrt(F.greatest(F.col("n"), F.lit(1)).cast("double"))  # a short text may be unlucky
    fits = F.get(F.col("ll"), best) + slack >= F.lit(float(-np.log(BINS)) + MIN_FIT)
    out = out.withColumn("kept", F.coalesce((F.col("posterior") >= MIN_POSTERIOR) & fits, F.lit(False)))
    return out.drop("_score", "_top", "p_host", "p_declared", "ll")


def identify(rows: DataFrame) -> DataFrame:
    """``rows``: any key columns, ``text``, ``declared``, ``host`` (strings).
    Returns the other columns with ``language``, ``posterior``, ``kept``."""
    host = F.lower(F.trim("host"))
    slim = rows.withColumns({"declared": code_of(F.col("declared")), "host": F.when(host != "", host)})
    dotted = F.col("host").contains(".")
    slim = slim.withColumns({"suffix": F.when(dotted, F.substring_index("host", ".", -1)),
                             "domain": F.when(dotted, F.substring_index("host", ".", -2))})
    languages = languages_of(slim)
    evidence = common.stored(text_evidence(slim, learn_text_model(slim, languages)), "language_evidence")
    return fuse(evidence, languages)


def of_documents(docs: DataFrame) -> DataFrame:
    """The evidence of ``documents``: ``lang`` is the declaration and ``source``
    the host (a source without dots has no suffix)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").alias("declared"), F.col("source").alias("host"))


def of_pages(pages: DataFrame) -> DataFrame:
    """The evidence of ``pages``: visible text, ``<html lang>`` and url host."""
    visible = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"<[^>]*>", " ")
    lang = F.nullif(F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1), F.lit(""))
    host = F.nullif(F.regexp_extract("url", r"://([^/?#:]*)", 1), F.lit(""))
    return pages.select("page_id", visible.alias("text"), lang.alias("declared"), host.alias("host"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(of_documents(common.table(spark, sf_dir, "documents")))
    return found.select("doc_id", "language", F.round("posterior", 6).alias("posterior"), "declared", "kept")


def language_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(of_pages(common.table(spark, sf_dir, "pages")))
    return found.select("page_id", "language", F.round("posterior", 6).alias("posterior"), "declared", "host", "kept")
