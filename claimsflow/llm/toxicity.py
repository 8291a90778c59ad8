"""Toxicity by a weighted lexicon (operator 10).

Texts are folded character by character (lower case, accents and homoglyphs to
plain letters, digits and signs that stand for letters), matched with an
Aho-Corasick automaton at word starts (a word with substitutes at its edges, as
``1diot``, also with them folded in; tokens without any letter are no words), and scored by the summed weights of the
hits over the square root of the number of words.  The lexicon is learned: word
starts and whole words with their log-odds between toxic and clean labelled
documents.  Hits inside an exception phrase (a hit with its neighbour word that
labelled documents show to be harmless, or one passed in) do not count.  A
logistic curve fitted to the training scores turns the sum into 0..1.

The classifier is fitted on at most about ``FIT_ROWS`` labelled rows (drawn by a
hash of the id where there are more), which bounds its lexicon and phrases: every
term and phrase that has the support and the odds is taken.  Labelled rows are cut
out of the documents by a bitmap of their ids before they are shuffled, and stored
once for the three passes over them.  Document counts of the chosen terms and the
strength histogram reach the driver.

Defined results: null or empty text has no hits and gets the curve's value at 0.
Repeated rows are scored one by one; each repeated label id counts once and
contradicting labels are left out.  With no labels of one kind every score is the
(smoothed) share of toxic labels.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsflow.llm import common

# Look-alike letters of other scripts, and signs written for letters.
HOMOGLYPHS = {"а": "a", "в": "b", "е": "e", "ё": "e", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
              "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ԁ": "d", "ɡ": "g", "α": "a", "β": "b", "ε": "e",
              "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o"}
SUBSTITUTIONS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}

PREFIX_LENGTHS = range(3, 9)
MIN_SUPPORT = 5
MIN_LOG_ODDS = 2.0
#: Labelled rows that the classifier is fitted on, at most (about).
FIT_ROWS = 400_000
#: Bits of the bitmap of labelled ids: so many an id, up to 32 MB in all.
BITS_AN_ID, MOST_BITS = 16, 1 << 28
THRESHOLD = 0.3
#: Terms a task counts before it passes its counts on (bounds its memory).
FLUSH_TERMS = 200_000
BIN_WIDTH = 0.05


class _Fold(dict):
    """Character -> folded character, always one to one, filled as met."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        low = c.lower() if len(c.lower()) == 1 else c
        plain = HOMOGLYPHS.get(low) or SUBSTITUTIONS.get(low)
        if plain is None:
            base = unicodedata.normalize("NFKD", low)[0].lower()
            plain = HOMOGLYPHS.get(base, base) if len(base) == 1 else low
        self[code] = plain
        return plain


_FOLD = _Fold()
_EDGE = "@$0123456789"
# A word with the signs and digits at its edges; each run of them is read once.
_TOKEN = re.compile(r"(?<![@$0-9])[@$0-9]*+[^\W\d_]++(?:[@$0-9]++[^\W\d_]++)*+[@$0-9]*+")


def fold(text: str) -> str:
    """Folded text of the same length."""
    return text.translate(_FOLD)


class Words(list):
    """Folded words; ``more``: (word number, another form) of the words that
    have substitutes at their edges."""

    more: list[tuple[int, str]] = []

    def every(self) -> list[str]:
        return [*self, *(w for _, w in self.more)]


def edge_forms(token: str, word: str) -> list[str]:
    """``word`` with the substitutes before it, after it, and both.  An outer run of
    three ``$`` or more is none, nor is an edge with a digit that stands for no letter."""
    at = len(token) - len(token.lstrip(_EDGE))
    lead, trail = re.sub(r"^\${3,}", "", token[:at]), re.sub(r"\${3,}$", "", token[at + len(word):])
    lead, trail = (x if SUBSTITUTIONS.keys() >= set(x) else "" for x in (lead, trail))
    return sorted({lead + word, word + trail, lead + word + trail} - {word})


def folded_words(text: str) -> Words:
    """Words of the original text (letters, with substituted signs inside),
    folded.  Boundaries come from the original, so signs around a word stay
    outside it; its forms with them are in ``more``."""
    tokens = _TOKEN.findall(text)
    plain = [t.strip(_EDGE) for t in tokens]
    out = Words(fold("\n".join(plain)).split("\n"))
    if tokens != plain:
        out.more = [(k, fold(f)) for k, (t, w) in enumerate(zip(tokens, plain, strict=True)) if len(t) != len(w) for f in edge_forms(t, w)]
    return out


def terms_of(words: Iterable[str]) -> set[str]:
    """Whole words (``word$``) and word starts (``word``) of a document."""
    out = set()
    for w in set(words):
        out.add(w + "$")
        out.update(w[:k] for k in PREFIX_LENGTHS if k <= len(w))
    return out


def cut_to(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is among the ``n`` ``ids``, and a few
    others: a bitmap of hashed ids, broadcast in blocks of 4 KB and bounded by
    ``MOST_BITS``.  Keeps the texts of most other rows out of the shuffle."""
    bits = 1 << 15
    while bits < min(MOST_BITS, BITS_AN_ID * n):
        bits *= 2
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    blocks = ids.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("_block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("_bits"))
    place = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = docs.withColumn("_block", F.bitmap_bucket_number(bit)).join(F.broadcast(blocks), "_block")
    return met.where(F.getbit(byte, (place % 8).cast("int")) == 1).drop("_block", "_bits")


def labelled(docs: DataFrame, labels: DataFrame, column: str = "toxic") -> DataFrame:
    """``text, label``, stored: labelled documents whose crc32(doc_id as text) mod
    4 is not 2, about ``FIT_ROWS`` of them at most."""
    sure = (labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
            .select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).alias("_label")).where(~held_out())
            .groupBy("doc_id").agg(F.min("_label").alias("label"), F.max("_label").alias("_max")).where("label = _max").drop("_max"))
    sure = common.stored(sure, "toxicity_labels")
    n = sure.count()
    if n > FIT_ROWS:
        sure = sure.where(common.md5_fraction(F.col("doc_id"), "fit") < FIT_ROWS / n)
    train = cut_to(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(~held_out()), sure, n)
    return common.stored(train.join(sure, "doc_id").select("text", (F.col("label") > 0).cast("int").alias("label")), "toxicity_rows")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = (Counter(), Counter())

    def flush():
        for label, c in enumerate(counts):
            if c:
                yield pa.RecordBatch.from_pydict({"term": list(c), "label": pa.array([label] * len(c), pa.int32()),
                                                  "n": pa.array(list(c.values()), pa.int64())})
                c.clear()

    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            counts[label].update(terms_of(folded_words(text or "").every()) - {"$"})
            counts[label]["\n"] += 1  # the number of documents
            if len(counts[label]) > FLUSH_TERMS:
                yield from flush()
    yield from flush()


def choose_lexicon(rows: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Term -> weight (log-odds) from ``(term, toxic documents, clean documents)``.

    A word start is replaced by a longer one that is met in the same toxic
    documents, and a longer term goes when a shorter kept one is as telling."""
    odds = {t: math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1)) for t, a, b in rows}
    count = {t: a for t, a, _ in rows}
    good = {t for t, x in odds.items() if x >= MIN_LOG_ODDS and count[t] >= MIN_SUPPORT}
    for t in [x for x in good if x[-1] != "$" and len(x) > PREFIX_LENGTHS[0]]:
        if t[:-1] in good and count[t] >= 0.98 * count[t[:-1]] and odds[t] >= odds[t[:-1]] - 0.05:
            good.discard(t[:-1])
    kept = {t for t in good if not any(t[:k] in good and odds[t[:k]] >= odds[t] - 0.5 for k in range(PREFIX_LENGTHS[0], len(t)))}
    return {t: odds[t] for t in sorted(kept)}


def learn_lexicon(train: DataFrame) -> tuple[dict[str, float], int, int]:
    """The lexicon and the numbers of toxic and clean training documents.  Terms
    with the support and the odds reach the driver."""
    n = (train.mapInArrow(_count_terms, "term string, label int, n long").groupBy("term")
         .agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("a"),
              F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("b"))
         .where((F.col("term") == "\n") | (F.col("a") >= MIN_SUPPORT)))
    n = common.stored(n, "toxicity_terms")
    totals = n.where(F.col("term") == "\n").collect()
    toxic, clean = (totals[0].a, totals[0].b) if totals else (0, 0)
    if not toxic or not clean:
        return {}, toxic, clean
    odds = F.log((F.col("a") + 0.5) / (toxic + 1.0)) - F.log((F.col("b") + 0.5) / (clean + 1.0))
    good = n.where(F.col("term") != "\n").where(odds >= MIN_LOG_ODDS - 1e-9).select("term", "a", "b")
    return choose_lexicon([tuple(r) for r in good.collect()], toxic, clean), toxic, clean


def _best(found: list[tuple[int, str, float]]) -> list[tuple[int, float]]:
    best: dict[int, float] = {}
    for k, _, weight in found:
        best[k] = max(best.get(k, 0.0), weight)
    return sorted(best.items())


def phrases_of(words: list[str], k: int, form: str) -> list[str]:
    """A form of word ``k`` with the forms of its neighbour words."""
    forms = lambda n: [words[n], *(f for m, f in getattr(words, "more", ()) if m == n)]
    before = [f"{w} {form}" for w in forms(k - 1)] if k else []
    return before + ([f"{form} {w}" for w in forms(k + 1)] if k + 1 < len(words) else [])


class Matcher:
    """Aho-Corasick over the lexicon and the exception phrases."""

    def __init__(self, lexicon: dict[str, float], exceptions: Iterable[str] = ()):
        self.lexicon = lexicon
        self.exceptions = frozenset(exceptions)
        self.auto = ahocorasick.Automaton()
        for term, weight in lexicon.items():
            self.auto.add_word("\n" + term.replace("$", "\n"), (weight, len(term.rstrip("$"))))
        if lexicon:
            self.auto.make_automaton()

    def _found(self, joined: str) -> dict[int, float]:
        """Place of each word of ``joined`` that has a term: its best weight."""
        found: dict[int, float] = {}
        for end, (weight, length) in self.auto.iter(joined):
            start = end - length + (joined[end] != "\n")
            found[start] = max(found.get(start, 0.0), weight)
        return found

    def form_hits(self, words: list[str]) -> list[tuple[int, str, float]]:
        """(word number, form, weight) of each form of a word that has a term."""
        if not self.lexicon:
            return []
        joined = "\n" + "\n".join(words) + "\n"
        found = self._found(joined)
        out, counted, at = [], 0, 0
        for start in sorted(found):
            counted += joined.count("\n", at, start)
            at = start
            out.append((counted - 1, words[counted - 1], found[start]))
        for k, form in getattr(words, "more", ()):
            out += [(k, form, weight) for weight in self._found(f"\n{form}\n").values()]
        return out

    def hits(self, words: list[str]) -> list[tuple[int, float]]:
        """(word number, weight) of each word that has a term; its best term counts."""
        return _best(self.form_hits(words))

    def counted(self, words: list[str]) -> list[tuple[int, float]]:
        """The hits that no exception phrase covers."""
        found = self.form_hits(words)
        if not found or not self.exceptions:
            return _best(found)
        return _best([x for x in found if not any(p in self.exceptions for p in phrases_of(words, x[0], x[1]))])

    def strength(self, text: str | None) -> float:
        words = folded_words(text or "")
        found = self.counted(words)
        return sum(w for _, w in found) / math.sqrt(len(words)) if found else 0.0


def learn_exceptions(train: DataFrame, lexicon: dict[str, float]) -> list[str]:
    """Neighbour phrases of hits that are met in ``MIN_SUPPORT`` clean documents
    or more and at most as often in toxic ones."""
    if not lexicon:
        return []

    def phrases(batches):
        matcher = Matcher(lexicon)
        for batch in batches:
            seen, label_of = [], []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                words = folded_words(text or "")
                own = set()
                for k, form, _ in matcher.form_hits(words):
                    own.update(phrases_of(words, k, form))
                seen += sorted(own)
                label_of += [label] * len(own)
            yield pa.RecordBatch.from_pydict({"phrase": pa.array(seen, pa.string()), "label": pa.array(label_of, pa.int32())})

    rows = (train.mapInArrow(phrases, "phrase string, label int").groupBy("phrase")
            .agg(F.sum("label").alias("a"), F.count("*").alias("n")).where(F.col("n") - F.col("a") >= F.greatest(F.lit(MIN_SUPPORT), F.col("a"))))
    return sorted(r.phrase for r in rows.select("phrase").collect())


def fit_curve(bins: list[tuple[int, int, int]], toxic: int, clean: int) -> tuple[float, float]:
    """Logistic curve ``a + b * strength`` from ``(bin, label, documents)``,
    by damped Newton steps with a small ridge.  Covers all training rows."""
    prior = math.log((toxic + 0.5) / (clean + 0.5))
    if not bins or not toxic or not clean:
        return prior, 0.0
    x, y, n = (np.array(v, float) for v in zip(*bins, strict=True))
    x = x * BIN_WIDTH
    beta = np.array([prior, 1.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(beta[0] + beta[1] * x, -30, 30)))
        grad = np.array([(n * (y - p)).sum(), (n * (y - p) * x).sum()]) - 0.01 * beta
        w = n * p * (1 - p)
        hess = np.array([[w.sum(), (w * x).sum()], [(w * x).sum(), (w * x * x).sum()]]) + 0.01 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta + step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(max(0.0, beta[1]))


def fit(docs: DataFrame, labels: DataFrame, exceptions: Iterable[str] = ()) -> dict:
    """The model: lexicon, exception phrases and curve."""
    common.small_batches(docs.sparkSession)
    train = labelled(docs, labels)
    lexicon, toxic, clean = learn_lexicon(train)
    phrases = sorted({*learn_exceptions(train, lexicon), *exceptions})

    def strengths(batches):
        matcher = Matcher(lexicon, phrases)
        for batch in batches:
            bins = [round(matcher.strength(t) / BIN_WIDTH) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(bins, pa.int32()), batch.column("label")], names=["bin", "label"])

    bins = [] if not lexicon else train.mapInArrow(strengths, "bin int, label int").groupBy("bin", "label").count().collect()
    a, b = fit_curve([tuple(r) for r in bins], toxic, clean)
    return {"lexicon": lexicon, "exceptions": phrases, "curve": (a, b)}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``strength`` and ``n_hits`` of every row."""
    common.small_batches(docs.sparkSession)
    a, b = model["curve"]

    def scored(batches):
        matcher = Matcher(model["lexicon"], model["exceptions"])
        for batch in batches:
            strengths, hits = [], []
            for text in batch.column("text").to_pylist():
                words = folded_words(text or "")
                found = matcher.counted(words)
                hits.append(len(found))
                strengths.append(sum(w for _, w in found) / math.sqrt(len(words)) if found else 0.0)
            s = np.array(strengths, float)
            value = 1 / (1 + np.exp(-np.clip(a + b * s, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(value), pa.array(s), pa.array(hits, pa.int64())],
                names=["doc_id", "held_out", "score", "strength", "n_hits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, score double, strength double, n_hits long")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_hits")
