"""URL filtering by association rules (operator 9).

Listed rules (host, path) decide first.  For other urls, Spark's FP-growth mines
combinations of url tokens that go with the label ``block`` or ``allow``; rules
under the support and confidence bounds, and rules that a shorter one makes
needless, are pruned.  The support asked for is ``MIN_ROWS`` labelled pages, however
many there are.  Tokens of the very same labelled pages share a name, rules are made
of names, and a url has a name if it has any of its tokens.  An inverted index files
each mined rule under its rarest name; a url meets the rules of its names there and
must have all names of a rule.  The surest rule wins, then the one with more support,
then ``block``.  DataFrame functions and Spark ML only.

Labels for mining: the verdict of the listed rules where one fits, else the
``labels`` row of the page's id (bad or toxic: block).

Defined results: a null url, or one without ``://``, has empty host and path, no
tokens and is allowed.  Repeated rows are judged one by one, equal urls alike.
With fewer than ``MIN_ROWS`` labelled pages nothing is mined and the default, allow, holds.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsflow.llm import common

# Fixed by the task: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MIN_ROWS = 5
MIN_CONFIDENCE = 0.7
#: Tokens of a mined rule, and path segments of a url that become tokens of their own place.
MAX_TOKENS = 3
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def listed(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as text, verdict) of the longest rule that fits, else nulls."""
    name = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: scheme, host labels, site, suffix, path segments (numbers
    as ``#``), file ending, query keys, fragment or not."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    segments = F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), lambda x: F.regexp_replace(F.lower(x), "[0-9]+", "#"))
    scheme = F.lower(F.substring_index(url, "://", 1))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)
    named = lambda kind, xs: F.transform(xs, lambda x: F.concat(F.lit(kind + ":"), x))
    one = lambda kind, x: F.when(x != "", F.array(F.concat(F.lit(kind + ":"), x))).otherwise(F.array().cast("array<string>"))
    every = F.concat(one("scheme", scheme), named("label", labels), one("site", F.substring_index(host, ".", -2)), one("suffix", F.substring_index(host, ".", -1)),
                     one("first", F.get(segments, F.lit(0))), named("segment", segments), one("ending", F.lower(ending)), named("key", keys),
                     F.when(F.contains(url, F.lit("#")), F.array(F.lit("fragment:yes"))).otherwise(F.array().cast("array<string>")))
    return F.when(host != "", F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def parsed(pages: DataFrame) -> DataFrame:
    """``page_id, url, host, path, rule, rule_verdict``."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url").withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    name, verdict = listed(F.col("host"), F.col("path"))
    return base.withColumns({"rule": name, "rule_verdict": verdict})


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``items`` (tokens and one label item) of every labelled page."""
    bad = (F.max(F.coalesce("toxic", F.lit(0))) > 0) | (F.min(F.coalesce("quality", F.lit(1))) == 0)
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("page_id")).agg(F.when(bad, "block").otherwise("allow").alias("told"))
    rows = pages.join(known, "page_id", "left").withColumn("label", F.coalesce("rule_verdict", "told")).where("label IS NOT NULL")
    made = tokens(F.col("url"), F.col("host"), F.col("path"))
    return rows.select(F.concat(made, F.array(F.concat(F.lit("="), F.col("label")))).alias("items"))


def together(items: DataFrame, rows: int) -> DataFrame:
    """``token, name``: the tokens of ``rows`` labelled pages or more; those of
    the very same pages share a name, so that FP-growth does not enumerate the
    subsets of tokens that always come together."""
    spread = items.select("row", F.explode("items").alias("token")).where(~F.col("token").startswith("="))
    seen = spread.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("row")).alias("x"), F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("s"))
    seen = seen.where(F.col("n") >= rows)
    first = seen.groupBy("n", "x", "s").agg(F.min("token").alias("name"))
    return seen.join(first, ["n", "x", "s"]).select("token", "name")


class Mined(NamedTuple):
    """``rules``: ``rule_id, names, verdict, confidence, support``; ``names``:
    ``token, name``.  A rule fits a url that has a token of each of its names."""

    rules: DataFrame
    names: DataFrame


_RULE_SCHEMA = T.StructType([T.StructField("names", T.ArrayType(T.StringType())), T.StructField("verdict", T.StringType()),
                             T.StructField("confidence", T.DoubleType()), T.StructField("support", T.DoubleType()),
                             T.StructField("rule_id", T.LongType())])


def mine(items: DataFrame, min_rows: int = MIN_ROWS, min_confidence: float = MIN_CONFIDENCE, max_tokens: int = MAX_TOKENS) -> Mined:
    """The pruned rules, and the names that they are made of."""
    spark = items.sparkSession
    items = common.stored(items.withColumn("row", F.monotonically_increasing_id()), "url_items")
    n = items.count()
    if n < max(1, min_rows):
        return Mined(spark.createDataFrame([], _RULE_SCHEMA), spark.createDataFrame([], "token string, name string"))
    names = common.stored(together(items, min_rows), "url_names")
    spread = items.select("row", F.explode("items").alias("token"))
    named = (spread.join(names, "token").select("row", "name")
             .union(spread.where(F.col("token").startswith("=")).select("row", F.col("token").alias("name"))))
    baskets = common.stored(named.groupBy("row").agg(F.collect_set("name").alias("items")).select("items"), "url_baskets")
    # Half a row less: the share times the rows must not come out above ``min_rows``.
    mined = FPGrowth(itemsCol="items", minSupport=(min_rows - 0.5) / n).fit(baskets).freqItemsets
    mined = mined.where(F.size("items") <= max_tokens + 1).select(
        F.array_sort(F.filter("items", lambda x: ~x.startswith("="))).alias("names"),
        F.get(F.filter("items", lambda x: x.startswith("=")), F.lit(0)).alias("label"), "freq")
    mined = common.stored(mined.where((F.size("names") > 0) & (F.size("names") <= max_tokens)), "url_itemsets")
    every = mined.where("label IS NULL").select("names", F.col("freq").alias("met"))
    rules = (mined.where("label IS NOT NULL").join(every, "names")
             .select("names", F.substring("label", 2, 10).alias("verdict"), (F.col("freq") / F.col("met")).alias("confidence"), (F.col("freq") / F.lit(n)).alias("support"))
             .where(F.col("confidence") >= min_confidence))
    rules = common.stored(rules.withColumn("rule_id", F.xxhash64("names", "verdict")), "url_rules")
    # A rule is needless if a part of its names is a rule that is as sure: looked
    # up by the rule's own subsets, at most 2 ** max_tokens.
    subsets = F.expr("transform(sequence(1, shiftleft(1, size(names)) - 2), b -> filter(names, (t, i) -> (shiftright(b, i) & 1) = 1))")
    longer = rules.where(F.size("names") > 1).select(F.explode(subsets).alias("part"), "rule_id", "verdict", "confidence")
    shorter = rules.select(F.col("names").alias("part"), F.col("verdict").alias("v"), F.col("confidence").alias("c"))
    needless = longer.join(shorter, "part").where((F.col("v") == F.col("verdict")) & (F.col("c") >= F.col("confidence"))).select("rule_id").distinct()
    return Mined(common.stored(rules.join(needless, "rule_id", "left_anti"), "url_kept_rules"), names)


def match(urls: DataFrame, mined: Mined) -> DataFrame:
    """``url, mined`` (verdict) of the distinct urls that a rule fits."""
    rules, names = mined
    wanted = rules.select(F.explode("names").alias("name")).distinct()
    asked = names.join(wanted, "name", "left_semi")
    tokened = urls.select("url", F.explode(tokens(F.col("url"), F.col("host"), F.col("path"))).alias("token"))
    has = tokened.join(asked, "token").groupBy("url").agg(F.collect_set("name").alias("has"))
    spread = has.select("url", "has", F.explode("has").alias("name"))
    rarity = spread.groupBy("name").agg(F.count("*").alias("n"))
    filed = (rules.select("rule_id", "names", "verdict", "confidence", "support", F.explode("names").alias("name"))
             .join(rarity, "name", "left").groupBy("rule_id", "names", "verdict", "confidence", "support")
             .agg(F.min_by("name", F.struct(F.coalesce("n", F.lit(0)), "name")).alias("name")))
    met = spread.join(filed, "name").where(F.size(F.array_except("names", "has")) == 0)
    best = F.max_by("verdict", F.struct("confidence", "support", "verdict", "names"))
    return met.groupBy("url").agg(best.alias("mined"))


def judge(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page."""
    rows = parsed(pages)
    mined = mine(labelled(rows, labels))
    found = match(rows.where("rule IS NULL AND host <> ''").select("url", "host", "path"), mined)
    out = rows.join(found, "url", "left")
    verdict = F.coalesce("rule_verdict", "mined", F.lit(DEFAULT))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "pages"), common.table(spark, sf_dir, "labels"))
