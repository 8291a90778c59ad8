"""The corpus pipeline: language ID, near duplicates, decontamination, PII, mixing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes
what a stage returns to the shared checkpoint folder and hands the next stage what
it reads back.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsflow.llm import common, decontaminate, language, mixing, near_duplicates, pii


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; ``lang`` becomes the language found.
    Rows are judged by id and text: equal rows are judged alike."""
    keyed = docs.select("doc_id", F.md5("text").alias("text_key"), "text", "lang", "source")
    rows = keyed.select("doc_id", "text_key", "text", F.col("lang").alias("declared"), F.col("source").alias("host"))
    # Dealt by document: the join by host would leave a hot host in one task.
    judged = language.identify(rows).where("kept").repartition("doc_id", "text_key")
    found = judged.groupBy("doc_id", "text_key", "declared", "host").agg(F.first("language").alias("language"))
    found = found.select(*[F.col(c).alias(f"_{c}") for c in found.columns])
    # The evidence holds lower-cased declarations and hosts; compare alike.
    declared = language.code_of(F.col("lang"))
    host = F.lower(F.trim("source"))
    same = (docs["doc_id"].eqNullSafe(F.col("_doc_id")) & (F.md5(docs["text"]) == F.col("_text_key"))
            & declared.eqNullSafe(F.col("_declared")) & F.when(host != "", host).eqNullSafe(F.col("_host")))
    return docs.join(found, same).withColumn("lang", F.col("_language")).select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_duplicates.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    hidden = pii.redact(docs, pii.fit(docs))
    return hidden.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else hidden


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target mix draws, with weight and probability."""
    return mixing.mix(docs).where("sampled").drop("sampled")


STAGES = [("language_id", language_id), ("jaccard_join", jaccard_join), ("decontamination", decontamination),
          ("personal_data", personal_data), ("source_mix", source_mix)]

# The trained and iterative stages cannot be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return docs
