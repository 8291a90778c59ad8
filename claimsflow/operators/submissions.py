"""Which submissions each report counts.

each rule is its own operator and they are not unified.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimsflow.functions.periods import period_date_wide
from claimsflow.functions.text import canonical_area

SUCCEEDED = "VALIDATION_SUCCEEDED"
VALID = "VALID"
# Fixed value lists of the reference reports.
REP012_AREAS = ("CIVIL", "CRIME LOWER", "MEDIATION")  # exact case, no LEGAL HELP
REP013_AREAS = ("CIVIL", "CRIME", "MEDIATION")  # after canonical_area


def pick_latest(sub: DataFrame, on_bad_period: str = "error") -> DataFrame:
    """WIN-2: one submission per (office, area, period date): newest created_on,
    then highest id.  Only succeeded submissions of the three REP012 areas with
    a readable period take part.

    The ``rn = 1`` filter lets Catalyst insert a partial WindowGroupLimit before
    the shuffle, so a hot (office, area, period) group is cut to one row per map
    task before it is exchanged.
    """
    sn = sub.select(
        F.col("id").alias("submission_id"),
        "office_account_number", "area_of_law", "created_on", "status",
        period_date_wide(F.col("submission_period"), on_bad_period).alias("submission_period_date"),
    )
    eligible = sn.where(
        (F.col("status") == SUCCEEDED)
        & F.col("area_of_law").isin(*REP012_AREAS)
        & F.col("submission_period_date").isNotNull())
    w = Window.partitionBy("office_account_number", "area_of_law", "submission_period_date") \
        .orderBy(F.col("created_on").desc(), F.col("submission_id").desc())
    return (eligible.withColumn("rn", F.row_number().over(w))
            .where(F.col("rn") == 1)
            .select("submission_id", "office_account_number", "area_of_law",
                    "submission_period_date", "created_on"))


def claims_of(claim: DataFrame, chosen: DataFrame) -> DataFrame:
    """JN-3: claims whose submission is among ``chosen`` (``IN (SELECT …)``)."""
    keys = chosen.select(F.col("submission_id"))
    return claim.join(keys, "submission_id", "left_semi")


def valid_counts(claim: DataFrame, chosen: DataFrame) -> DataFrame:
    """AGG-1: per chosen submission, ``COUNT(*) FILTER (WHERE status='VALID')``.

    REP012 computes this and never prints it; it is kept as an operator only.
    Claims are counted first (partial sums before the shuffle), then the
    one-row-per-submission counts are restricted, so a hot submission never
    goes whole through one task.
    """
    counted = (claim.groupBy("submission_id")
               .agg(F.count_if(F.col("status") == VALID).alias("valid_claim_count")))
    return claims_of(counted, chosen)


def current_submissions(sub: DataFrame) -> DataFrame:
    """JN-4 + FLT-3 + PRJ-6: succeeded submissions that no other submission
    replaces, in the three REP013 areas after canonicalisation.

    The newer row's status is not looked at: a failed replacement still hides
    the original, as in the reference.
    """
    newer = (sub.where(F.col("previous_submission_id").isNotNull())
             .select(F.col("previous_submission_id").alias("id")))
    canon = sub.where(F.col("status") == SUCCEEDED).select(
        "id", "office_account_number",
        canonical_area(F.col("area_of_law")).alias("area_of_law"),
        "is_nil_submission", "submission_period", "created_on")
    return (canon.where(F.col("area_of_law").isin(*REP013_AREAS))
            .join(newer, "id", "left_anti"))
