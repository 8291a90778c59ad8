"""Fee-detail operators: latest detail per claim and fee totals per submission.

Totals are pre-aggregated per claim before they meet the claim table, so the
big join carries one row per claim rather than one per fee detail, and the
per-submission sum is partial-aggregated on the map side (a submission with
a third of all claims does not land whole in one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimsflow.functions.money import num
from claimsflow.operators.submissions import VALID, claims_of


def latest_fee(fee: DataFrame) -> DataFrame:
    """WIN-1: per claim the detail with the newest COALESCE(updated_on, created_on),
    nulls last; ties go to the highest id (D4).  Keeps every detail column."""
    ts = F.coalesce(F.col("updated_on"), F.col("created_on"))
    w = Window.partitionBy("claim_id").orderBy(ts.desc_nulls_last(), F.col("id").desc())
    return (fee.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def _amount_per_claim(fee: DataFrame, zero_nulls: bool) -> DataFrame:
    amount = num(F.col("total_amount"))
    if zero_nulls:
        amount = F.coalesce(amount, F.lit(0))
    return fee.groupBy("claim_id").agg(F.sum(amount).alias("claim_amount"))


def fee_totals_by_submission(claim: DataFrame, fee: DataFrame) -> DataFrame:
    """SUM(COALESCE(total_amount, 0)) over every fee detail of every claim (any
    status), per submission; submissions without fee details get no row.
    Claims are shuffled once, by claim id, to meet the per-claim sums."""
    claims = claim.select(F.col("id").alias("claim_id"), "submission_id")
    per_claim = _amount_per_claim(fee, zero_nulls=True)
    return (claims.join(per_claim, "claim_id", "inner")
            .groupBy("submission_id")
            .agg(F.sum("claim_amount").alias("total_fee")))


def fee_totals(claim: DataFrame, fee: DataFrame, chosen: DataFrame) -> DataFrame:
    """AGG-2 + JN-5 + JN-3: REP012's fee totals of the chosen submissions.
    The semi join restricts the per-submission sums (one row per submission),
    not the claim table."""
    return claims_of(fee_totals_by_submission(claim, fee), chosen)


def valid_totals_by_submission(claim: DataFrame, fee: DataFrame) -> DataFrame:
    """SUM(total_amount) over every VALID claim's fee details, per submission
    (null when there is nothing to sum).  Claims are shuffled once, by claim
    id, to meet the per-claim sums; the per-submission sum is then partially
    aggregated, so a submission with a third of all claims is pre-summed on
    every map task."""
    valid = claim.where(F.col("status") == VALID).select(F.col("id").alias("claim_id"), "submission_id")
    per_claim = _amount_per_claim(fee, zero_nulls=False)
    return (valid.join(per_claim, "claim_id", "left")
            .groupBy("submission_id")
            .agg(F.sum("claim_amount").alias("total_amount")))


def submission_totals(current: DataFrame, claim: DataFrame, fee: DataFrame) -> DataFrame:
    """AGG-3 + JN-6: REP013's SUM(total_amount) over VALID claims' fee details,
    null when nothing is summed; every current submission keeps a row."""
    keys = current.select(F.col("id").alias("submission_id"))
    return keys.join(valid_totals_by_submission(claim, fee), "submission_id", "left")
