"""Rows a run could not post."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.operators.staging import without_rows

# What is written for each kind of row, and the longest message kept.
NO_BILL = "RecurringApprove : Billing Konsong setelah CreateBilling, untuk PolisID '{}'"
OTHER_PAID = "BillOtherApprove : Billing Other sudah Paid"
QUOTE_PAID = "QuoteApprove : Billing Quote sudah Paid"
MESSAGE_LIMIT = 300


def short_message(message: Column) -> Column:
    """Messages of 300 characters or more are cut to 299."""
    return F.when(F.length(message) < MESSAGE_LIMIT, message).otherwise(F.left(message, F.lit(MESSAGE_LIMIT - 1)))


def post_errors(allocated: DataFrame, routed: DataFrame, posted_claims: DataFrame) -> DataFrame:
    """One error per row that found nothing to pay.

    ``allocated`` are the policy rows (with a NULL ``bill_id`` when there was no bill left), ``routed``
    the one-off and quote rows, ``posted_claims`` the files and ids of those that were posted.
    """
    before, after = NO_BILL.split("{}")
    policy_id = F.col("PolisId").cast("string")
    surplus = allocated.where(F.col("bill_id").isNull()).select(
        "FileName", "id", "trancode", "PolisNo", "IsSukses", F.concat(F.lit(before), policy_id, F.lit(after)).alias("_m")
    )
    # joined on file and row id, which no row shares: a bill paid many times over stays balanced
    unpaid = without_rows(routed.where(F.col("route").isin("other", "quote")), posted_claims)
    refused = unpaid.select(
        "FileName", "id", "trancode", "PolisNo", "IsSukses",
        F.when(F.col("route") == "other", F.lit(OTHER_PAID)).otherwise(F.lit(QUOTE_PAID)).alias("_m"),
    )
    return surplus.unionByName(refused).withColumn("ErrorMessage", short_message(F.col("_m"))).drop("_m")
