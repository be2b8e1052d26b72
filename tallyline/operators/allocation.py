"""Allocating payments and rejections to open bills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.skew import (
    DEFAULT,
    SkewPolicy,
    find_hot,
    hot_on_either_side,
    lookup_join,
    pair_by_rank,
    rank_rows,
)
from tallyline.operators.staging import ROW
from tallyline.session import materialize

# Fixed value: status of a bill or quote that can still be paid.
OPEN = ("A", "C")


def open_bills(bills: DataFrame) -> DataFrame:
    return bills.where(F.col("status_billing").isin(*OPEN))


def _lowest_bill(bills: DataFrame, names: list[str]) -> DataFrame:
    """The lowest-sequence bill of each policy, by aggregation: no policy has to fit one task."""
    carried = [n for n in names if n not in ("policy_id", "recurring_seq", "BillingID")]
    first = F.min(F.struct("recurring_seq", "BillingID", *carried))
    return bills.groupBy("policy_id").agg(first.alias("_b")).select("policy_id", "_b.*").select(*names)


def first_open_bill(policy_billing: DataFrame, bills: DataFrame) -> DataFrame:
    """Per policy the open bill with the lowest sequence."""
    names = ["policy_id", "BillingID", "recurring_seq", "cashless_fee_amount", "freq_payment"]
    first = _lowest_bill(open_bills(bills), names)
    return first.join(policy_billing.select("policy_id").distinct(), "policy_id", "left_semi")


def unclaimed_open_bill(policy_billing: DataFrame, bills: DataFrame, staged: DataFrame) -> DataFrame:
    """Per policy the first open bill that no staged policy row claims."""
    claimed = (
        staged.where((F.col("BillCode") == "B") & F.col("BillingID").isNotNull())
        .select(F.col("BillingID").try_cast("bigint").alias("BillingID"))
        .distinct()
    )
    free = open_bills(bills).join(claimed, "BillingID", "left_anti")
    return first_open_bill(policy_billing, free).select("policy_id", "BillingID", "recurring_seq")


def _slots(bills: DataFrame) -> DataFrame:
    """Open bills as slots to pair with payments; account columns are told apart from the payment's."""
    return open_bills(bills).select(
        F.col("policy_id").alias("PolisId"),
        F.col("BillingID").alias("bill_id"),
        "recurring_seq",
        "TotalAmount",
        "cashless_fee_amount",
        "freq_payment",
        "due_dt_pre",
        F.col("AccNo").alias("bill_AccNo"),
        F.col("AccName").alias("bill_AccName"),
        "BillingDate",
    )


def allocate_approved(
    pool: DataFrame,
    bills: DataFrame,
    new_bills: DataFrame | None = None,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """The k-th payment of a policy (by amount) pays its k-th open bill (by sequence).

    This is what paying the rows one after another gives, each taking the lowest open bill and
    closing it. Rows beyond the last open bill keep a NULL ``bill_id``. ``new_bills`` are bills made
    up front for policies that run out. The pool is read twice, by the search for heavy policies and by the
    pairing, so a pool that takes joins to make is better stored before.
    """
    if new_bills is not None:
        bills = bills.select(*new_bills.columns).unionByName(new_bills)
    rows, slots = pool.where(F.col("PolisId").isNotNull()).drop("BillingID"), _slots(bills)
    hot = hot_on_either_side(rows, slots, "PolisId", ROW, ["bill_id"], policy)
    paired = pair_by_rank(rows, slots, "PolisId", ["Amount", *ROW], ["recurring_seq", "bill_id"], hot)
    return paired.withColumn("amount_diff", F.col("Amount") - F.col("TotalAmount"))


# --- rejections ------------------------------------------------------------------------------

def _pending_rejects(staged: DataFrame) -> DataFrame:
    return staged.where(~F.col("IsSukses") & ~F.col("IsExec") & F.col("PolisId").isNotNull())


def reject_open_bills(staged: DataFrame, bills: DataFrame) -> DataFrame:
    """Open bills of the policies with a rejected row."""
    policies = _pending_rejects(staged).select(F.col("PolisId").alias("policy_id")).distinct()
    return open_bills(bills).join(policies, "policy_id", "left_semi").select("policy_id", "BillingID", "recurring_seq")


def rank_reject_bills(staged: DataFrame, bills: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    found = materialize(reject_open_bills(staged, bills))
    hot = find_hot(found, "policy_id", ["BillingID"], policy)
    return rank_rows(found, "policy_id", ["recurring_seq", "BillingID"], "seqno", hot)


def _policy_rejects(staged: DataFrame) -> DataFrame:
    return _pending_rejects(staged).where(F.col("BillCode") == "B")


def rank_rejects(staged: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    rows = _policy_rejects(staged).select(*ROW, "PolisId", "Amount")
    return rank_rows(rows, "PolisId", ["Amount", *ROW], "seqno", find_hot(rows, "PolisId", ROW, policy))


def paired_rejects(staged: DataFrame, bills: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Rejected policy rows next to their open bill (``bill_id``): k-th row to k-th bill, or NULL."""
    # stored, narrow: the search for heavy policies and the ranking read it, not the joins behind it
    slots = materialize(reject_open_bills(staged, bills)).select(
        F.col("policy_id").alias("PolisId"), F.col("BillingID").alias("bill_id"), "recurring_seq"
    )
    rows = _policy_rejects(staged)
    hot = hot_on_either_side(rows, slots, "PolisId", ROW, ["bill_id"], policy)
    return pair_by_rank(rows, slots, "PolisId", ["Amount", *ROW], ["recurring_seq", "bill_id"], hot)


def allocate_rejected(staged: DataFrame, bills: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Rejected policy rows with the bill they concern; surplus rows keep what they had."""
    bill = F.coalesce(F.col("bill_id").cast("string"), F.col("BillingID"))
    return paired_rejects(staged, bills, policy).withColumn("BillingID", bill).select(*staged.columns)


# --- one-off bills and quotes ----------------------------------------------------------------

def first_claim(pool: DataFrame) -> DataFrame:
    """The first row (by file and id) of every one-off bill and quote; later ones find it paid."""
    names = [n for n in pool.columns if n not in (*ROW, "BillCode", "BillingID")]
    first = F.min(F.struct(*ROW, *names)).alias("_row")
    return (
        pool.where((F.col("BillCode") != "B") & F.col("BillingID").isNotNull())
        .groupBy("BillCode", "BillingID")
        .agg(first)
        .select("BillCode", "BillingID", "_row.*")
        .select(*pool.columns)
    )


def _open_others(billing_others: DataFrame) -> DataFrame:
    found = billing_others.where(F.col("status_billing").isin(*OPEN))
    return found.select(
        "BillingID", "BillingType", F.col("policy_id").alias("bill_policy_id"), "TotalAmount", "CoreTranID"
    )


def _open_quotes(quote_billing: DataFrame) -> DataFrame:
    return quote_billing.where(F.col("status").isin(*OPEN)).select(F.col("quote_id").cast("string").alias("BillingID"))


def _of_code(pool: DataFrame, code: str) -> DataFrame:
    return pool.where((F.col("BillCode") == code) & F.col("BillingID").isNotNull())


def other_unpaid(pool: DataFrame, billing_others: DataFrame) -> DataFrame:
    """Rows whose one-off bill is still open, with its type, policy and amount."""
    return lookup_join(_of_code(pool, "A"), _open_others(billing_others), ["BillingID"], "inner")


def quote_unpaid(pool: DataFrame, quote_billing: DataFrame) -> DataFrame:
    """Rows whose quote is still open."""
    return lookup_join(_of_code(pool, "Q"), _open_quotes(quote_billing), ["BillingID"], "left_semi")


def claim_others(pool: DataFrame, billing_others: DataFrame) -> DataFrame:
    """First row of each open one-off bill. One row per bill on both sides, so nothing can be skewed."""
    return first_claim(_of_code(pool, "A")).join(_open_others(billing_others), "BillingID")


def claim_quotes(pool: DataFrame, quote_billing: DataFrame) -> DataFrame:
    return first_claim(_of_code(pool, "Q")).join(_open_quotes(quote_billing), "BillingID", "left_semi")


