"""Mapping staged rows to a policy, a one-off bill or a quote, and to a reject reason."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.skew import lookup_join

# First letter of the reference number -> what it refers to.
OTHER_LETTER, QUOTE_LETTER = "A", "X"


def _letter() -> Column:
    return F.left(F.col("PolisNo"), F.lit(1))


def _open() -> Column:
    """Not posted and not mapped yet."""
    return ~F.col("IsExec") & F.col("PolisId").isNull() & F.col("BillingID").isNull()


def _quote_number(c: Column) -> Column:
    """Number after the last X, NULL when there is none or it is beyond a bigint. Leading zeros don't
    count. The test keeps texts away from the cast, which is slow at refusing them."""
    digits = F.regexp_replace(F.substring_index(c, QUOTE_LETTER, -1), "^0+(?=[0-9])", "")
    return F.when(digits.rlike("^[0-9]{1,19}$"), digits.try_cast("bigint"))


def _probe(c: Column) -> Column:
    """One join key for all four mappings: the reference number, with numeric quote references in
    their shortest form (X007 -> X7), so that one shuffle of the rows serves every lookup."""
    number = _quote_number(c)
    quote = F.left(c, F.lit(1)) == QUOTE_LETTER
    return F.when(quote & number.isNotNull(), F.concat(F.lit(QUOTE_LETTER), number.cast("string"))).otherwise(c)


# What each reference table offers the probe key. Together they form one lookup with one row per
# key; where several rows share a key the lowest id counts.

def _policies(policy_billing: DataFrame) -> DataFrame:
    return policy_billing.select(F.col("policy_no").alias("_k"), F.col("policy_id").alias("_policy"))


def _others(billing_others: DataFrame) -> DataFrame:
    return billing_others.select(F.col("BillingID").alias("_k"), F.col("BillingID").alias("_other"))


def _quote_ids(quote_billing: DataFrame) -> DataFrame:
    number = F.col("quote_id")
    return quote_billing.select(
        F.concat(F.lit(QUOTE_LETTER), number.cast("string")).alias("_k"), number.cast("bigint").alias("_quote")
    )


def _quote_refs(quote_billing: DataFrame) -> DataFrame:
    """Unpaid quotes by reference. References that differ in leading zeros only share a probe key, so
    each keeps its own spelling."""
    lowest = quote_billing.where(F.col("status") != "P").groupBy("ref_no").agg(F.min("quote_id").alias("quote_id"))
    return lowest.select(
        _probe(F.col("ref_no")).alias("_k"),
        F.struct(F.col("ref_no").alias("ref"), F.col("quote_id").cast("bigint").alias("quote")).alias("_ref"),
    )


def _map(
    staged: DataFrame,
    policy_billing: DataFrame | None = None,
    billing_others: DataFrame | None = None,
    quotes_by_id: DataFrame | None = None,
    quotes_by_ref: DataFrame | None = None,
) -> DataFrame:
    """One left join of the staged rows on the probe key, then fill what is still open.

    The first letter separates policies, one-off bills and quotes; among quotes the id comes first.
    """
    offers: list[DataFrame] = []
    merge: list[Column] = []
    found: list[tuple[Column, Column, str]] = []
    letter = _letter()
    if policy_billing is not None:
        offers.append(_policies(policy_billing))
        merge.append(F.min("_policy").alias("_policy"))
        found.append((~letter.isin(OTHER_LETTER, QUOTE_LETTER), F.col("_policy"), "B"))
    if billing_others is not None:
        offers.append(_others(billing_others))
        merge.append(F.min("_other").alias("_other"))
        found.append((letter == OTHER_LETTER, F.col("_other"), "A"))
    if quotes_by_id is not None:
        offers.append(_quote_ids(quotes_by_id))
        merge.append(F.min("_quote").alias("_quote"))
        numbered = _quote_number(F.col("PolisNo")).isNotNull()
        found.append(((letter == QUOTE_LETTER) & numbered, F.col("_quote"), "Q"))
    if quotes_by_ref is not None:
        offers.append(_quote_refs(quotes_by_ref))
        # as many entries as there are spellings of one number with leading zeros
        merge.append(F.map_from_entries(F.collect_list("_ref")).alias("_refs"))
        found.append((letter == QUOTE_LETTER, F.try_element_at("_refs", F.col("PolisNo")), "Q"))

    offered = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), offers)
    lookup = offered.groupBy("_k").agg(*merge)
    rows = lookup_join(staged.withColumn("_k", _probe(F.col("PolisNo"))), lookup, ["_k"])

    policy_id, billing_id, code = F.col("PolisId"), F.col("BillingID"), F.col("BillCode")
    new_policy, new_bill, new_code = (F.lit(None).cast(t) for t in ("bigint", "string", "string"))
    for applies, value, kind in reversed(found):
        hit = applies & value.isNotNull()
        new_policy = F.when(hit, value if kind == "B" else F.lit(None).cast("bigint")).otherwise(new_policy)
        new_bill = F.when(hit, F.lit(None).cast("string") if kind == "B" else value.cast("string")).otherwise(new_bill)
        new_code = F.when(hit, F.lit(kind)).otherwise(new_code)
    return rows.withColumns(
        {
            "PolisId": F.when(_open(), new_policy).otherwise(policy_id),
            "BillingID": F.when(_open(), new_bill).otherwise(billing_id),
            "BillCode": F.when(_open() & new_code.isNotNull(), new_code).otherwise(code),
        }
    ).select(*staged.columns)


def map_policy(staged: DataFrame, policy_billing: DataFrame) -> DataFrame:
    return _map(staged, policy_billing=policy_billing)


def map_billing_other(staged: DataFrame, billing_others: DataFrame) -> DataFrame:
    return _map(staged, billing_others=billing_others)


def map_quote_id(staged: DataFrame, quote_billing: DataFrame) -> DataFrame:
    """By quote id, whatever the status of the quote."""
    return _map(staged, quotes_by_id=quote_billing)


def map_quote_ref(staged: DataFrame, quote_billing: DataFrame) -> DataFrame:
    """By reference number, unpaid quotes only."""
    return _map(staged, quotes_by_ref=quote_billing)


def map_upload(
    staged: DataFrame,
    policy_billing: DataFrame,
    billing_others: DataFrame,
    quote_billing: DataFrame,
) -> DataFrame:
    """All four mappings in one join: the staged rows are shuffled once."""
    return _map(staged, policy_billing, billing_others, quote_billing, quote_billing)


# --- reject reasons --------------------------------------------------------------------------

def _one_reason(reasons: DataFrame, key: str) -> DataFrame:
    """One row per key: the reason with the lowest group."""
    best = F.min(F.struct("GroupRejectMappingID", "RejectReason"))
    return (
        reasons.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_code"))
        .agg(best.alias("_best"))
        .select("_code", F.col("_best.GroupRejectMappingID").alias("_group"), F.col("_best.RejectReason").alias("_text"))
    )


def _with_reason(rows: DataFrame, reasons: DataFrame, key: str, value: str, applies: Column) -> DataFrame:
    keyed = rows.withColumn("_code", F.when(applies, F.col(value)))
    return lookup_join(keyed, _one_reason(reasons, key), ["_code"])


def reason_by_code(staged: DataFrame, reasons: DataFrame, bank_id: int) -> DataFrame:
    """Reason of a rejected row by the bank's own code, for rows with neither group nor text."""
    blank = ~F.col("IsExec") & F.col("RejectGroupID").isNull() & F.col("Deskripsi").isNull()
    own = reasons.where(F.col("bank_id") == bank_id)
    rows = _with_reason(staged, own, "RejectCode", "ApprovalCode", blank & ~F.col("IsSukses"))
    return rows.withColumns(
        {
            "RejectGroupID": F.when(blank, F.col("_group")).otherwise(F.col("RejectGroupID")),
            "Deskripsi": F.when(blank, F.col("_text")).otherwise(F.col("Deskripsi")),
        }
    ).select(*staged.columns)


def reason_by_text(staged: DataFrame, reasons: DataFrame, blank_unmatched: bool = True) -> DataFrame:
    """Reason by its text among the reasons of no particular bank, for rows without a group.

    A row without a match loses its text, approved rows included; ``blank_unmatched=False`` keeps it.
    """
    ungrouped = ~F.col("IsExec") & F.col("RejectGroupID").isNull()
    general = reasons.where(F.coalesce("bank_id", F.lit(0)) == 0)
    rows = _with_reason(staged, general, "RejectReason", "Deskripsi", ungrouped & ~F.col("IsSukses"))
    text = F.col("_text") if blank_unmatched else F.coalesce("_text", "Deskripsi")
    return rows.withColumns(
        {
            "RejectGroupID": F.when(ungrouped, F.col("_group")).otherwise(F.col("RejectGroupID")),
            "Deskripsi": F.when(ungrouped, text).otherwise(F.col("Deskripsi")),
        }
    ).select(*staged.columns)


def reason_at_post(
    rejects: DataFrame, reasons: DataFrame, by_code: bool = False, only: Column | None = None
) -> DataFrame:
    """Final reason of a rejected row that got a bill: known reason, else its text, else its code.

    All banks' reasons count. The group is replaced even when no reason is found. Rows outside
    ``only`` stay as they are.
    """
    key, value = ("RejectCode", "ApprovalCode") if by_code else ("RejectReason", "Deskripsi")
    applies = F.lit(True) if only is None else only
    rows = _with_reason(rejects, reasons, key, value, applies)
    return rows.withColumns(
        {
            "Deskripsi": F.when(applies, F.coalesce("_text", "Deskripsi", "ApprovalCode")).otherwise(F.col("Deskripsi")),
            "RejectGroupID": F.when(applies, F.col("_group")).otherwise(F.col("RejectGroupID")),
        }
    ).select(*rejects.columns)
