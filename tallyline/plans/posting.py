"""The approve step and the reject step as compositions of operators."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.skew import DEFAULT, SkewPolicy
from tallyline.operators import allocation, errors, notify, posting, rejects
from tallyline.operators.staging import ROW, mark_executed, route_approved
from tallyline.session import materialize


@dataclass
class Tables:
    """Reference and state tables a run reads."""

    control: DataFrame
    policy_billing: DataFrame
    billing: DataFrame
    billing_others: DataFrame
    quote_billing: DataFrame
    reasons: DataFrame
    policy_cc: DataFrame
    policy_ac: DataFrame
    customers: DataFrame
    products: DataFrame
    quotes: DataFrame
    new_bills: DataFrame | None = None


@dataclass
class Claims:
    """What the approved rows pay: the only expensive part, worth materializing before its many uses."""

    routed: DataFrame  # one-off and quote rows with their route
    allocated: DataFrame  # policy rows with their bill, or none, and the policy's own card and account
    recurring: DataFrame
    other: DataFrame
    quote: DataFrame
    run_ts: datetime

    def materialized(self) -> Claims:
        """The same rows, computed once and read back by every output."""
        allocated = materialize(self.allocated)
        return replace(
            self,
            allocated=allocated,
            recurring=posting.recurring_posting(allocated, self.run_ts),
            other=materialize(self.other),
            quote=materialize(self.quote),
        )


@dataclass
class Approved:
    ledger: DataFrame
    receipts: DataFrame
    receipt_other: DataFrame
    notes: DataFrame
    card_tx: DataFrame
    account_tx: DataFrame
    card_tx_changes: DataFrame
    quote_changes: DataFrame
    emails: DataFrame
    errors: DataFrame

    def items(self):
        return [(f.name, getattr(self, f.name)) for f in fields(self)]


def claim(
    pool: DataFrame, tables: Tables, run_ts: datetime, policy: SkewPolicy = DEFAULT
) -> Claims:
    """Pair the pool (with header) with open bills and quotes. The routed pool is stored: it is read by the search
    for heavy policies, by both pairings and by the errors."""
    routed = materialize(route_approved(pool))
    policy_rows = routed.where(F.col("route") == "recurring")
    others = routed.where(F.col("route") != "recurring")
    allocated = allocation.allocate_approved(policy_rows, tables.billing, tables.new_bills, policy)
    allocated = posting.with_account(posting.with_card(allocated, tables.policy_cc), tables.policy_ac)
    return Claims(
        routed=others,
        allocated=allocated,
        recurring=posting.recurring_posting(allocated, run_ts),
        other=posting.other_posting(others.where(F.col("route") == "other"), tables.billing_others, run_ts),
        quote=posting.quote_posting(others.where(F.col("route") == "quote"), tables.quote_billing, run_ts),
        run_ts=run_ts,
    )


def posted_claims(claims: Claims) -> DataFrame:
    """Names of the one-off and quote rows that were posted."""
    return claims.other.select(*ROW).unionByName(claims.quote.select(*ROW))


def posted_rows(claims: Claims) -> DataFrame:
    return claims.recurring.select(*ROW).unionByName(posted_claims(claims))


def post_approved(
    claims: Claims, tables: Tables, texts: notify.MailTexts = notify.MailTexts()
) -> Approved:
    """Everything the approve step appends. Table states are ``state_after_approval``."""
    recurring, other, quote = claims.recurring, claims.other, claims.quote
    people = (tables.policy_billing, tables.customers, tables.products)
    return Approved(
        ledger=posting.ledger_recurring(recurring)
        .unionByName(posting.ledger_other(other))
        .unionByName(posting.ledger_quote(quote)),
        receipts=posting.receipts(recurring),
        receipt_other=posting.receipt_other_fee(recurring).unionByName(posting.receipt_other_billing(other)),
        notes=posting.policy_notes(recurring, other),
        card_tx=posting.card_tx(recurring, tables.policy_cc),
        account_tx=posting.account_tx(recurring, tables.policy_ac),
        card_tx_changes=posting.card_tx_changes(other),
        quote_changes=posting.quote_changes(quote),
        emails=notify.email_policies(recurring, other, *people, texts)
        .unionByName(notify.email_quote(quote, tables.quote_billing, tables.quotes, tables.products, texts)),
        errors=errors.post_errors(claims.allocated, claims.routed, posted_claims(claims)),
    )


def state_after_approval(staged: DataFrame, claims: Claims, tables: Tables, bill_changes: DataFrame | None = None):
    """Staging, policy bills, one-off bills and quotes after the payments.

    ``bill_changes`` are the changes of the policy bills, if they were computed (and stored) before.
    """
    bills = tables.billing
    if tables.new_bills is not None:
        bills = bills.unionByName(tables.new_bills, allowMissingColumns=True)
    if bill_changes is None:
        bill_changes = posting.bill_changes(claims.recurring, tables.policy_cc)
    return (
        mark_executed(staged, posted_rows(claims)),
        posting.updated(bills, bill_changes, "BillingID"),
        posting.close_billing_others(tables.billing_others, claims.other),
        posting.close_quotes(tables.quote_billing, claims.quote),
    )


@dataclass
class Rejected:
    staged: DataFrame  # the rejected rows with bill and reason
    ledger: DataFrame


def post_rejected(
    staged: DataFrame,
    tables: Tables,
    run_ts: datetime,
    file_id: int | None = None,
    policy: SkewPolicy = DEFAULT,
) -> Rejected:
    """Reject step on the state the approve step left."""
    resolved = rejects.resolve_rejects(
        staged,
        tables.billing,
        tables.billing_others,
        tables.quote_billing,
        tables.reasons,
        by_code=file_id == rejects.REASON_BY_CODE_FILE,
        policy=policy,
    )
    return Rejected(resolved, rejects.ledger_rejected(resolved, tables.control, run_ts, file_id))


def state_after_rejection(ledger: DataFrame, tables: Tables):
    """Policy bills, one-off bills and quotes after the rejections."""
    return (
        rejects.touch_bills(tables.billing, ledger),
        rejects.touch_others(tables.billing_others, ledger),
        rejects.touch_quotes(tables.quote_billing, ledger),
    )
