"""Posting approved rows: ledger, receipts, notes, transactions and the state of bills and quotes.

``recurring_posting``, ``other_posting`` and ``quote_posting`` give one row per posted payment with
every key it creates; the output tables are projections of these rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions.keys import row_key
from tallyline.functions.skew import lookup_join
from tallyline.functions.text import blank_to_null, first_filled, null_to_blank
from tallyline.operators.allocation import claim_others, claim_quotes
from tallyline.operators.staging import ROW

# Fixed values written to the output tables.
RECEIPT_CODE = "RP"
PAID = "P"
SYSTEM_USER = "system"
RECURRING_STAFF, OTHER_STAFF = 2000, 1000
FEE_RECEIPT_TYPE, OTHER_RECEIPT_TYPE = 3, 1
TRANSACTION_APPROVED, APPROVED_REMARK, CURRENCY = 2, "APPROVED", "IDR"
RECEIPT_NOTE = "RECEIPT INPUT RP ({})"
FEE_NOTE = "RECEIPT INPUT PENGGUNA CASHLESS ({})"
OTHER_NOTES = {
    "A1": "RECEIPT INPUT CASHLESSFEE",
    "A2": "RECEIPT INPUT ENDORSEMEN CETAK POLIS FISIK",
    "A3": "RECEIPT INPUT CETAK KARTU",
}
QUOTE_APPROVAL = "UP4Y1"

# The staged row behind a change.
CHANGE_ROW = ("stage_file", "stage_id")


def _now(run_ts: datetime) -> Column:
    return F.lit(run_ts).cast("timestamp_ntz")


def _source() -> Column:
    return F.upper(F.trim(F.col("source")))


def _filled_in(template: str, value: Column) -> Column:
    before, after = template.split("{}")
    return F.concat(F.lit(before), value, F.lit(after))


# --- policy bills ----------------------------------------------------------------------------

def recurring_posting(allocated: DataFrame, run_ts: datetime) -> DataFrame:
    """Allocated rows (with header) that have a bill, plus the keys of what they create."""
    fee = F.coalesce(F.col("cashless_fee_amount"), F.lit(0)) > 0
    tx_kind = F.when(_source() == "CC", row_key("card_tx")).when(_source() == "AC", row_key("account_tx"))
    return allocated.where(F.col("bill_id").isNotNull()).withColumns(
        {
            "run_ts": _now(run_ts),
            "tran_id": row_key("ledger"),
            "receipt_id": row_key("receipt"),
            "note_id": row_key("note"),
            "has_fee": fee,
            "fee_receipt_id": F.when(fee, row_key("receipt_other")),
            "fee_note_id": F.when(fee, row_key("note_other")),
            "account_tran_id": tx_kind,
        }
    )


def ledger_recurring(posted: DataFrame) -> DataFrame:
    return schemas.conform(
        posted.select(
            "tran_id",
            "File_Backup",
            F.col("trancode").alias("TranCode"),
            "TranDate",
            F.lit(True).alias("IsSuccess"),
            F.col("PolisId").alias("PolicyId"),
            "BillCode",
            F.col("bill_id").cast("string").alias("BillingID"),
            F.col("Amount").alias("BillAmount"),
            blank_to_null(F.col("ApprovalCode")).alias("ApprovalCode"),
            blank_to_null(F.col("Deskripsi")).alias("Description"),
            blank_to_null(F.col("AccNo")).alias("accNo"),
            null_to_blank(F.col("AccName")).alias("accName"),
            F.col("run_ts").alias("DateInsert"),
        ),
        schemas.LEDGER,
    )


def receipts(posted: DataFrame) -> DataFrame:
    """One receipt per posted row, without the fee; a bill with no fee value has no amount."""
    return posted.select(
        "receipt_id",
        F.col("run_ts").alias("receipt_date"),
        F.col("PolisId").alias("receipt_policy_id"),
        F.lit(0).alias("receipt_fund_type_id"),
        F.lit(RECEIPT_CODE).alias("receipt_transaction_code"),
        (F.col("Amount") - F.col("cashless_fee_amount")).cast("decimal(18,2)").alias("receipt_amount"),
        F.col("source").alias("receipt_source"),
        F.lit(PAID).alias("receipt_status"),
        F.col("run_ts").alias("receipt_payment_date_time"),
        F.col("recurring_seq").alias("receipt_seq"),
        F.col("bankid_receipt").alias("bank_acc_id"),
        F.col("due_dt_pre").alias("due_date_pre"),
        F.col("bankid").alias("acquirer_bank_id"),
        F.coalesce("freq_payment", F.lit(0)).alias("freq_payment"),
        F.lit(RECURRING_STAFF).alias("created_by"),
    )


def receipt_other_fee(posted: DataFrame) -> DataFrame:
    return posted.where("has_fee").select(
        F.col("fee_receipt_id").alias("receipt_other_id"),
        F.col("run_ts").alias("receipt_date"),
        F.col("PolisId").alias("policy_id"),
        F.lit(FEE_RECEIPT_TYPE).alias("receipt_type_id"),
        F.col("cashless_fee_amount").alias("receipt_amount"),
        F.col("source").alias("receipt_source"),
        F.col("run_ts").alias("receipt_payment_date"),
        F.col("recurring_seq").alias("receipt_seq"),
        F.col("bankid_receipt").alias("bank_acc_id"),
        F.col("bankid").alias("acquirer_bank_id"),
        "receipt_id",
        F.lit(RECURRING_STAFF).alias("created_by"),
    )


def _note(key: str, policy: str, message: Column, staff: int) -> list[Column]:
    return [
        F.col(key).alias("note_id"),
        F.col(policy).alias("policy_id"),
        F.col("run_ts").alias("date_tran"),
        message.alias("message"),
        F.lit(staff).alias("staff_id"),
    ]


def policy_notes(posted: DataFrame, posted_other: DataFrame | None = None) -> DataFrame:
    """A note per receipt, one more per fee, and one per posted one-off bill."""
    plain = F.struct(*_note("note_id", "PolisId", _filled_in(RECEIPT_NOTE, F.col("source")), RECURRING_STAFF))
    fee = F.struct(
        *_note("fee_note_id", "PolisId", _filled_in(FEE_NOTE, F.upper(F.col("source"))), RECURRING_STAFF)
    )
    both = F.when(F.col("has_fee"), F.array(plain, fee)).otherwise(F.array(plain))
    notes = posted.select(F.inline(both))
    if posted_other is None:
        return notes
    message = F.lit(None).cast("string")
    for bill_type, text in OTHER_NOTES.items():
        message = F.when(F.col("BillingType") == bill_type, F.lit(text)).otherwise(message)
    return notes.unionByName(posted_other.select(*_note("note_id", "bill_policy_id", message, OTHER_STAFF)))


def _with_own(posted: DataFrame, accounts: DataFrame, number: str, name: str, out: str) -> DataFrame:
    """Attach the policy's own card or account, one per policy, unless the rows have it."""
    if out in posted.columns:
        return posted
    own = accounts.groupBy(F.col("PolicyId").alias("PolisId")).agg(F.min(F.struct(number, name)).alias(out))
    return lookup_join(posted, own, ["PolisId"])


def with_card(posted: DataFrame, policy_cc: DataFrame) -> DataFrame:
    return _with_own(posted, policy_cc, "cc_no", "cc_name", "own_card")


def with_account(posted: DataFrame, policy_ac: DataFrame) -> DataFrame:
    return _with_own(posted, policy_ac, "acc_no", "acc_name", "own_account")


def card_tx(posted: DataFrame, policy_cc: DataFrame) -> DataFrame:
    """Card transactions of card-source rows; number and name from the row, the bill or the policy."""
    rows = with_card(posted.where(_source() == "CC"), policy_cc)
    return rows.select(
        F.col("account_tran_id").alias("policy_cc_tran_id"),
        *_transaction_head(),
        F.col("bankid").alias("acquirer_bank_id"),
        first_filled(F.col("AccNo"), F.col("bill_AccNo"), F.col("own_card.cc_no")).alias("cc_no"),
        first_filled(F.col("AccName"), F.col("bill_AccName"), F.col("own_card.cc_name")).alias("cc_name"),
        F.lit(TRANSACTION_APPROVED).alias("status_id"),
        F.lit(APPROVED_REMARK).alias("remark"),
        "receipt_id",
        F.col("fee_receipt_id").alias("receipt_other_id"),
        F.col("run_ts").alias("created_dt"),
    )


def account_tx(posted: DataFrame, policy_ac: DataFrame) -> DataFrame:
    """Account transactions of account-source rows."""
    rows = with_account(posted.where(_source() == "AC"), policy_ac)
    return rows.select(
        F.col("account_tran_id").alias("policy_ac_tran_id"),
        *_transaction_head(),
        F.col("bankid").alias("bank_id"),
        first_filled(F.col("AccNo"), F.col("bill_AccNo"), F.col("own_account.acc_no")).alias("acc_no"),
        first_filled(F.col("AccName"), F.col("bill_AccName"), F.col("own_account.acc_name")).alias("acc_name"),
        F.lit(TRANSACTION_APPROVED).alias("status_id"),
        "receipt_id",
        F.col("run_ts").alias("created_dt"),
        F.col("run_ts").alias("update_dt"),
    )


def _transaction_head() -> list[Column]:
    return [
        F.col("PolisId").alias("policy_id"),
        F.col("run_ts").alias("transaction_dt"),
        F.lit("R").alias("transaction_type"),
        F.col("recurring_seq"),
        F.lit(1).alias("count_times"),
        F.lit(CURRENCY).alias("currency"),
        F.col("TotalAmount").alias("total_amount"),
        F.col("due_dt_pre").alias("due_date_pre"),
        F.date_format("due_dt_pre", "MMMyy").alias("due_date_pre_period"),
    ]


def updated(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """New snapshot of ``table``: rows with a change (unique by ``key``) take all of its columns."""
    names = [n for n in changes.columns if n != key]
    table = schemas.with_columns_of(table, changes.select(*names).schema)
    marked = changes.select(
        F.col(key), F.lit(True).alias("_changed"), *[F.col(n).alias(f"_new_{n}") for n in names]
    )
    types = dict(table.dtypes)
    columns = [
        F.when(F.col("_changed"), F.col(f"_new_{n}").cast(types[n])).otherwise(F.col(n)).alias(n)
        if n in names
        else F.col(n)
        for n in table.columns
    ]
    return table.join(marked, key, "left").select(*columns)


def bill_changes(posted: DataFrame, policy_cc: DataFrame) -> DataFrame:
    """What a paid bill becomes. The card of the policy fills account gaps whatever the source."""
    rows = with_card(posted, policy_cc)
    return rows.select(
        F.col("bill_id").alias("BillingID"),
        F.lit(False).alias("IsDownload"),
        F.lit(True).alias("IsClosed"),
        F.coalesce("BillingDate", F.col("run_ts").cast("date")).alias("BillingDate"),
        F.lit(PAID).alias("status_billing"),
        F.col("source").alias("PaymentSource"),
        F.when(_source() != "CC", F.col("TranDate")).alias("paid_date"),
        F.col("bankid").alias("BankIdPaid"),
        F.col("Amount").alias("PaidAmount"),
        F.col("account_tran_id").alias("CoreTranID"),
        F.col("receipt_id").alias("ReceiptID"),
        F.col("fee_receipt_id").alias("ReceiptOtherID"),
        F.col("note_id").alias("policy_note_receipt"),
        F.col("fee_note_id").alias("policy_note_receiptOther"),
        F.col("tran_id").alias("PaymentTransactionID"),
        first_filled(F.col("AccName"), F.col("bill_AccName"), F.col("own_card.cc_name")).alias("AccName"),
        first_filled(F.col("AccNo"), F.col("bill_AccNo"), F.col("own_card.cc_no")).alias("AccNo"),
        F.col("run_ts").alias("LastUploadDate"),
        F.lit(SYSTEM_USER).alias("UserUpload"),
    )


def close_bills(bills: DataFrame, posted: DataFrame, policy_cc: DataFrame) -> DataFrame:
    """Bill snapshot after the payments. A bill is paid at most once, so the join is one to one."""
    return updated(bills, bill_changes(posted, policy_cc), "BillingID")


# --- one-off bills ---------------------------------------------------------------------------

def other_posting(pool: DataFrame, billing_others: DataFrame, run_ts: datetime) -> DataFrame:
    """First row of each open one-off bill, with the keys of what it creates."""
    return claim_others(pool, billing_others).withColumns(
        {
            "run_ts": _now(run_ts),
            "tran_id": row_key("ledger"),
            "note_id": row_key("note"),
            "receipt_other_id": row_key("receipt_other"),
        }
    )


def _ledger_of_claims(posted: DataFrame, policy_id: Column) -> DataFrame:
    """One-off bills and quotes keep empty texts where policy rows get NULL."""
    return schemas.conform(
        posted.select(
            "tran_id",
            "File_Backup",
            F.col("trancode").alias("TranCode"),
            F.lit(True).alias("IsSuccess"),
            policy_id.alias("PolicyId"),
            "BillCode",
            "BillingID",
            F.col("Amount").alias("BillAmount"),
            null_to_blank(F.col("ApprovalCode")).alias("ApprovalCode"),
            null_to_blank(F.col("Deskripsi")).alias("Description"),
            null_to_blank(F.col("AccNo")).alias("accNo"),
            null_to_blank(F.col("AccName")).alias("accName"),
            F.col("run_ts").alias("DateInsert"),
        ),
        schemas.LEDGER,
    )


def ledger_other(posted: DataFrame) -> DataFrame:
    return _ledger_of_claims(posted, F.col("bill_policy_id"))


def receipt_other_billing(posted: DataFrame) -> DataFrame:
    """Receipt over the amount of the bill."""
    return posted.select(
        "receipt_other_id",
        F.col("run_ts").alias("receipt_date"),
        F.col("bill_policy_id").alias("policy_id"),
        F.lit(OTHER_RECEIPT_TYPE).alias("receipt_type_id"),
        F.col("TotalAmount").alias("receipt_amount"),
        F.col("source").alias("receipt_source"),
        F.col("run_ts").alias("receipt_payment_date"),
        F.lit(0).alias("receipt_seq"),
        F.col("bankid_receipt").alias("bank_acc_id"),
        F.col("bankid").alias("acquirer_bank_id"),
        F.lit(None).cast("string").alias("receipt_id"),
        F.lit(None).cast("int").alias("created_by"),
    )


def last_changes(changes: DataFrame, key: str, when: str) -> DataFrame:
    """One change per key: the latest, and of those of one run that of the last row, by file and id (map-side
    aggregation). Changes of a null key fit no row and are left out."""
    names = [n for n in changes.columns if n not in (key, *CHANGE_ROW)]
    last = F.max(F.struct(F.col(when).alias("_when"), *CHANGE_ROW, F.struct(*names).alias("_new"))).alias("_last")
    found = changes.where(F.col(key).isNotNull()).groupBy(key).agg(last)
    return found.select(key, *[F.col(f"_last._new.{n}").alias(n) for n in names])


def card_tx_changes(posted: DataFrame) -> DataFrame:
    """What the card transaction behind a one-off bill becomes, with the name of the row that says so."""
    return posted.where(F.col("CoreTranID").isNotNull()).select(
        *[F.col(n).alias(out) for n, out in zip(ROW, CHANGE_ROW)],
        F.col("CoreTranID").alias("policy_cc_tran_id"),
        F.lit(TRANSACTION_APPROVED).alias("status_id"),
        null_to_blank(F.col("ApprovalCode")).alias("result_status"),
        F.lit(APPROVED_REMARK).alias("remark"),
        "receipt_other_id",
        F.col("run_ts").alias("update_dt"),
    )


def apply_card_tx_changes(transactions: DataFrame, changes: DataFrame) -> DataFrame:
    """Card transactions (keyed by ``policy_cc_tran_id``, whatever their other columns) after the changes: each
    takes the last one of its key. Several bills may name one transaction; changes of unknown ones do nothing."""
    return updated(transactions, last_changes(changes, "policy_cc_tran_id", "update_dt"), "policy_cc_tran_id")


def close_billing_others(billing_others: DataFrame, posted: DataFrame) -> DataFrame:
    table = schemas.with_columns_of(billing_others, schemas.OTHER_PAYMENT)
    changes = posted.select(
        "BillingID",
        F.lit(False).alias("IsDownload"),
        F.lit(True).alias("IsClosed"),
        F.lit(PAID).alias("status_billing"),
        F.lit("CC").alias("PaymentSource"),
        F.col("run_ts").alias("LastUploadDate"),
        F.col("run_ts").cast("date").alias("paid_date"),
        F.col("bankid").alias("BankIdPaid"),
        F.col("note_id").alias("policy_note_receiptOther"),
        F.col("Amount").alias("PaidAmount"),
        F.col("receipt_other_id").alias("ReceiptOtherID"),
        F.col("tran_id").alias("PaymentTransactionID"),
        F.lit(SYSTEM_USER).alias("UserUpload"),
    )
    return updated(table, changes, "BillingID")


# --- quotes ----------------------------------------------------------------------------------

def quote_posting(pool: DataFrame, quote_billing: DataFrame, run_ts: datetime) -> DataFrame:
    """First row of each open quote, with its ledger key."""
    return claim_quotes(pool, quote_billing).withColumns(
        {
            "run_ts": _now(run_ts),
            "tran_id": row_key("ledger"),
            "quote_id": F.col("BillingID").try_cast("bigint"),
        }
    )


def ledger_quote(posted: DataFrame) -> DataFrame:
    return _ledger_of_claims(posted, F.lit(None).cast("bigint"))


# Which columns of a quote change go to which table, and under which name.
QUOTE_TABLES = {
    "quote": {"quote_status": "quote_status", "quote_submitted_dt": "quote_submitted_dt"},
    "prospect": {
        "prospect_convert_flag": "prospect_convert_flag", "prospect_appr_code": "prospect_appr_code",
        "updated_dt": "updated_dt", "acquirer_bank_id": "acquirer_bank_id",
    },
    "quote_terminal": {"status_id": "status_id", "reason": "reason", "appr_code": "appr_code"},
}


def apply_quote_changes(tables: dict[str, DataFrame], changes: DataFrame) -> dict[str, DataFrame]:
    """Quotes, prospects and terminal rows (``QUOTE_TABLES``; all keyed by ``quote_id``) after the changes of
    posted quotes. One change row serves all three; a quote may have several prospects or none."""
    last = last_changes(changes, "quote_id", "updated_dt")
    made = {}
    for name, columns in QUOTE_TABLES.items():
        own = last.select("quote_id", *[F.col(n).alias(to) for n, to in columns.items()])
        made[name] = updated(tables[name], own, "quote_id")
    return made


def quote_changes(posted: DataFrame) -> DataFrame:
    """New column values of the quote, its prospect and its terminal row, one row per posted quote."""
    return posted.select(
        *[F.col(n).alias(out) for n, out in zip(ROW, CHANGE_ROW)],
        "quote_id",
        F.lit(PAID).alias("quote_status"),
        F.col("run_ts").alias("quote_submitted_dt"),
        F.lit(2).alias("prospect_convert_flag"),
        F.lit(QUOTE_APPROVAL).alias("prospect_appr_code"),
        F.col("run_ts").alias("updated_dt"),
        F.col("bankid").alias("acquirer_bank_id"),
        F.lit(1).alias("status_id"),
        F.lit("").alias("reason"),
        F.lit(QUOTE_APPROVAL).alias("appr_code"),
    )


def close_quotes(quote_billing: DataFrame, posted: DataFrame) -> DataFrame:
    """Quote billing snapshot after the payments; the paying bank is left unset."""
    table = schemas.with_columns_of(quote_billing, schemas.QUOTE_PAYMENT)
    changes = posted.select(
        "quote_id",
        F.lit(False).alias("IsDownload"),
        F.lit(True).alias("IsClosed"),
        F.lit(PAID).alias("status"),
        F.lit("CC").alias("PaymentSource"),
        F.col("Amount").alias("PaidAmount"),
        F.lit(None).cast("int").alias("BankIdPaid"),
        F.col("run_ts").alias("LastUploadDate"),
        F.col("run_ts").cast("date").alias("paid_dt"),
        F.col("tran_id").alias("PaymentTransactionID"),
        F.lit(SYSTEM_USER).alias("UserUpload"),
    )
    return updated(table, changes, "quote_id")
