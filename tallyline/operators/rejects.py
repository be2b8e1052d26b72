"""Posting rejected rows, touching the bills they concern, and holding policies."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions.keys import row_key
from tallyline.functions.skew import DEFAULT, SkewPolicy, lookup_join
from tallyline.operators.allocation import OPEN, paired_rejects
from tallyline.operators.mapping import reason_at_post
from tallyline.operators.posting import updated
from tallyline.operators.staging import with_header

# Fixed values.
HOLD_DAYS = 15
HOLD_TEXT = "Auto Hold, Reject Debet AC  Recurring"
SYSTEM_USER = "system"
REASON_BY_CODE_FILE = 2


def resolve_rejects(
    staged: DataFrame,
    bills: DataFrame,
    billing_others: DataFrame,
    quote_billing: DataFrame,
    reasons: DataFrame,
    by_code: bool = False,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """All unposted rejected rows, with the bill they concern and, where there is one, the final reason.

    Policy rows get an open bill by rank. One-off and quote rows keep theirs, provided the bill or
    quote exists. Surplus and unmapped rows come out unchanged.
    """
    is_policy_row = F.coalesce((F.col("BillCode") == "B") & F.col("PolisId").isNotNull(), F.lit(False))
    policy_rows = (
        paired_rejects(staged, bills, policy)
        .withColumn("_known", F.col("bill_id").isNotNull())
        .withColumn("BillingID", F.coalesce(F.col("bill_id").cast("string"), F.col("BillingID")))
        .select(*staged.columns, "_known")
    )
    # One lookup for both kinds of bill; its key carries the kind, so numbers never meet across kinds.
    quotes = quote_billing.select(F.lit("Q").alias("BillCode"), F.col("quote_id").cast("string").alias("BillingID"))
    others = billing_others.select(F.lit("A").alias("BillCode"), "BillingID")
    known = others.unionByName(quotes).distinct().withColumn("_known", F.lit(True))
    rest = staged.where(~F.col("IsSukses") & ~F.col("IsExec") & ~is_policy_row)
    claims = lookup_join(rest, known, ["BillCode", "BillingID"])
    claims = claims.withColumn("_known", F.coalesce("_known", F.lit(False)))
    rows = policy_rows.unionByName(claims.select(*policy_rows.columns))
    return reason_at_post(rows, reasons, by_code, only=F.col("_known")).select(*staged.columns)


def ledger_rejected(
    rejects: DataFrame, control: DataFrame, run_ts: datetime, file_id: int | None = None
) -> DataFrame:
    """Ledger rows of rejected rows with a bill: of one file, or of all files with a control row.

    Besides the ledger columns a row carries its own name (``stage_file``, ``stage_id``), and ``source`` and
    ``bankid`` for the bills.
    """
    rows = rejects.where(~F.col("IsExec") & ~F.col("IsSukses") & F.col("BillingID").isNotNull())
    if file_id is not None:
        own = control.where((F.col("id") == file_id) & F.col("FileName").isNotNull()).select("FileName")
        rows = rows.join(F.broadcast(own), "FileName", "left_semi")
    rows = with_header(rows, control, file_id)
    ledger = rows.select(
        row_key("ledger_rejected").alias("tran_id"),
        F.col("FileName").alias("File_Backup"),
        F.col("trancode").alias("TranCode"),
        F.lit(None).cast("timestamp_ntz").alias("TranDate"),
        F.lit(False).alias("IsSuccess"),
        F.col("PolisId").alias("PolicyId"),
        "BillCode",
        "BillingID",
        F.col("Amount").alias("BillAmount"),
        "ApprovalCode",
        F.col("Deskripsi").alias("Description"),
        F.col("RejectGroupID").alias("GroupRejectMappingID"),
        F.col("AccNo").alias("accNo"),
        F.col("AccName").alias("accName"),
        F.lit(run_ts).cast("timestamp_ntz").alias("DateInsert"),
        F.col("FileName").alias("stage_file"),
        F.col("id").alias("stage_id"),
        "source",
        "bankid",
    )
    return ledger


def ledger_columns(ledger: DataFrame) -> DataFrame:
    return schemas.conform(ledger, schemas.LEDGER)


def _last_word(ledger: DataFrame, code: str, bill: Column, key: str) -> DataFrame:
    """One ledger row per bill: that of the first staged row, by file and id (map-side aggregation)."""
    first = F.min(F.struct("stage_file", "stage_id", "tran_id", "source", "bankid", "DateInsert")).alias("_l")
    return ledger.where(F.col("BillCode") == code).groupBy(bill.alias(key)).agg(first).where(F.col(key).isNotNull())


def touch_bills(bills: DataFrame, ledger: DataFrame) -> DataFrame:
    """Bill snapshot after the rejections: open bills in the ledger become downloadable again."""
    bills = schemas.with_columns_of(bills, schemas.BILL_PAYMENT)
    rows = _last_word(ledger, "B", F.col("BillingID").try_cast("bigint"), "BillingID")
    before = bills.where(F.col("status_billing").isin(*OPEN)).select(
        "BillingID", "BankIdDownload", "Source_download", "BillingDate"
    )
    changes = before.join(rows, "BillingID").select(
        "BillingID",
        F.lit(False).alias("IsDownload"),
        F.col("_l.DateInsert").alias("LastUploadDate"),
        F.col("_l.tran_id").alias("PaymentTransactionID"),
        F.coalesce("BankIdDownload", "_l.bankid").alias("BankIdDownload"),
        F.coalesce("Source_download", "_l.source").alias("Source_download"),
        F.coalesce("BillingDate", F.col("_l.DateInsert").cast("date")).alias("BillingDate"),
    )
    return updated(bills, changes, "BillingID")


def _touch(table: DataFrame, ledger: DataFrame, code: str, bill: Column, key: str, status: str) -> DataFrame:
    rows = _last_word(ledger, code, bill, key)
    changes = table.where(F.col(status).isin(*OPEN)).select(key).join(rows, key).select(
        key,
        F.lit(False).alias("IsDownload"),
        F.col("_l.DateInsert").alias("LastUploadDate"),
        F.col("_l.tran_id").alias("PaymentTransactionID"),
        F.lit("CC").alias("Source_download"),
    )
    return updated(table, changes, key)


def touch_others(billing_others: DataFrame, ledger: DataFrame) -> DataFrame:
    table = schemas.with_columns_of(billing_others, schemas.OTHER_PAYMENT)
    return _touch(table, ledger, "A", F.col("BillingID"), "BillingID", "status_billing")


def touch_quotes(quote_billing: DataFrame, ledger: DataFrame) -> DataFrame:
    table = schemas.with_columns_of(quote_billing, schemas.QUOTE_PAYMENT)
    return _touch(table, ledger, "Q", F.col("BillingID").try_cast("bigint"), "quote_id", "status")


def hold_rejected(staged: DataFrame, holds: DataFrame, run_date: date) -> DataFrame:
    """Hold snapshot: every policy with a failed row is held 15 days, or longer if it already was."""
    failed = (
        staged.where(~F.col("IsSukses") & F.col("PolisId").isNotNull())
        .groupBy(F.col("PolisId").alias("policy_id"))
        .agg(F.count(F.lit(1)).alias("_failed"))
    )
    users = {"UserCrt": "string", "DateUpdate": "date", "UserUpdate": "string"}
    holds = holds.withColumns(
        {n: F.lit(None).cast(t) for n, t in users.items() if n not in holds.columns}
    ).withColumn("_held", F.lit(True))
    until = F.date_add(F.lit(run_date).cast("date"), HOLD_DAYS)
    later = F.coalesce(F.col("ReleaseDate") > until, F.lit(False))
    failed_now, held = F.col("_failed").isNotNull(), F.col("_held").isNotNull()
    # the first failed row of a policy without a hold inserts it, a second one already updates it
    both = failed_now & (held | (F.col("_failed") > 1))
    return holds.join(failed, "policy_id", "full").select(
        "policy_id",
        F.when(failed_now & ~later, until).otherwise(F.col("ReleaseDate")).alias("ReleaseDate"),
        F.when(failed_now & ~later, F.lit(HOLD_TEXT)).otherwise(F.col("Description")).alias("Description"),
        F.when(held, F.col("UserCrt")).otherwise(F.lit(SYSTEM_USER)).alias("UserCrt"),
        F.when(both, F.lit(run_date).cast("date")).otherwise(F.col("DateUpdate")).alias("DateUpdate"),
        F.when(both, F.lit(SYSTEM_USER)).otherwise(F.col("UserUpdate")).alias("UserUpdate"),
    )
