"""One Spark query per operator over the fixture views. ``oracles`` holds their DuckDB twins."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.fixtures import BASE_TABLES, MAIL_TEMPLATES, RUN_DATE, RUN_TS, view
from tallyline import schemas
from tallyline.functions.text import clean_description
from tallyline.operators import allocation, control, errors, mapping, notify, posting, rejects, staging
from tallyline.plans import posting as plans
from tallyline.session import configure, materialize, shared_folder
from tallyline.sources import dispatch, fixed_width, sheets, tables

BRAND = notify.MailTexts(brand="ACME", bcc="archive@example.org", **MAIL_TEMPLATES)
FILE = 4  # the file of queries about one file
HALF = 1  # one half of a two-file upload


class Run:
    """The tables of one scale factor and the steps several queries share."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def t(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)

    @property
    def control(self) -> DataFrame:
        return self.t("fx_control")

    def tables(self) -> plans.Tables:
        return plans.Tables(
            control=self.control,
            policy_billing=self.t("fx_policy_billing"),
            billing=self.t("fx_billing"),
            billing_others=self.t("fx_billing_others"),
            quote_billing=self.t("fx_quote_billing"),
            reasons=self.t("fx_reason_map"),
            policy_cc=self.t("fx_policy_cc"),
            policy_ac=self.t("fx_policy_ac"),
            customers=self.t("fx_customer_info"),
            products=self.t("fx_product"),
            quotes=self.t("fx_quote"),
        )

    @cached_property
    def staged(self) -> DataFrame:
        return schemas.as_staging(self.t("fx_upload"))

    def map_upload(self) -> DataFrame:
        return mapping.map_upload(
            self.staged, self.t("fx_policy_billing"), self.t("fx_billing_others"), self.t("fx_quote_billing")
        )

    @cached_property
    def mapped(self) -> DataFrame:
        """The staging table as the upload job leaves it: stored once, read by the later steps."""
        return materialize(self.map_upload())

    @cached_property
    def pool(self) -> DataFrame:
        return staging.with_header(staging.pool_approved(self.mapped, self.control, RUN_DATE), self.control)

    @cached_property
    def other_pool(self) -> DataFrame:
        return staging.with_header(staging.pool_approved_other(self.mapped), self.control)

    @cached_property
    def policy_pool(self) -> DataFrame:
        return staging.with_header(
            staging.pool_approved_policy(self.mapped, self.control, RUN_DATE), self.control
        )

    @cached_property
    def allocated(self) -> DataFrame:
        return allocation.allocate_approved(self.policy_pool, self.t("fx_billing"))

    @cached_property
    def recurring(self) -> DataFrame:
        return posting.recurring_posting(self.allocated, RUN_TS)

    @cached_property
    def other(self) -> DataFrame:
        pool = staging.route_approved(self.other_pool).where(F.col("route") == "other")
        return posting.other_posting(pool, self.t("fx_billing_others"), RUN_TS)

    @cached_property
    def quote(self) -> DataFrame:
        pool = staging.route_approved(self.other_pool).where(F.col("route") == "quote")
        return posting.quote_posting(pool, self.t("fx_quote_billing"), RUN_TS)

    @cached_property
    def claims(self) -> plans.Claims:
        return plans.claim(self.pool, self.tables(), RUN_TS).materialized()

    @cached_property
    def resolved(self) -> DataFrame:
        return rejects.resolve_rejects(
            self.mapped, self.t("fx_billing"), self.t("fx_billing_others"), self.t("fx_quote_billing"),
            self.t("fx_reason_map"),
        )

    @cached_property
    def reject_ledger(self) -> DataFrame:
        return rejects.ledger_rejected(self.resolved, self.control, RUN_TS)


Query = Callable[[Run], DataFrame]
QUERIES: dict[str, Query] = {}


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


def comparable(df: DataFrame) -> DataFrame:
    """Types both engines hand over alike: money as double, dates and times as plain timestamps."""

    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType)):
            return column.cast("timestamp_ntz").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: lambda spark, sf_dir, make=make: comparable(make(Run(spark, sf_dir))) for name, make in QUERIES.items()
    }


# --- sources ---------------------------------------------------------------------------------

def _fixed(name: str) -> None:
    QUERIES[f"ingest_{name}"] = lambda r: fixed_width.ingest_fixed(
        r.t(f"fx_lines_{name}"), fixed_width.FIXED_LAYOUTS[name]
    )


def _sheet(name: str) -> None:
    QUERIES[f"ingest_{name}"] = lambda r: sheets.ingest_sheet(r.t(f"fx_cells_{name}"), sheets.SHEET_LAYOUTS[name])


for _name in fixed_width.FIXED_LAYOUTS:
    _fixed(_name)
for _name in sheets.SHEET_LAYOUTS:
    _sheet(_name)


@query
def ingest_va_auto(r: Run) -> DataFrame:
    return fixed_width.ingest_va_auto(r.t("fx_lines_va_mixed"))


@query
def ingest_dispatch(r: Run) -> DataFrame:
    return dispatch.ingest_dispatch(r.t("fx_lines_all"), r.t("fx_cells_all"), r.control)


@query
def rejected_cells(r: Run) -> DataFrame:
    """Of all three grids: what their parsers leave out, and why."""
    found = [
        sheets.rejected_cells(r.t(f"fx_cells_{name}"), layout).select(
            F.lit(name).alias("layout"), "FileName", "sheet_no", "row_no", "id", "reason"
        )
        for name, layout in sheets.SHEET_LAYOUTS.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query
def rejected_lines(r: Run) -> DataFrame:
    return fixed_width.rejected_lines(r.t("fx_lines_acct_fixed_b"), fixed_width.ACCT_FIXED_B)


@query
def clean_description_(r: Run) -> DataFrame:
    return r.t("fx_cells_card_sheet_b").select(
        F.col("row_no").alias("id"), clean_description(F.col("c6")).alias("Deskripsi")
    )


QUERIES["clean_description"] = QUERIES.pop("clean_description_")


@query
def read_lines(r: Run) -> DataFrame:
    """A result file as it lands: lines in order, read back over several splits and parsed."""
    folder = f"{shared_folder(r.spark)}/tallyline/landing-{uuid.uuid4().hex}"
    written = r.t("fx_lines_acct_fixed_b").where(F.col("FileName") == "bank_12.txt")
    written.orderBy("id").coalesce(1).select("value").write.text(folder)
    lines = tables.read_lines(r.spark, folder, file_no=12).withColumn("FileName", F.lit("bank_12.txt"))
    return fixed_width.ingest_fixed(lines, fixed_width.ACCT_FIXED_B).select("id", "FileName", "PolisNo", "Amount", "IsSukses")


@query
def scan_tables(r: Run) -> DataFrame:
    counts = [
        r.t(name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name in BASE_TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


# --- control and staging ---------------------------------------------------------------------

@query
def files_due(r: Run) -> DataFrame:
    return control.files_due(r.control, r.t("fx_download_summary"), RUN_DATE)


@query
def file_by_id(r: Run) -> DataFrame:
    return control.file_by_id(r.control, r.t("fx_download_summary"))


@query
def files_due_source(r: Run) -> DataFrame:
    return control.files_due_source(r.control, r.t("fx_download_summary"), RUN_DATE, "CC")


@query
def run_policy(r: Run) -> DataFrame:
    return control.run_policy(r.control, single_file=True)


@query
def pool_approved_policy(r: Run) -> DataFrame:
    return staging.pool_approved_policy(r.mapped, r.control, RUN_DATE)


@query
def pool_approved_other(r: Run) -> DataFrame:
    return staging.pool_approved_other(r.mapped)


@query
def pool_approved(r: Run) -> DataFrame:
    return staging.pool_approved(r.mapped, r.control, RUN_DATE)


@query
def route_approved(r: Run) -> DataFrame:
    return staging.route_approved(r.pool).select("id", "BillCode", "source", "route")


@query
def stage_normalize(r: Run) -> DataFrame:
    return staging.stage_normalize(r.t("fx_upload"))


@query
def file_already_loaded(r: Run) -> DataFrame:
    return staging.file_already_loaded(r.control, r.staged)


@query
def sibling_file_loaded(r: Run) -> DataFrame:
    return staging.sibling_file_loaded(r.control, r.staged)


@query
def stage_remove_file(r: Run) -> DataFrame:
    return staging.stage_remove_file(r.t("fx_upload"), r.control, FILE)


@query
def stage_reset(r: Run) -> DataFrame:
    return staging.stage_reset(r.t("fx_upload"), r.control, HALF)


@query
def stage_reset_tables(r: Run) -> DataFrame:
    """Two staging tables in one: only that of the file's control row is emptied."""
    of_file = F.concat(F.lit("stage_"), (F.regexp_extract("FileName", "[0-9]+", 0).cast("int") % 2).cast("string"))
    of_row = F.concat(F.lit("stage_"), (F.col("id") % 2).cast("string"))
    return staging.stage_reset(
        r.t("fx_upload").withColumn("stageTable", of_file), r.control.withColumn("stageTable", of_row), FILE
    )


@query
def va_drop_paid(r: Run) -> DataFrame:
    return staging.va_drop_paid(r.t("fx_va_upload"), r.t("fx_billing"))


@query
def release_control(r: Run) -> DataFrame:
    return control.release_control(r.control, FILE)


@query
def upload_counts(r: Run) -> DataFrame:
    return control.upload_counts(r.mapped)


@query
def file_row_count(r: Run) -> DataFrame:
    return control.file_row_count(r.staged, r.control)


@query
def upload_summary(r: Run) -> DataFrame:
    return control.upload_summary(r.t("fx_upload_sum"), r.control, r.mapped)


@query
def record_row_count(r: Run) -> DataFrame:
    return control.record_row_count(r.control, r.staged)


@query
def download_cleared(r: Run) -> DataFrame:
    return control.download_cleared(r.t("fx_download_summary"))


# --- mapping ---------------------------------------------------------------------------------

MAPPED = ("id", "PolisNo", "PolisId", "BillingID", "BillCode")


@query
def map_policy(r: Run) -> DataFrame:
    return mapping.map_policy(r.staged, r.t("fx_policy_billing")).select(*MAPPED)


@query
def map_billing_other(r: Run) -> DataFrame:
    return mapping.map_billing_other(r.staged, r.t("fx_billing_others")).select(*MAPPED)


@query
def map_quote_id(r: Run) -> DataFrame:
    return mapping.map_quote_id(r.staged, r.t("fx_quote_billing")).select(*MAPPED)


@query
def map_quote_ref(r: Run) -> DataFrame:
    by_id = mapping.map_quote_id(r.staged, r.t("fx_quote_billing"))
    return mapping.map_quote_ref(by_id, r.t("fx_quote_billing")).select(*MAPPED)


@query
def map_upload(r: Run) -> DataFrame:
    return r.map_upload()


REASONED = ("id", "ApprovalCode", "Deskripsi", "IsSukses", "RejectGroupID")


@query
def reason_by_code(r: Run) -> DataFrame:
    return mapping.reason_by_code(r.staged, r.t("fx_reason_map"), bank_id=1).select(*REASONED)


@query
def reason_by_text(r: Run) -> DataFrame:
    coded = mapping.reason_by_code(r.staged, r.t("fx_reason_map"), bank_id=1)
    return mapping.reason_by_text(coded, r.t("fx_reason_map")).select(*REASONED)


@query
def reason_at_post(r: Run) -> DataFrame:
    pending = r.staged.where(~F.col("IsSukses"))
    return mapping.reason_at_post(pending, r.t("fx_reason_map")).select(*REASONED)


@query
def reason_at_post_by_code(r: Run) -> DataFrame:
    pending = r.staged.where(~F.col("IsSukses"))
    return mapping.reason_at_post(pending, r.t("fx_reason_map"), by_code=True).select(*REASONED)


# --- allocation ------------------------------------------------------------------------------

@query
def first_open_bill(r: Run) -> DataFrame:
    return allocation.first_open_bill(r.t("fx_policy_billing"), r.t("fx_billing"))


@query
def allocate_approved(r: Run) -> DataFrame:
    pool = r.mapped.where(F.col("IsSukses") & ~F.col("IsExec") & (F.col("BillCode") == "B"))
    return allocation.allocate_approved(pool, r.t("fx_billing")).select(
        "id", "PolisNo", "PolisId", "Amount", "k", "bill_id", "recurring_seq", "TotalAmount", "cashless_fee_amount",
        "due_dt_pre", "amount_diff",
    )


@query
def reject_open_bills(r: Run) -> DataFrame:
    return allocation.reject_open_bills(r.mapped, r.t("fx_billing"))


@query
def rank_reject_bills(r: Run) -> DataFrame:
    return allocation.rank_reject_bills(r.mapped, r.t("fx_billing"))


@query
def rank_rejects(r: Run) -> DataFrame:
    return allocation.rank_rejects(r.mapped)


@query
def allocate_rejected(r: Run) -> DataFrame:
    return allocation.allocate_rejected(r.mapped, r.t("fx_billing")).select(*MAPPED, "Amount")


@query
def unclaimed_open_bill(r: Run) -> DataFrame:
    claimed = allocation.allocate_rejected(r.mapped, r.t("fx_billing"))
    return allocation.unclaimed_open_bill(r.t("fx_policy_billing"), r.t("fx_billing"), claimed)


@query
def first_claim(r: Run) -> DataFrame:
    return allocation.first_claim(staging.pool_approved_other(r.mapped))


@query
def other_unpaid(r: Run) -> DataFrame:
    rows = allocation.other_unpaid(staging.pool_approved_other(r.mapped), r.t("fx_billing_others"))
    return rows.select("id", "BillingID", "BillingType", "bill_policy_id", "TotalAmount")


@query
def quote_unpaid(r: Run) -> DataFrame:
    return allocation.quote_unpaid(staging.pool_approved_other(r.mapped), r.t("fx_quote_billing")).select(
        "id", "BillingID"
    )


# --- posting ---------------------------------------------------------------------------------

@query
def ledger_recurring(r: Run) -> DataFrame:
    return posting.ledger_recurring(r.recurring)


@query
def receipts(r: Run) -> DataFrame:
    return posting.receipts(r.recurring)


@query
def policy_notes(r: Run) -> DataFrame:
    return posting.policy_notes(r.recurring, r.other)


@query
def receipt_other_fee(r: Run) -> DataFrame:
    return posting.receipt_other_fee(r.recurring)


@query
def card_tx(r: Run) -> DataFrame:
    return posting.card_tx(r.recurring, r.t("fx_policy_cc"))


@query
def account_tx(r: Run) -> DataFrame:
    return posting.account_tx(r.recurring, r.t("fx_policy_ac"))


@query
def close_bills(r: Run) -> DataFrame:
    return posting.close_bills(r.t("fx_billing"), r.recurring, r.t("fx_policy_cc"))


@query
def mark_executed(r: Run) -> DataFrame:
    return staging.mark_executed(r.mapped, plans.posted_rows(r.claims)).select("FileName", "id", "IsExec")


@query
def post_billing_other(r: Run) -> DataFrame:
    return r.other.select(
        "id", "BillingID", "BillingType", "bill_policy_id", "Amount", "TotalAmount", "CoreTranID", "source", "tran_id",
        "note_id", "receipt_other_id",
    )


@query
def ledger_other(r: Run) -> DataFrame:
    return posting.ledger_other(r.other)


@query
def receipt_other_billing(r: Run) -> DataFrame:
    return posting.receipt_other_billing(r.other)


@query
def card_tx_changes(r: Run) -> DataFrame:
    return posting.card_tx_changes(r.other)


@query
def apply_card_tx_changes(r: Run) -> DataFrame:
    return posting.apply_card_tx_changes(r.t("fx_card_transaction"), posting.card_tx_changes(r.other))


@query
def apply_quote_changes(r: Run) -> DataFrame:
    """The three tables one after another."""
    tables = {"quote": r.t("fx_quote"), "prospect": r.t("fx_prospect"), "quote_terminal": r.t("fx_quote_terminal")}
    done = posting.apply_quote_changes(tables, materialize(posting.quote_changes(r.quote)))
    none = F.lit(None).cast("string")
    shown = [
        done["quote"].select(F.lit("quote").alias("table_name"), "quote_id", none.alias("code"), F.col("quote_status").alias("status"),
                             F.col("quote_submitted_dt").alias("changed"), none.cast("int").alias("bank")),
        done["prospect"].select(F.lit("prospect").alias("table_name"), "quote_id", F.col("prospect_appr_code").alias("code"),
                                F.col("prospect_convert_flag").cast("string").alias("status"), F.col("updated_dt").alias("changed"),
                                F.col("acquirer_bank_id").alias("bank")),
        done["quote_terminal"].select(F.lit("quote_terminal").alias("table_name"), "quote_id", F.col("appr_code").alias("code"),
                                      F.concat_ws(":", F.col("status_id").cast("string"), "reason").alias("status"),
                                      none.cast("timestamp_ntz").alias("changed"), none.cast("int").alias("bank")),
    ]
    return reduce(DataFrame.unionByName, shown)


@query
def close_billing_others(r: Run) -> DataFrame:
    return posting.close_billing_others(r.t("fx_billing_others"), r.other)


@query
def post_quote(r: Run) -> DataFrame:
    return r.quote.select("id", "BillingID", "quote_id", "Amount", "source", "tran_id")


@query
def ledger_quote(r: Run) -> DataFrame:
    return posting.ledger_quote(r.quote)


@query
def quote_changes(r: Run) -> DataFrame:
    return posting.quote_changes(r.quote)


@query
def close_quotes(r: Run) -> DataFrame:
    return posting.close_quotes(r.t("fx_quote_billing"), r.quote)


def _entry(df: DataFrame, kind: str, key: str, amount: str) -> DataFrame:
    money = F.col(amount) if amount in df.columns else F.lit(None)
    return df.select(F.lit(kind).alias("output"), F.col(key).cast("string").alias("row_key"), money.cast("decimal(18,2)").alias("amount"))


def named_by_row(df: DataFrame) -> DataFrame:
    return df.withColumn("row", F.concat_ws(":", "FileName", F.col("id").cast("string")))


@query
def post_approved(r: Run) -> DataFrame:
    """Every row the approve step appends, as one journal."""
    done = plans.post_approved(r.claims, r.tables(), BRAND)
    named = [
        (done.ledger, "ledger", "tran_id", "BillAmount"),
        (done.receipts, "receipt", "receipt_id", "receipt_amount"),
        (done.receipt_other, "receipt_other", "receipt_other_id", "receipt_amount"),
        (done.notes, "note", "note_id", ""),
        (done.card_tx, "card_tx", "policy_cc_tran_id", "total_amount"),
        (done.account_tx, "account_tx", "policy_ac_tran_id", "total_amount"),
        (done.card_tx_changes, "card_tx_change", "receipt_other_id", ""),
        (done.quote_changes, "quote_change", "quote_id", ""),
        (named_by_row(done.emails), "email", "row", ""),
        (named_by_row(done.errors), "error", "row", ""),
    ]
    return reduce(DataFrame.unionByName, [_entry(*item) for item in named])


@query
def post_errors(r: Run) -> DataFrame:
    claims = r.claims
    return errors.post_errors(claims.allocated, claims.routed, plans.posted_claims(claims))


# --- rejects ---------------------------------------------------------------------------------

@query
def ledger_rejected(r: Run) -> DataFrame:
    return rejects.ledger_columns(r.reject_ledger)


@query
def touch_bills(r: Run) -> DataFrame:
    return rejects.touch_bills(r.t("fx_billing"), r.reject_ledger).select(
        "BillingID", "status_billing", "IsDownload", "LastUploadDate", "PaymentTransactionID", "BankIdDownload",
        "Source_download", "BillingDate",
    )


@query
def touch_others(r: Run) -> DataFrame:
    return rejects.touch_others(r.t("fx_billing_others"), r.reject_ledger).select(
        "BillingID", "status_billing", "IsDownload", "LastUploadDate", "PaymentTransactionID", "Source_download"
    )


@query
def touch_quotes(r: Run) -> DataFrame:
    return rejects.touch_quotes(r.t("fx_quote_billing"), r.reject_ledger).select(
        "quote_id", "status", "IsDownload", "LastUploadDate", "PaymentTransactionID", "Source_download"
    )


@query
def post_rejected(r: Run) -> DataFrame:
    """Reject ledger after the approve step: approvals have closed their bills first."""
    tables = r.tables()
    staged, bills, others, quotes = plans.state_after_approval(r.mapped, r.claims, tables)
    tables = replace(tables, billing=bills, billing_others=others, quote_billing=quotes)
    return rejects.ledger_columns(plans.post_rejected(staged, tables, RUN_TS).ledger)


@query
def hold_rejected(r: Run) -> DataFrame:
    return rejects.hold_rejected(r.mapped, r.t("fx_billinghold"), RUN_DATE)


# --- notifications ---------------------------------------------------------------------------

def _people(r: Run):
    return r.t("fx_policy_billing"), r.t("fx_customer_info"), r.t("fx_product")


@query
def email_recurring(r: Run) -> DataFrame:
    return notify.email_recurring(r.recurring, *_people(r), BRAND)


@query
def email_other(r: Run) -> DataFrame:
    return notify.email_other(r.other, *_people(r), BRAND)


@query
def email_quote(r: Run) -> DataFrame:
    return notify.email_quote(r.quote, r.t("fx_quote_billing"), r.t("fx_quote"), r.t("fx_product"), BRAND)
