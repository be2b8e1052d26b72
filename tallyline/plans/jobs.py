"""The three jobs over a store: upload a result file, execute it, remove it.

Each writes its tables under a run id and publishes the run last. A run that is repeated after a
crash overwrites its own files; a run that was published already changes nothing.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions.skew import DEFAULT, SkewPolicy
from tallyline.operators import control as ctl
from tallyline.operators import mapping, notify, posting, rejects, staging
from tallyline.plans import posting as steps
from tallyline.session import configure, materialize
from tallyline.sinks import STATUS, Store, is_open
from tallyline.sources.dispatch import LAYOUT_OF_FILE, parse_file, rejected_file

VA_FILE = 13


class AlreadyLoaded(RuntimeError):
    """The file of this control row is staged already."""


def _file_row(store: Store, file_id: int) -> Row:
    """The readable control row of a file (ids are unique, so at most one row comes back)."""
    row = ctl.file_by_id(store.current("control"), store.current("download_summary"), file_id).first()
    if row is None:
        raise ValueError(f"control row {file_id} has no file")
    return row


def _stage_table(store: Store, file_id: int) -> str | None:
    """The staging table named in the file's control row."""
    row = store.current("control").where(F.col("id") == file_id).select("stageTable").first()
    return row.stageTable if row else None


def _staged(store: Store, table: str | None) -> DataFrame:
    """Rows of one staging table. A job leaves the others alone."""
    return store.stage().where(F.col("stageTable").eqNullSafe(F.lit(table))).drop("stageTable")


def _other_parts(store: Store, table: str | None) -> list[tuple]:
    """The partitions of all other staging tables stay where they are."""
    return [tuple(part) for part in store.stage_parts() if part.stageTable != table]


def _own_parts(store: Store, table: str | None, files: DataFrame) -> list[tuple]:
    """The partitions of this staging table that hold the named files (a control row each, so they are few)."""
    kept = {row.FileName for row in files.select("FileName").distinct().collect()}
    return [tuple(part) for part in store.stage_parts() if part.stageTable == table and part.FileName in kept]


# --- upload ----------------------------------------------------------------------------------

def upload(store: Store, file_id: int, lines: DataFrame, run_id: str, run_ts: datetime) -> None:
    """Parse, clean, map and stage one file (``lines`` or cells), then recount. Lines and cells that can't
    be used are kept with their reason in the run's ``rejected`` table.

    The parsed rows are stored before mapping, so that the file is read once. Only they are mapped and
    written: the other half of a two-file upload was mapped when it came, and stays where it is.
    """
    configure(store.spark)
    store.refresh()
    if store.is_published(run_id):
        return
    if file_id not in LAYOUT_OF_FILE:
        raise ValueError(f"file id {file_id} has no layout")
    header = _file_row(store, file_id)
    control, table = store.current("control"), _stage_table(store, file_id)
    staged = _staged(store, table)
    if not staging.file_already_loaded(control, staged, file_id).isEmpty():
        raise AlreadyLoaded(header.FileName)
    kept = staging.stage_reset(staged, control, file_id)

    lines = lines.withColumn("FileName", F.lit(header.FileName))
    parsed = parse_file(lines, file_id)
    fresh = materialize(schemas.as_staging(staging.stage_normalize(parsed)))
    mapped = mapping.map_upload(
        fresh,
        store.current("policy_billing"),
        store.current("billing_others"),
        store.current("quote_billing"),
    )
    reasons = store.current("reason_map")
    mapped = mapping.reason_by_text(mapping.reason_by_code(mapped, reasons, header.bankid), reasons)
    if file_id == VA_FILE:
        mapped = staging.va_drop_paid(mapped, store.current("billing"))
    store.append(run_id, "rejected", rejected_file(lines, file_id))
    own = store.write_stage(run_id, mapped.withColumn("stageTable", F.lit(table).cast("string"))).drop("stageTable")
    parts = [*_other_parts(store, table), *_own_parts(store, table, kept), (table, header.FileName, run_id)]
    _recount(store, file_id, run_id, kept.unionByName(own), control)
    store.publish(run_id, ["upload_sum", "control"], run_ts, parts)


def _recount(store: Store, file_id: int, run_id: str, staged: DataFrame, control: DataFrame) -> None:
    """Count the rows of the file's staging table."""
    store.write(run_id, "upload_sum", ctl.upload_summary(store.current("upload_sum"), control, staged, file_id))
    store.write(run_id, "control", ctl.record_row_count(control, staged, file_id))


# --- execute ---------------------------------------------------------------------------------

def _tables(store: Store) -> steps.Tables:
    """What a run reads. Of bills and quotes only the open ones can be paid or rejected."""
    return steps.Tables(
        control=store.current("control"),
        policy_billing=store.current("policy_billing"),
        billing=store.open_part("billing"),
        billing_others=store.open_part("billing_others"),
        quote_billing=store.open_part("quote_billing"),
        reasons=store.current("reason_map"),
        policy_cc=store.current("policy_cc"),
        policy_ac=store.current("policy_ac"),
        customers=store.current("customer_info"),
        products=store.current("product"),
        quotes=store.current("quote"),
    )


def execute(
    store: Store,
    file_id: int,
    run_id: str,
    run_ts: datetime,
    texts: notify.MailTexts = notify.MailTexts(),
    new_bills: DataFrame | None = None,
    single_file: bool = True,
    policy: SkewPolicy = DEFAULT,
) -> bool:
    """Post one staged file. False when it is not due on the run date."""
    configure(store.spark)
    store.refresh()
    if store.is_published(run_id):
        return True
    due = ctl.files_due(store.current("control"), store.current("download_summary"), run_ts.date(), file_id)
    plan = ctl.run_policy(due, single_file).first()
    if plan is None:
        return False
    tables = replace(_tables(store), new_bills=new_bills)
    table = _stage_table(store, file_id)
    staged = _staged(store, table)
    closed = {name: store.current(name).where(~is_open(name)) for name in ("billing_others", "quote_billing")}

    if plan.do_approve:
        pool = staging.pool_approved(staged, tables.control, run_ts.date(), file_id)
        pool = staging.with_header(pool, tables.control, file_id)
        claims = steps.claim(pool, tables, run_ts, policy).materialized()
        outputs = dict(steps.post_approved(claims, tables, texts).items())
        # the paid bills are few and stored; the rows they lead to stay a plan until the end
        outputs["bill_changes"] = posting.bill_changes(claims.recurring, tables.policy_cc)
        outputs["ledger:approved"] = outputs.pop("ledger")
        done = store.write_all(run_id, outputs, appended=True)
        staged, bills, others, quotes = steps.state_after_approval(staged, claims, tables, done["bill_changes"])
        tables = replace(tables, billing=bills, billing_others=others, quote_billing=quotes, new_bills=None)
    if plan.do_reject:
        # a rejected one-off bill or quote counts if it exists, closed ones included
        known = {name: _with(getattr(tables, name), rows) for name, rows in closed.items()}
        rejected = steps.post_rejected(staged, replace(tables, **known), run_ts, file_id, policy)
        resolved = materialize(rejected.staged)
        ledger = materialize(rejects.ledger_rejected(resolved, tables.control, run_ts, file_id))
        store.append(run_id, "ledger:rejected", rejects.ledger_columns(ledger))
        bills, others, quotes = steps.state_after_rejection(ledger, tables)
        tables = replace(tables, billing=bills, billing_others=others, quote_billing=quotes)
        # the resolved rows replace their former selves
        staged = staging.without_rows(staged, resolved).unionByName(resolved)
    state = {
        "download_summary": ctl.download_cleared(store.current("download_summary"), tables.control, file_id),
        "control": ctl.release_control(tables.control, file_id),
    }
    if plan.do_hold:
        state["billinghold"] = rejects.hold_rejected(staged, store.current("billinghold"), run_ts.date())
    # each part is computed from stored claims and changes, once
    for name in STATUS:
        state[f"{name}_open"] = getattr(tables, name).where(is_open(name))
    store.write_all(run_id, state)
    store.write_all(run_id, {f"{name}_closed": getattr(tables, name).where(~is_open(name)) for name in STATUS}, appended=True)
    written = store.write_stage(run_id, staged.withColumn("stageTable", F.lit(table).cast("string")))
    files = [row.FileName for row in written.select("FileName").distinct().collect()]  # one per control row
    parts = [*_other_parts(store, table), *((table, name, run_id) for name in files)]
    store.publish(run_id, list(state), run_ts, parts)
    return True


def _with(rows: DataFrame, more: DataFrame) -> DataFrame:
    return rows.unionByName(more, allowMissingColumns=True)


def card_transactions(store: Store) -> DataFrame:
    """Card transactions as all published runs left them: the initial and the appended ones, each with the last
    change that names it. Changes are stored as they come; nothing is rewritten for them."""
    key = F.col("policy_cc_tran_id").cast("string")
    rows = store.current("card_transaction").withColumn("policy_cc_tran_id", key)
    if not store.has_appended("card_tx"):
        return rows
    rows = _with(rows, store.appended("card_tx").drop("run_id").withColumn("policy_cc_tran_id", key))
    changes = store.appended("card_tx_changes").drop("run_id").withColumn("policy_cc_tran_id", key)
    return posting.apply_card_tx_changes(rows, changes)


def quote_tables(store: Store) -> dict[str, DataFrame]:
    """Quotes, prospects and terminal rows as all published runs left them."""
    tables = {name: store.current(name) for name in posting.QUOTE_TABLES}
    if not store.has_appended("quote_changes"):
        return tables
    return posting.apply_quote_changes(tables, store.appended("quote_changes").drop("run_id"))


def execute_due(store: Store, run_id: str, run_ts: datetime, **options) -> list[int]:
    """Post every due file, in order of its id: later files see the bills earlier ones paid."""
    due = ctl.files_due(store.current("control"), store.current("download_summary"), run_ts.date())
    # one row per bank file, as many as the control table has
    ids = sorted(row.id for row in due.select("id").collect())
    for file_id in ids:
        execute(store, file_id, f"{run_id}-{file_id}", run_ts, single_file=False, **options)
    return ids


# --- remove ----------------------------------------------------------------------------------

def remove(store: Store, file_id: int, run_id: str, run_ts: datetime) -> None:
    """Take a file back: clear its staged rows, release its control row, recount."""
    configure(store.spark)
    store.refresh()
    if store.is_published(run_id):
        return
    control = store.current("control")
    table = _stage_table(store, file_id)
    kept = staging.stage_reset(_staged(store, table), control, file_id)
    _recount(store, file_id, run_id, kept, ctl.release_control(control, file_id))
    parts = [*_other_parts(store, table), *_own_parts(store, table, kept)]
    store.publish(run_id, ["upload_sum", "control"], run_ts, parts)
