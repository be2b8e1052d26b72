"""The jobs end to end over a store in a temporary folder."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.fixtures import view
from tallyline.plans import jobs
from tallyline.sinks import Store, append_stage
from tallyline.sources import dispatch
from tests.conftest import rows

NOW = datetime(2024, 1, 10, 8, 30)
TABLES = {
    "control": "fx_control",
    "download_summary": "fx_download_summary",
    "policy_billing": "fx_policy_billing",
    "billing": "fx_billing",
    "billing_others": "fx_billing_others",
    "quote_billing": "fx_quote_billing",
    "quote": "fx_quote",
    "prospect": "fx_prospect",
    "quote_terminal": "fx_quote_terminal",
    "card_transaction": "fx_card_transaction",
    "reason_map": "fx_reason_map",
    "policy_cc": "fx_policy_cc",
    "policy_ac": "fx_policy_ac",
    "customer_info": "fx_customer_info",
    "product": "fx_product",
    "billinghold": "fx_billinghold",
    "upload_sum": "fx_upload_sum",
}
OUTPUTS = ("ledger", "receipts", "receipt_other", "notes", "card_tx", "account_tx", "emails", "errors")


@pytest.fixture(scope="module")
def store(spark, sf, tmp_path_factory):
    made = Store(spark, str(tmp_path_factory.mktemp("store")))
    for name, fixture in TABLES.items():
        made.put_base(name, view(spark, sf, fixture))
    return made


def _lines(spark, sf, layout, file_id):
    lines = view(spark, sf, f"fx_lines_{layout}")
    return lines.where(F.col("FileName") == f"bank_{file_id}.txt")


def test_upload_execute_remove(spark, sf, store):
    # account file 12: approvals, rejections and holds
    jobs.upload(store, 12, _lines(spark, sf, "acct_fixed_b", 12), "up-12", NOW)
    staged = store.stage()
    assert staged.count() > 0
    assert staged.where("BillCode = 'B'").count() > 0
    assert staged.where("AccName like '%''%'").count() == 0
    left_out = store.appended("rejected")
    assert left_out.count() > 0 and left_out.where("reason is null").isEmpty()
    assert staged.count() + left_out.count() == _lines(spark, sf, "acct_fixed_b", 12).count()
    counted = store.current("control").where("id = 12").first().total_data
    assert counted == staged.count()
    with pytest.raises(jobs.AlreadyLoaded):
        jobs.upload(store, 12, _lines(spark, sf, "acct_fixed_b", 12), "up-12-again", NOW)

    before = store.current("billing").where("status_billing = 'P'").count()
    assert jobs.execute(store, 12, "run-12", NOW)
    receipts = store.appended("receipts")
    posted = receipts.count()
    assert posted > 0
    assert store.current("billing").where("status_billing = 'P'").count() == before + posted
    assert store.appended("account_tx").count() == posted
    assert store.current("control").where("id = 12").first().FileName is None
    ledger = store.ledger()
    approved = ledger.where("part = 'approved'")
    assert store.stage().where("IsExec and IsSukses").count() == approved.count() > 0
    assert ledger.where("IsSuccess").count() == approved.count()
    assert ledger.where("part = 'rejected' and not IsSuccess").count() == ledger.count() - approved.count() > 0
    assert ledger.where("run_id <> 'run-12'").isEmpty()
    failed = staged.where("not IsSukses and PolisId is not null").select("PolisId").distinct().count()
    held = store.current("billinghold").where("UserCrt = 'system' or UserUpdate = 'system'").count()
    assert held == failed > 0

    # a published run is not run again
    names = OUTPUTS
    first = {name: rows(store.appended(name).drop("run_id")) for name in names}
    state = {name: rows(store.current(name)) for name in ("billing", "billing_others", "quote_billing")}
    staged_before = rows(store.stage())
    assert jobs.execute(store, 12, "run-12", NOW)
    assert {name: rows(store.appended(name).drop("run_id")) for name in names} == first
    assert {name: rows(store.current(name)) for name in state} == state
    assert rows(store.stage()) == staged_before


def test_unpublished_run_repeats_to_the_same_rows(spark, sf, tmp_path_factory):
    made = Store(spark, str(tmp_path_factory.mktemp("crash")))
    for name, fixture in TABLES.items():
        made.put_base(name, view(spark, sf, fixture))
    jobs.upload(made, 7, _lines(spark, sf, "card_fixed_b", 7), "up-7", NOW)
    class NoPublish(Store):
        def publish(self, *a):
            raise RuntimeError("lost before publishing")

    broken = NoPublish(spark, made.folder)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.execute(broken, 7, "run-7", NOW)
    half = rows(spark.read.parquet(made.path("tables", "receipts", "run_id=run-7")))
    assert made.stage().where("IsExec").count() == 0
    assert made.appended("receipts").isEmpty()  # not published
    assert jobs.execute(made, 7, "run-7", NOW)
    assert rows(made.appended("receipts").drop("run_id")) == half and half


def test_staging_tables_are_kept_apart(spark, sf, tmp_path_factory):
    made = Store(spark, str(tmp_path_factory.mktemp("tables")))
    for name, fixture in TABLES.items():
        rows_of = view(spark, sf, fixture)
        if name == "control":
            rows_of = rows_of.withColumn("stageTable", F.concat(F.lit("stage_"), F.col("id").cast("string")))
        made.put_base(name, rows_of)
    jobs.upload(made, 11, _lines(spark, sf, "acct_fixed_a", 11), "up-11", NOW)
    first = made.stage().count()
    jobs.upload(made, 12, _lines(spark, sf, "acct_fixed_b", 12), "up-12", NOW)
    assert made.stage().where("FileName = 'bank_11.txt'").count() == first > 0
    totals = {r.id: r.total_data for r in made.current("control").collect()}
    assert totals[11] == first and totals[12] == made.stage().count() - first > 0
    for file_id in (11, 12):
        assert jobs.execute(made, file_id, f"run-{file_id}", NOW)
    receipts = made.appended("receipts")
    assert receipts.where("run_id = 'run-11'").count() > 0 and receipts.where("run_id = 'run-12'").count() > 0


def count(spark, store, *path):
    return spark.read.parquet(store.path(*path)).count()


def test_a_run_writes_what_it_changes(spark, sf, tmp_path_factory):
    """Closed bills are not written again, an upload writes its own file's rows, and changes are stored as
    they come, however large the tables are."""
    made = Store(spark, str(tmp_path_factory.mktemp("state")))
    for name, fixture in TABLES.items():
        made.put_base(name, view(spark, sf, fixture))
    total = made.current("billing").count()
    still_open = made.open_part("billing").count()
    assert 0 < still_open < total
    jobs.upload(made, 7, _lines(spark, sf, "card_fixed_b", 7), "up-7", NOW)
    first = made.stage().count()
    jobs.upload(made, 8, _lines(spark, sf, "card_fixed_b", 8), "up-8", NOW)
    assert made.stage().count() == first + count(spark, made, "runs", "up-8", "stage")
    assert jobs.execute(made, 8, "run-8", NOW)
    paid = made.appended("receipts").count()
    assert paid > 0
    assert count(spark, made, "tables", "billing_closed", "run_id=run-8") == paid
    assert count(spark, made, "runs", "run-8", "billing_open") == still_open - paid
    assert made.current("billing").count() == total
    assert made.current("billing").select("BillingID").distinct().count() == total
    # applied changes: the new transactions and the changed ones, read together
    moved = made.appended("card_tx_changes").select("policy_cc_tran_id").distinct()
    cards = jobs.card_transactions(made)
    base = made.current("card_transaction")
    assert cards.count() == base.count() + made.appended("card_tx").count()
    known = moved.join(base, "policy_cc_tran_id", "left_semi").count()
    assert cards.where("receipt_other_id is not null and result_status is not null").count() == known > 0
    quotes = jobs.quote_tables(made)
    posted = made.appended("quote_changes").select("quote_id").distinct().count()
    assert quotes["quote"].where("quote_status = 'P'").count() == posted > 0
    assert quotes["prospect"].count() == made.current("prospect").count()


def test_two_sheet_files_in_one_staging_table(spark, sf, tmp_path_factory):
    """Rows of equal numbers in two files and two worksheets each: all are staged, posted and resolved once."""
    made = Store(spark, str(tmp_path_factory.mktemp("sheets")))
    for name, fixture in TABLES.items():
        rows_of = view(spark, sf, fixture)
        if name == "control":  # files 7 and 8 come as two halves; here they bring sheets
            rows_of = rows_of.where("id in (7, 8)")
        made.put_base(name, rows_of)
    cells = view(spark, sf, "fx_cells_card_sheet_b")
    layouts = dict(dispatch.LAYOUT_OF_FILE)
    dispatch.LAYOUT_OF_FILE.update({7: "card_sheet_b", 8: "card_sheet_b"})
    try:
        for file_id in (7, 8):
            jobs.upload(made, file_id, cells.where(F.col("FileName") == f"bank_{file_id}.txt"), f"up-{file_id}", NOW)
        staged = made.stage()
        assert staged.select("id").distinct().count() < staged.count()
        assert staged.select("FileName", "id").distinct().count() == staged.count()
        before = staged.count()
        assert jobs.execute(made, 8, "run-8", NOW)
    finally:
        dispatch.LAYOUT_OF_FILE.update(layouts)
    after = made.stage()
    assert after.count() == before
    assert after.select("FileName", "id").distinct().count() == before
    approved = made.ledger().where("part = 'approved'")
    assert after.where("IsExec").count() == approved.count() > 0
    # policy rows of the other file wait for their own run
    assert after.where("IsExec and BillCode = 'B' and FileName = 'bank_7.txt'").isEmpty()


def test_two_file_upload_keeps_the_other_half(spark, sf, store):
    jobs.upload(store, 1, _lines(spark, sf, "card_fixed_a", 1), "up-1", NOW)
    one = store.stage().count()
    jobs.upload(store, 2, _lines(spark, sf, "card_fixed_a", 2), "up-2", NOW)
    files = {r.FileName for r in store.stage().select("FileName").distinct().collect()}
    assert files == {"bank_1.txt", "bank_2.txt"}
    jobs.remove(store, 2, "rm-2", NOW)
    assert store.stage().count() == one
    row = store.current("control").where("id = 2").first()
    assert row.FileName is None and row.total_data == 0


def test_due_files_run_in_order(spark, sf, store):
    # files 1 and 13 are left due; only file 1 is staged
    control = store.current("control")
    kept = F.when(F.col("id").isin(1, 13), F.col("tglProses"))
    store.write("plan", "control", control.withColumn("tglProses", kept))
    store.publish("plan", ["control"], NOW)
    assert jobs.execute_due(store, "night", NOW) == [1, 13]
    assert store.current("control").where("id in (1, 13) and FileName is not null").isEmpty()
    assert jobs.execute(store, 1, "again", NOW) is False


def test_append_stage_replaces_a_file(spark, sf, tmp_path):
    path = str(tmp_path / "stage")
    upload = view(spark, sf, "fx_upload")
    append_stage(upload, path)
    total = spark.read.parquet(path).count()
    append_stage(upload.where("FileName = 'bank_4.txt'"), path)
    assert spark.read.parquet(path).count() == total
