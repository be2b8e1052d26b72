"""Small hand-made cases for the rules a rewrite would easily change."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyline.operators import allocation, control, errors, mapping, posting, rejects, staging
from tallyline.schemas import as_staging
from tests.conftest import rows

NOW, TODAY = datetime(2024, 1, 10), date(2024, 1, 10)


def stage(spark, *data, columns="id bigint, PolisNo string"):
    return as_staging(spark.createDataFrame(list(data), columns))


def with_columns(spark, *data, columns):
    return spark.createDataFrame(list(data), columns)


def quotes(spark, *data):
    return spark.createDataFrame(list(data), "quote_id bigint, ref_no string, status string")


def found(df, *names):
    return [tuple(r) for r in df.orderBy("id").select(*names).collect()]


def test_quote_id_comes_before_reference(spark):
    staged = stage(spark, (1, "X7"), (2, "X007"), (3, "XAX7"), (4, "XR9"), (5, "X8"), (6, "Xno"))
    known = quotes(spark, (7, "XR7", "P"), (9, "XR9", "P"), (10, "XR9", "A"), (11, "X7", "A"), (12, "X8", "A"), (13, "X008", "A"))
    empty_p = spark.createDataFrame([], "policy_no string, policy_id bigint")
    empty_o = spark.createDataFrame([], "BillingID string")
    mapped = mapping.map_upload(staged, empty_p, empty_o, known)
    expected = [("7", "Q"), ("7", "Q"), ("7", "Q"), ("10", "Q"), ("12", "Q"), (None, None)]
    assert found(mapped, "BillingID", "BillCode") == expected
    # the four mappings one after another give the same
    chain = mapping.map_policy(staged, empty_p)
    chain = mapping.map_billing_other(chain, empty_o)
    chain = mapping.map_quote_ref(mapping.map_quote_id(chain, known), known)
    assert rows(chain) == rows(mapped)


def test_spelling_of_a_reference_counts(spark):
    known = quotes(spark, (20, "X008", "A"), (21, "X08", "A"))
    mapped = mapping.map_quote_ref(stage(spark, (1, "X008"), (2, "X08"), (3, "X8")), known)
    assert found(mapped, "BillingID") == [("20",), ("21",), (None,)]


def test_first_letter_guards_and_lowest_id(spark):
    staged = stage(spark, (1, "A1"), (2, "71"), (3, None), (4, ""))
    policies = spark.createDataFrame([("A1", 5), ("71", 9), ("71", 8)], "policy_no string, policy_id bigint")
    mapped = mapping.map_policy(staged, policies)
    assert found(mapped, "PolisId", "BillCode") == [(None, None), (8, "B"), (None, None), (None, None)]


def test_mapped_and_posted_rows_stay(spark):
    staged = stage(
        spark, (1, "71", 3, None, False), (2, "71", None, None, True), columns="id bigint, PolisNo string, PolisId bigint, BillCode string, IsExec boolean"
    )
    policies = spark.createDataFrame([("71", 9)], "policy_no string, policy_id bigint")
    assert found(mapping.map_policy(staged, policies), "PolisId") == [(3,), (None,)]


REASONS = "RejectCode string, RejectReason string, GroupRejectMappingID int, bank_id int"


def test_reasons(spark):
    reasons = spark.createDataFrame([("05", "NO MONEY", 4, 1), ("05", "OTHER", 3, 2), ("06", "CLOSED", 8, None), ("07", "CLOSED", 7, 0)], REASONS)
    staged = stage(
        spark,
        (1, "05", None, False),
        (2, "99", None, False),
        (3, None, "CLOSED", False),
        (4, None, "odd text", False),
        (5, "123456", "fine", True),
        (6, None, None, False),
        columns="id bigint, ApprovalCode string, Deskripsi string, IsSukses boolean",
    )
    coded = mapping.reason_by_code(staged, reasons, 1)
    assert found(coded, "Deskripsi", "RejectGroupID")[:2] == [("NO MONEY", 4), (None, None)]
    final = mapping.reason_by_text(coded, reasons)
    # the lowest group of equal texts; unmatched texts go, those of approved rows too
    assert found(final, "Deskripsi", "RejectGroupID") == [
        ("NO MONEY", 4), (None, None), ("CLOSED", 7), (None, None), (None, None), (None, None),
    ]
    kept = mapping.reason_by_text(coded, reasons, blank_unmatched=False)
    assert found(kept, "Deskripsi")[3:5] == [("odd text",), ("fine",)]
    at_post = mapping.reason_at_post(final.where("not IsSukses"), reasons)
    assert found(at_post, "Deskripsi", "RejectGroupID") == [
        ("NO MONEY", 4), ("99", None), ("CLOSED", 7), (None, None), (None, None),
    ]
    by_code = mapping.reason_at_post(final.where("id = 1"), reasons, by_code=True)
    assert found(by_code, "Deskripsi", "RejectGroupID") == [("OTHER", 3)]


def test_normalize(spark):
    staged = stage(spark, (1, "", "it's", "", "O'N"), columns="id bigint, ApprovalCode string, Deskripsi string, AccNo string, AccName string")
    assert found(staging.stage_normalize(staged), "ApprovalCode", "Deskripsi", "AccNo", "AccName") == [(None, "it*s", None, "O*N")]


def test_two_payments_for_one_bill(spark):
    pool = spark.createDataFrame(
        [("f", 2, "A", "A1", 5.0), ("f", 1, "A", "A1", 9.0), ("f", 3, "Q", "A1", 1.0), ("f", 4, "A", "A2", 1.0)],
        "FileName string, id bigint, BillCode string, BillingID string, Amount double",
    )
    assert rows(allocation.first_claim(pool).select("id", "BillingID")) == [(1, "A1"), (3, "A1"), (4, "A2")]


@pytest.mark.parametrize("length,kept", [(299, 299), (300, 299), (301, 299)])
def test_error_length(spark, length, kept):
    df = spark.createDataFrame([("x" * length,)], "m string")
    assert len(df.select(errors.short_message(F.col("m"))).first()[0]) == kept


def test_hold(spark):
    staged = stage(spark, (1, 1, False), (2, 1, False), (3, 2, False), (4, 3, True), (5, None, False), (6, 4, False), columns="id bigint, PolisId bigint, IsSukses boolean")
    holds = spark.createDataFrame(
        [(1, date(2024, 3, 1), "mine"), (2, date(2024, 1, 1), "old"), (3, date(2024, 1, 1), "other"), (9, date(2024, 1, 2), "far")],
        "policy_id bigint, ReleaseDate date, Description string",
    )
    until = date(2024, 1, 25)
    held = {r.policy_id: (r.ReleaseDate, r.Description, r.UserCrt, r.UserUpdate) for r in rejects.hold_rejected(staged, holds, TODAY).collect()}
    assert held == {
        1: (date(2024, 3, 1), "mine", None, "system"),
        2: (until, rejects.HOLD_TEXT, None, "system"),
        3: (date(2024, 1, 1), "other", None, None),
        4: (until, rejects.HOLD_TEXT, "system", None),
        9: (date(2024, 1, 2), "far", None, None),
    }


def test_va_rows_paid_before_are_dropped_once(spark):
    paid = datetime(2024, 1, 1, 10)
    staged = stage(spark, (1, 1, paid), (2, 1, datetime(2024, 1, 1, 11)), (3, None, paid), columns="id bigint, PolisId bigint, TranDate timestamp_ntz")
    bills = spark.createDataFrame([(1, paid, "P"), (1, paid, "P"), (1, datetime(2024, 1, 1, 11), "A")], "policy_id bigint, paid_date timestamp_ntz, status_billing string")
    assert found(staging.va_drop_paid(staged, bills), "id") == [(2,), (3,)]


def test_removing_a_file_keeps_rows_without_one(spark):
    staged = stage(spark, (1, "a"), (2, None), (3, "b"), columns="id bigint, FileName string")
    files = spark.createDataFrame([(1, "a", TODAY, 1), (2, "b", TODAY, 1), (4, "b", TODAY, 2)], "id int, FileName string, tglProses date, id_billing_download int")
    assert found(staging.stage_remove_file(staged, files, 1), "id") == [(2,), (3,)]
    assert found(staging.stage_reset(staged, files, 1), "id") == [(2,), (3,)]
    assert staging.stage_reset(staged.where("id <> 3"), files, 1).isEmpty()
    assert staging.stage_reset(staged, files, 4).isEmpty()


def test_download_cleared(spark):
    money = "id int, file_download string, TotalAmountDWD decimal(18,2), TotalCountDWD int"
    d = spark.createDataFrame([(1, "a", Decimal(0), 0), (2, "b", Decimal(5), 0), (3, "c", None, 0)], money)
    assert [r.file_download for r in control.download_cleared(d).orderBy("id").collect()] == [None, "b", "c"]


def test_money_is_conserved(spark, sf):
    """Receipts and fees add up to the payments; every bill is used once; rejects stay off paid bills."""
    from checks.registry import Run
    from tallyline.plans import posting as plans

    run = Run(spark, sf)
    posted = run.recurring.where("cashless_fee_amount is not null")
    paid = posted.agg(F.sum("Amount")).first()[0]
    net = posting.receipts(posted).agg(F.sum("receipt_amount")).first()[0]
    fees = posting.receipt_other_fee(posted).agg(F.coalesce(F.sum("receipt_amount"), F.lit(0))).first()[0]
    assert paid == net + fees
    bills = run.recurring.select("bill_id")
    assert bills.count() == bills.distinct().count()

    claims, tables = run.claims, run.tables()
    pooled = run.pool.count()
    skipped = claims.routed.where("route = 'skipped_va'").count()
    done = claims.recurring.count() + claims.other.count() + claims.quote.count()
    failed = errors.post_errors(claims.allocated, claims.routed, plans.posted_claims(claims)).count()
    assert pooled == done + failed + skipped
    closed = posting.close_bills(tables.billing, claims.recurring, tables.policy_cc)
    rejected = allocation.allocate_rejected(run.mapped, closed).where("BillingID is not null")
    used = rejected.select(F.col("BillingID").try_cast("bigint").alias("bill_id"))
    assert used.join(bills, "bill_id").isEmpty()


def test_mail_without_addressee_is_queued_empty(spark):
    from tallyline.operators import notify

    posted = spark.createDataFrame([("f", 1, 5, Decimal("1500"), NOW)], "FileName string, id bigint, PolisId bigint, Amount decimal(18,2), run_ts timestamp_ntz")
    policies = spark.createDataFrame([], "policy_id bigint, policy_no string, holder_id bigint, product_id bigint")
    people = spark.createDataFrame([], "CustomerId bigint, CustomerName string, IsLaki boolean, Email string")
    goods = spark.createDataFrame([], "product_id bigint, product_description string")
    row = notify.email_recurring(posted, policies, people, goods).first()
    assert (row.email_to, row.email_subject, row.email_status) == (None, None, "P")


def test_null_names_of_a_found_customer_are_blank(spark):
    from tallyline.operators import notify

    posted = spark.createDataFrame([("f", 1, 5, Decimal("1500"), NOW)], "FileName string, id bigint, PolisId bigint, Amount decimal(18,2), run_ts timestamp_ntz")
    policies = spark.createDataFrame([(5, "P5", 3, 4)], "policy_id bigint, policy_no string, holder_id bigint, product_id bigint")
    people = spark.createDataFrame([(3, None, None, None)], "CustomerId bigint, CustomerName string, IsLaki boolean, Email string")
    goods = spark.createDataFrame([(4, None)], "product_id bigint, product_description string")
    texts = notify.MailTexts(brand="B", recurring=("{brand}|{name}|{policy}", "{product}|{amount}"))
    row = notify.email_recurring(posted, policies, people, goods, texts).first()
    assert (row.email_to, row.email_subject, row.email_body) == ("", "B||P5", "|1,500")


def test_long_quote_numbers(spark):
    staged = stage(spark, (1, "X0000000000000000005"), (2, "X1000000000000000001"), (3, "X99999999999999999999"), (4, "X0"))
    known = quotes(spark, (5, "r5", "A"), (1000000000000000001, "r6", "A"), (0, "r0", "A"))
    empty_p = spark.createDataFrame([], "policy_no string, policy_id bigint")
    empty_o = spark.createDataFrame([], "BillingID string")
    mapped = mapping.map_upload(staged, empty_p, empty_o, known)
    assert found(mapped, "BillingID") == [("5",), ("1000000000000000001",), (None,), ("0",)]


def test_second_failed_row_updates_a_new_hold(spark):
    staged = stage(spark, (1, 4, False), (2, 4, False), (3, 5, False), columns="id bigint, PolisId bigint, IsSukses boolean")
    none = spark.createDataFrame([], "policy_id bigint, ReleaseDate date, Description string")
    held = {r.policy_id: (r.UserCrt, r.DateUpdate, r.UserUpdate) for r in rejects.hold_rejected(staged, none, TODAY).collect()}
    assert held == {4: ("system", TODAY, "system"), 5: ("system", None, None)}


def test_equal_ids_in_two_files(spark):
    staged = stage(spark, (1, "a.txt"), (1, "b.txt"), (2, "a.txt"), columns="id bigint, FileName string")
    posted = staged.where("id = 1 and FileName = 'b.txt'")
    assert rows(staging.mark_executed(staged, posted).select("id", "FileName", "IsExec")) == [
        (1, "a.txt", False), (1, "b.txt", True), (2, "a.txt", False)
    ]
    assert rows(staging.without_rows(staged, posted).select("id", "FileName")) == [(1, "a.txt"), (2, "a.txt")]


def test_equal_ids_in_two_files_post_and_fail_apart(spark):
    """Row 1 of two files: one is posted, the other finds its bill paid and is reported."""
    columns = "id bigint, FileName string, BillCode string, BillingID string, PolisNo string, trancode string, IsSukses boolean, route string"
    pool = with_columns(
        spark, (1, "a.txt", "A", "A1", "p", "T", True, "other"), (1, "b.txt", "A", "A1", "p", "T", True, "other"),
        (2, "b.txt", "A", "A2", "p", "T", True, "other"), columns=columns,
    )
    claimed = allocation.first_claim(pool)
    assert rows(claimed.select("BillingID", "FileName", "id")) == [("A1", "a.txt", 1), ("A2", "b.txt", 2)]
    none = spark.createDataFrame(
        [], "FileName string, id bigint, trancode string, PolisNo string, IsSukses boolean, PolisId bigint, bill_id bigint"
    )
    found = errors.post_errors(none, pool, claimed)
    assert rows(found.select("FileName", "id")) == [("b.txt", 1)]


def test_equal_ids_break_ties_by_file(spark):
    """Equal amounts and ids: the file decides which payment gets the first bill."""
    pool = with_columns(spark, (1, "b.txt", 7, 5), (1, "a.txt", 7, 5), columns="id bigint, FileName string, PolisId bigint, Amount int")
    bills = spark.createDataFrame(
        [(10, 7, 1), (11, 7, 2)], "BillingID bigint, policy_id bigint, recurring_seq int"
    ).selectExpr(
        "*", "'A' as status_billing", "5 as TotalAmount", "0 as cashless_fee_amount", "1 as freq_payment",
        "date '2024-01-01' as due_dt_pre", "'' as AccNo", "'' as AccName", "date '2024-01-01' as BillingDate",
    )
    paid = allocation.allocate_approved(pool, bills)
    assert rows(paid.select("FileName", "bill_id")) == [("a.txt", 10), ("b.txt", 11)]


def test_the_last_change_of_a_transaction_counts(spark):
    known = spark.createDataFrame([(1, 1, "x"), (2, 1, "x"), (3, 1, "x")], "policy_cc_tran_id bigint, status_id int, other string")
    changes = spark.createDataFrame(
        [
            ("a.txt", 9, 1, 2, "r1", 1), ("b.txt", 1, 1, 2, "r2", 1), ("a.txt", 1, 2, 2, "r3", 2), ("b.txt", 1, 2, 2, "r0", 1),
            ("a.txt", 2, None, 2, "r4", 1), ("a.txt", 3, 8, 2, "r5", 1),
        ],
        "stage_file string, stage_id bigint, policy_cc_tran_id bigint, status_id int, receipt_other_id string, update_dt int",
    )
    found = posting.apply_card_tx_changes(known, changes).drop("update_dt")
    assert rows(found) == [(1, 2, "x", "r2"), (2, 2, "x", "r3"), (3, 1, "x", None)]
    assert rows(posting.apply_card_tx_changes(known, changes.limit(0)).select("policy_cc_tran_id", "status_id")) == [(1, 1), (2, 1), (3, 1)]


def test_one_quote_change_reaches_three_tables(spark):
    tables = {
        "quote": spark.createDataFrame([(1, "A"), (2, "A")], "quote_id bigint, quote_status string"),
        "prospect": spark.createDataFrame([(1, 1, 1), (1, 2, 1), (2, 1, 1)], "quote_id bigint, no int, prospect_convert_flag int"),
        "quote_terminal": spark.createDataFrame([(2, 0, "late")], "quote_id bigint, status_id int, reason string"),
    }
    posted = spark.createDataFrame([("a.txt", 1, 1, 7)], "FileName string, id bigint, quote_id bigint, bankid int")
    changes = posting.quote_changes(posted.withColumn("run_ts", F.lit(NOW).cast("timestamp_ntz")))
    done = posting.apply_quote_changes(tables, changes)
    assert rows(done["quote"].select("quote_id", "quote_status")) == [(1, "P"), (2, "A")]
    assert rows(done["prospect"].select("quote_id", "no", "prospect_convert_flag", "acquirer_bank_id")) == [
        (1, 1, 2, 7), (1, 2, 2, 7), (2, 1, 1, None)
    ]
    assert rows(done["quote_terminal"]) == [(2, 0, "late", None)]
