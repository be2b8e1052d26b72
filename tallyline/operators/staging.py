"""The staging table: cleaning, existence checks, removal and the approved pool."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.skew import lookup_join
from tallyline.functions.text import blank_to_null
from tallyline.operators.control import TWO_FILE_UPLOADS


def stage_normalize(parsed: DataFrame, file_name: str | None = None) -> DataFrame:
    """Empty texts become NULL and apostrophes in description and holder become ``*``."""

    def starred(name: str) -> Column:
        return blank_to_null(F.translate(F.col(name), "'", "*"))

    rows = parsed.withColumns(
        {
            "ApprovalCode": blank_to_null(F.col("ApprovalCode")),
            "Deskripsi": starred("Deskripsi"),
            "AccNo": blank_to_null(F.col("AccNo")),
            "AccName": starred("AccName"),
        }
    )
    return rows if file_name is None else rows.withColumn("FileName", F.lit(file_name))


def _staged_files(staged: DataFrame) -> DataFrame:
    # reduced map-side: one row per file, however many rows a file has
    return staged.select("FileName").where("FileName is not null").distinct()


def file_already_loaded(control: DataFrame, staged: DataFrame, file_id: int | None = None) -> DataFrame:
    """Control rows whose file has rows in staging."""
    rows = control.where(F.col("FileName").isNotNull() & F.col("tglProses").isNotNull())
    if file_id is not None:
        rows = rows.where(F.col("id") == file_id)
    return rows.join(_staged_files(staged), "FileName", "left_semi").select("id", "FileName")


def sibling_file_loaded(control: DataFrame, staged: DataFrame, file_id: int | None = None) -> DataFrame:
    """Ids of control rows with another row of the same download whose file is staged."""
    own = control.select(F.col("id"), F.col("id_billing_download"))
    if file_id is not None:
        own = own.where(F.col("id") == file_id)
    loaded = control.join(_staged_files(staged), "FileName", "left_semi").select(
        F.col("id").alias("sibling_id"), F.col("id_billing_download").alias("sibling_download")
    )
    same = (F.col("id_billing_download") == F.col("sibling_download")) & (F.col("id") != F.col("sibling_id"))
    return own.join(loaded, same, "left_semi").select("id")


def stage_remove_file(staged: DataFrame, control: DataFrame, file_id: int) -> DataFrame:
    """Staging without the rows of one file; rows without a file name stay."""
    own = control.where(
        F.col("FileName").isNotNull() & F.col("tglProses").isNotNull() & (F.col("id") == file_id)
    ).select("FileName")
    # control rows are unique by id: at most one row
    return staged.join(F.broadcast(own), "FileName", "left_anti").select(*staged.columns)


def stage_reset(staged: DataFrame, control: DataFrame, file_id: int) -> DataFrame:
    """Staging before a load: emptied, but the other half of a two-file upload is kept.

    Where rows say which staging table they belong to (``stageTable``), only the table named in the
    file's control row is emptied."""
    if "stageTable" in staged.columns:
        # control rows are unique by id: at most one row
        own = F.broadcast(control.where(F.col("id") == file_id).select(F.col("stageTable").alias("_table")))
        same = F.col("stageTable").eqNullSafe(F.col("_table"))
        reset = stage_reset(staged.join(own, same, "left_semi").drop("stageTable"), control, file_id)
        reset = reset.crossJoin(own.withColumnRenamed("_table", "stageTable"))  # one row
        return staged.join(own, same, "left_anti").unionByName(reset).select(*staged.columns)
    if file_id not in TWO_FILE_UPLOADS:
        return staged.limit(0)
    other_half = sibling_file_loaded(control, staged, file_id)
    return stage_remove_file(staged, control, file_id).where(other_half.exists())


def va_drop_paid(staged: DataFrame, bills: DataFrame) -> DataFrame:
    """Drop rows that repeat a payment: same policy and payment time as a paid bill."""
    paid = (
        bills.where((F.col("status_billing") == "P") & F.col("paid_date").isNotNull())
        .select(F.col("policy_id").alias("PolisId"), F.col("paid_date").cast("timestamp_ntz").alias("TranDate"))
        .distinct()
    )
    # rows already flagged as posted go too
    rows = staged.where(~F.col("IsExec")) if "IsExec" in staged.columns else staged
    kept = lookup_join(rows, paid, ["PolisId", "TranDate"], "left_anti")
    return kept.select(*staged.columns)


def pool_approved_policy(
    staged: DataFrame, control: DataFrame, run_date: date, file_id: int | None = None
) -> DataFrame:
    """Approved, unposted policy rows of the files due today (or of one of them)."""
    due = control.where(
        F.col("FileName").isNotNull() & (F.col("tglProses") == F.lit(run_date))
    )
    if file_id is not None:
        due = due.where(F.col("id") == file_id)
    rows = staged.where(~F.col("IsExec") & F.col("IsSukses") & (F.col("BillCode") == "B"))
    return rows.join(due.select("FileName"), "FileName", "left_semi").select(*staged.columns)


def pool_approved_other(staged: DataFrame, file_id: int | None = None, control: DataFrame | None = None) -> DataFrame:
    """Approved, unposted one-off bill and quote rows of the whole staging table.

    Given ``control`` and ``file_id`` only the rows of that file are taken.
    """
    rows = staged.where(
        ~F.col("IsExec") & F.col("IsSukses") & (F.col("BillCode") != "B") & F.col("BillingID").isNotNull()
    )
    if control is not None and file_id is not None:
        own = control.where(F.col("id") == file_id).select("FileName")
        rows = rows.join(F.broadcast(own), "FileName", "left_semi")
    return rows.select(
        "id", "PolisNo", "Amount", "ApprovalCode", "Deskripsi", "AccNo", "AccName", "IsSukses", "BillingID", "BillCode",
        "FileName",
    )


def pool_approved(staged: DataFrame, control: DataFrame, run_date: date, file_id: int | None = None) -> DataFrame:
    """Both pools; one-off and quote rows carry no policy, payment time or reject group."""
    policies = pool_approved_policy(staged, control, run_date, file_id)
    return policies.drop("IsExec").unionByName(pool_approved_other(staged), allowMissingColumns=True)


# --- header and route ------------------------------------------------------------------------

HEADER = ("trancode", "source", "bankid", "bankid_receipt")


def with_header(pool: DataFrame, control: DataFrame, file_id: int | None = None) -> DataFrame:
    """Attach trancode, source and banks of the run's file.

    With ``file_id`` all rows get the header of that file, as when one file is executed; otherwise
    each row gets the header of its own file.
    """
    header = control.where(F.col("FileName").isNotNull() & F.col("tglProses").isNotNull())
    if file_id is not None:
        row = header.where(F.col("id") == file_id).select("FileName", *HEADER).first()
        if row is None:
            raise ValueError(f"no readable control row {file_id}")
        types = dict(control.select(*HEADER).dtypes)
        return pool.withColumns(
            {"File_Backup": F.lit(row["FileName"])} | {n: F.lit(row[n]).cast(types[n]) for n in HEADER}
        )
    names = header.select("FileName", F.col("FileName").alias("File_Backup"), *HEADER)
    return pool.join(names, "FileName")


def route_approved(pool: DataFrame) -> DataFrame:
    """Where an approved row goes: recurring, other, quote, or skipped_va (one-off bills of VA files)."""
    code = F.col("BillCode")
    va = F.upper(F.trim(F.col("source"))) == "VA"
    return pool.withColumn(
        "route",
        F.when(code == "B", F.lit("recurring"))
        .when((code == "A") & ~va, F.lit("other"))
        .when((code == "A") & va, F.lit("skipped_va"))
        .when(code == "Q", F.lit("quote")),
    )


# What names a staged row. Ids repeat from file to file; in a file they tell its lines (or its worksheets and
# their rows) apart. Ties in any order of rows are broken by it.
ROW = ("FileName", "id")


def row_keys(rows: DataFrame) -> DataFrame:
    """The names of rows. A null file name is a file of its own."""
    return rows.select(F.col("id").alias("_row_id"), F.col("FileName").alias("_row_file")).distinct()


def same_row() -> Column:
    """Join condition of staged rows and ``row_keys``."""
    return F.col("id").eqNullSafe(F.col("_row_id")) & F.col("FileName").eqNullSafe(F.col("_row_file"))


def without_rows(staged: DataFrame, rows: DataFrame) -> DataFrame:
    return staged.join(row_keys(rows), same_row(), "left_anti")


def mark_executed(staged: DataFrame, posted: DataFrame) -> DataFrame:
    """Flag the staged rows whose file and id are among ``posted``."""
    done = row_keys(posted).withColumn("_done", F.lit(True))
    return (
        staged.join(done, same_row(), "left")
        .withColumn("IsExec", F.col("IsExec") | F.coalesce("_done", F.lit(False)))
        .select(*staged.columns)
    )
