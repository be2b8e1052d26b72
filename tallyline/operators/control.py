"""Control rows: which files are due, what a run does with each, counts and release."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# File ids that deviate from the full run, and the ids that come as two files.
NO_APPROVE_STEP = (2,)
NO_REJECT_STEP = (1, 7, 9)
HOLD_SOURCE = "AC"
TWO_FILE_UPLOADS = (1, 2, 7, 8, 9, 10)


def _readable() -> Column:
    return F.col("FileName").isNotNull() & F.col("tglProses").isNotNull()


def _with_download(control: DataFrame, downloads: DataFrame) -> DataFrame:
    names = downloads.select(F.col("id").alias("id_billing_download"), "file_download")
    return control.join(names, "id_billing_download", "left").select(*control.columns, "file_download")


def files_due(control: DataFrame, downloads: DataFrame, run_date: date, file_id: int | None = None) -> DataFrame:
    """Readable control rows due on the run date, with the name of their billing download."""
    due = control.where(_readable() & (F.col("tglProses") == F.lit(run_date)))
    if file_id is not None:
        due = due.where(F.col("id") == file_id)
    return _with_download(due, downloads)


def file_by_id(control: DataFrame, downloads: DataFrame, file_id: int | None = None) -> DataFrame:
    """Readable control rows whatever their date."""
    rows = control.where(_readable())
    if file_id is not None:
        rows = rows.where(F.col("id") == file_id)
    return _with_download(rows, downloads)


def files_due_source(control: DataFrame, downloads: DataFrame, run_date: date, source: str = "CC") -> DataFrame:
    return files_due(control.where(F.col("source") == source), downloads, run_date)


def run_policy(control: DataFrame, single_file: bool) -> DataFrame:
    """Which steps a run takes for each file. Holds are set only when one file is run by its id."""
    file_id = F.col("id")
    return control.select(
        "id",
        (~file_id.isin(*NO_APPROVE_STEP)).alias("do_approve"),
        (~file_id.isin(*NO_REJECT_STEP)).alias("do_reject"),
        (F.lit(single_file) & (F.col("source") == HOLD_SOURCE)).alias("do_hold"),
    )


def upload_counts(staged: DataFrame) -> DataFrame:
    """One row: mapped approvals, mapped rejections and their sum over the whole staging table."""
    mapped = F.coalesce(F.col("PolisId").cast("string"), F.col("BillingID")).isNotNull() & F.col("BillCode").isNotNull()
    return staged.agg(
        F.count_if(F.col("IsSukses") & mapped).alias("count_approve"),
        F.count_if(~F.col("IsSukses") & mapped).alias("count_reject"),
    ).withColumn("total_upload", F.col("count_approve") + F.col("count_reject"))


def file_row_count(staged: DataFrame, control: DataFrame) -> DataFrame:
    """Staged rows of each control row; 0 for a control row without any."""
    # one row per staged file after map-side aggregation
    counts = staged.groupBy("FileName").agg(F.count(F.lit(1)).alias("total_data"))
    return control.select("id", "FileName").join(counts, "FileName", "left").select(
        "id", "FileName", F.coalesce("total_data", F.lit(0)).cast("bigint").alias("total_data")
    )


def upload_summary(upload_sum: DataFrame, control: DataFrame, staged: DataFrame, file_id: int | None = None) -> DataFrame:
    """The upload summary after a (re)count, for one file or for every file with a control row."""
    counts = upload_counts(staged)
    touched = control if file_id is None else control.where(F.col("id") == file_id)
    listed = touched.select(F.col("id_upload_sum").alias("id")).where("id is not null").distinct()
    counted = upload_sum.join(listed.withColumn("_touched", F.lit(True)), "id", "left")
    names = ("count_approve", "count_reject", "total_upload")
    return counted.withColumns(
        {n: F.when(F.col("_touched"), counts.select(n).scalar()).otherwise(F.col(n)) for n in names}
    ).select(*upload_sum.columns)


def record_row_count(control: DataFrame, staged: DataFrame, file_id: int | None = None) -> DataFrame:
    """Control rows with ``total_data`` set for one file or for all of them."""
    counts = file_row_count(staged, control).select("id", F.col("total_data").alias("_total"))
    before = F.col("total_data") if "total_data" in control.columns else F.lit(None).cast("bigint")
    counted = F.lit(True) if file_id is None else F.col("id") == file_id
    return (
        control.join(counts, "id", "left")
        .withColumn("total_data", F.when(counted, F.coalesce("_total", F.lit(0))).otherwise(before))
        .drop("_total")
    )


def download_cleared(downloads: DataFrame, control: DataFrame | None = None, file_id: int | None = None) -> DataFrame:
    """Forget the download file of summaries with nothing left to collect.

    With ``control`` and ``file_id`` only the summary of that file is looked at.
    """
    rest = F.col("TotalAmountDWD") + F.col("TotalCountDWD")
    name = F.when(rest <= 0, F.lit(None)).otherwise(F.col("file_download"))
    if control is None or file_id is None:
        return downloads.withColumn("file_download", name)
    own = control.where(F.col("id") == file_id).select(F.col("id_billing_download").alias("id")).distinct()
    marked = downloads.join(own.withColumn("_own", F.lit(True)), "id", "left")
    return marked.withColumn("file_download", F.when(F.col("_own"), name).otherwise(F.col("file_download"))).select(
        *downloads.columns
    )


def release_control(control: DataFrame, file_id: int) -> DataFrame:
    """Free a control row for its next file."""
    own = F.col("id") == file_id
    return control.withColumns(
        {name: F.when(own, F.lit(None)).otherwise(F.col(name)) for name in ("FileName", "tglProses")}
    )
