"""Explicit schemas. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "money": T.DecimalType(18, 2),
}


def _schema(columns: str) -> T.StructType:
    """Schema from ``name type, ...``; needs no session, so the module can be imported before one."""
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in map(str.split, columns.split(","))])


# What a layout produces for one good line or sheet row.
PARSED = _schema(
    "id bigint, PolisNo string, Amount money, TranDate timestamp_ntz, ApprovalCode string,"
    " Deskripsi string, AccNo string, AccName string, IsSukses boolean, FileName string"
)

# The staging table: parsed fields plus what mapping and posting fill in.
STAGING = T.StructType(
    PARSED.fields
    + _schema(
        "PolisId bigint, BillingID string, BillCode string, RejectGroupID int, IsExec boolean"
    ).fields
)

# As stored: which of the banks' staging tables a row belongs to.
STORED_STAGING = T.StructType([*STAGING.fields, T.StructField("stageTable", T.StringType())])
LINES = _schema("id bigint, FileName string, value string")
CELLS = _schema(
    "row_no bigint, FileName string, sheet_no int, " + ", ".join(f"c{i} string" for i in range(1, 11))
)

CONTROL = _schema(
    "id int, trancode string, FileName string, stageTable string, tglProses date, source string,"
    " bankid_receipt int, bankid int, id_billing_download int, id_upload_sum int, total_data bigint"
)

# Payment columns an open bill does not have yet.
BILL_PAYMENT = _schema(
    "IsDownload boolean, IsClosed boolean, PaymentSource string, BankIdPaid int, PaidAmount money,"
    " CoreTranID string, ReceiptID string, ReceiptOtherID string, policy_note_receipt string,"
    " policy_note_receiptOther string, PaymentTransactionID string, LastUploadDate timestamp_ntz, UserUpload string"
)
OTHER_PAYMENT = _schema(
    "IsDownload boolean, IsClosed boolean, PaymentSource string, Source_download string, paid_date date,"
    " BankIdPaid int, PaidAmount money, ReceiptOtherID string, policy_note_receiptOther string,"
    " PaymentTransactionID string, LastUploadDate timestamp_ntz, UserUpload string"
)
QUOTE_PAYMENT = _schema(
    "IsDownload boolean, IsClosed boolean, PaymentSource string, Source_download string, paid_dt date,"
    " BankIdPaid int, PaidAmount money, PaymentTransactionID string, LastUploadDate timestamp_ntz,"
    " UserUpload string"
)

LEDGER = _schema(
    "tran_id string, File_Backup string, TranCode string, TranDate timestamp_ntz, IsSuccess boolean,"
    " PolicyId bigint, BillCode string, BillingID string, BillAmount money, ApprovalCode string,"
    " Description string, GroupRejectMappingID int, accNo string, accName string, DateInsert timestamp_ntz"
)


def with_columns_of(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns of ``schema`` that ``df`` lacks, as NULL."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def as_staging(df: DataFrame) -> DataFrame:
    """Bring parsed or partly mapped rows to the staging schema; a missing IsExec means not posted."""
    if "IsExec" not in df.columns:
        df = df.withColumn("IsExec", F.lit(False))
    df = with_columns_of(df, STAGING)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STAGING])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns and types of ``schema``; absent ones become NULL."""
    df = with_columns_of(df, schema)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
