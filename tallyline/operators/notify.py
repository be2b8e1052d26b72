"""Thank-you mails as rows of the mail queue. Nothing is sent here."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.skew import lookup_join
from tallyline.functions.text import null_to_blank, whole_amount
from tallyline.operators.staging import ROW

# Fixed values of the queue and the mails' fields.
QUEUE_STATUS, QUEUE_TYPE = "P", "UploadCCResult"
MALE, FEMALE = "Bapak", "Ibu"
MALE_SEX, FEMALE_SEX = "Pria", "Wanita"
OTHER_TYPES = {"A2": "Endorsemen Cetak Polis Fisik", "A3": "Cetak Kartu"}
PREMIUM_MODES = {"": "Sekaligus", "0": "Sekaligus", "1": "Bulanan", "3": "Triwulanan", "6": "Semesteran", "12": "Tahunan"}
QUOTE_LINES = (
    ("No Quote", "{ref}"),
    ("Nama", "{name}"),
    ("Jenis Kelamin", "{sex}"),
    ("Tempat/Tanggal Lahir", "{birthplace}/{birthdate}"),
    ("Email", "{email}"),
    ("Mobile", "{mobile}"),
    ("Nama Product", "{product}"),
    ("Uang Pertanggungan", "IDR {insured}"),
    ("Durasi (tahun)", "{years} tahun"),
    ("Durasi (hari)", "{days} hari"),
    ("Total Premi", "IDR {premium}"),
    ("Biaya Cetak Polis", "IDR {fee}"),
    ("Frekuensi Bayar", "{mode}"),
    ("Metode Pembayaran", "{method}"),
    ("Jumlah Pembayaran", "IDR {amount}"),
    ("Status", "TERDAFTAR"),
)


def _listed(lines: tuple[tuple[str, str], ...]) -> str:
    return "<table>" + "".join(f"<tr><td>{label}</td><td>: {value}</td></tr>" for label, value in lines) + "</table>"


# The mails' wording belongs to whoever sends them; without templates a mail lists its fields.
POLICY_LINES = (("Nama", "{title} {name}"), ("Nama Product", "{product}"), ("No Polis", "{policy}"), ("Jumlah Pembayaran", "IDR {amount}"))
RECURRING = ("{brand} {policy}", _listed(POLICY_LINES))
OTHER = ("{brand} {policy} {type}", _listed((*POLICY_LINES, ("Pembayaran", "{type}"))))
QUOTE = ("{brand} {ref}", _listed(QUOTE_LINES))


@dataclass(frozen=True)
class MailTexts:
    """Brand, blind copy and templates; every ``{field}`` is filled from the row."""

    brand: str = "Billing"
    bcc: str | None = None
    recurring: tuple[str, str] = RECURRING
    other: tuple[str, str] = OTHER
    quote: tuple[str, str] = QUOTE


def _fill(template: str, values: dict[str, Column]) -> Column:
    """The template as one concatenation of literals and columns."""
    parts: list[Column] = []
    rest = template
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        parts += [F.lit(before), null_to_blank(values[name].cast("string"))]
    return F.concat(*parts, F.lit(rest))


def _with_common(values: dict[str, Column], texts: MailTexts) -> dict[str, Column]:
    return values | {"brand": F.lit(texts.brand), "amount": whole_amount(F.col("Amount"))}


def _queue(rows: DataFrame, texts: MailTexts, templates: tuple[str, str], found: Column, to: str, values) -> DataFrame:
    subject, body = (_fill(template, _with_common(values, texts)) for template in templates)
    return _queued(rows, texts, subject, body, found, to)


def _queued(rows: DataFrame, texts: MailTexts, subject: Column, body: Column, found: Column, to: str) -> DataFrame:
    """Queue rows; without an addressee the row is still queued, with empty fields."""
    return rows.select(
        *ROW,
        F.when(found, null_to_blank(F.col(to))).alias("email_to"),
        F.when(found, subject).alias("email_subject"),
        F.when(found, body).alias("email_body"),
        F.col("run_ts").alias("email_created_dt"),
        F.lit(QUEUE_STATUS).alias("email_status"),
        F.lit(texts.bcc).cast("string").alias("email_bcc"),
        F.lit(QUEUE_TYPE).alias("email_type"),
    )


def _title(male: str) -> Column:
    return F.when(F.col(male), F.lit(MALE)).otherwise(F.lit(FEMALE))


def _with_holder(
    rows: DataFrame, policy_billing: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """Attach policy number, holder and product by the policy id in ``_policy``."""
    policies = policy_billing.select(
        F.col("policy_id").alias("_policy"), "policy_no", F.col("holder_id").alias("_holder"), F.col("product_id").alias("_product")
    )
    people = customers.select(F.col("CustomerId").alias("_holder"), "CustomerName", "IsLaki", "Email", F.lit(True).alias("_person"))
    goods = products.select(F.col("product_id").alias("_product"), "product_description", F.lit(True).alias("_goods"))
    rows = lookup_join(rows, policies, ["_policy"])
    rows = lookup_join(rows, people, ["_holder"])
    return lookup_join(rows, goods, ["_product"])


def _found() -> Column:
    """Whether the lookups found their rows; a NULL name in a row that was found is written as blank."""
    return F.col("_person").isNotNull() & F.col("_goods").isNotNull()


def _of_recurring(posted: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string").alias("BillingType")
    return posted.select(*ROW, "Amount", "run_ts", none, F.col("PolisId").alias("_policy"))


def _of_other(posted_other: DataFrame) -> DataFrame:
    return posted_other.select(*ROW, "Amount", "run_ts", "BillingType", F.col("bill_policy_id").alias("_policy"))


def _policy_values() -> dict[str, Column]:
    kind = F.lit(None).cast("string")
    for bill_type, text in OTHER_TYPES.items():
        kind = F.when(F.col("BillingType") == bill_type, F.lit(text)).otherwise(kind)
    return {
        "title": _title("IsLaki"),
        "name": F.upper("CustomerName"),
        "product": F.col("product_description"),
        "policy": F.col("policy_no"),
        "type": kind,
    }


def email_recurring(
    posted: DataFrame,
    policy_billing: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    texts: MailTexts = MailTexts(),
) -> DataFrame:
    """A mail per posted policy payment."""
    rows = _with_holder(_of_recurring(posted), policy_billing, customers, products)
    return _queue(rows, texts, texts.recurring, _found(), "Email", _policy_values())


def email_other(
    posted_other: DataFrame,
    policy_billing: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    texts: MailTexts = MailTexts(),
) -> DataFrame:
    """A mail per posted one-off bill."""
    rows = _with_holder(_of_other(posted_other), policy_billing, customers, products)
    return _queue(rows, texts, texts.other, _found(), "Email", _policy_values())


def email_policies(
    posted: DataFrame,
    posted_other: DataFrame,
    policy_billing: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    texts: MailTexts = MailTexts(),
) -> DataFrame:
    """The mails of policy payments and of one-off bills; holder and product are looked up once for both."""
    rows = _of_recurring(posted).withColumn("_other", F.lit(False)).unionByName(
        _of_other(posted_other).withColumn("_other", F.lit(True))
    )
    rows = _with_holder(rows, policy_billing, customers, products)
    values = _with_common(_policy_values(), texts)
    subject, body = (
        F.when(F.col("_other"), _fill(of_other, values)).otherwise(_fill(plain, values))
        for plain, of_other in zip(texts.recurring, texts.other)
    )
    return _queued(rows, texts, subject, body, _found(), "Email")


def email_quote(
    posted_quote: DataFrame,
    quote_billing: DataFrame,
    quotes: DataFrame,
    products: DataFrame,
    texts: MailTexts = MailTexts(),
) -> DataFrame:
    """A mail per posted quote. A quote is posted once, so its two lookups are one to one."""
    bills = quote_billing.select(
        "quote_id", "Holder_Name", "ref_no", "cashless_fee", "prospect_amount", F.col("product_id").alias("_product"),
        F.lit(True).alias("_bill"),
    )
    rows = posted_quote.select(*ROW, "quote_id", "Amount", "run_ts")
    rows = rows.join(bills, "quote_id", "left").join(quotes.withColumn("_quote", F.lit(True)), "quote_id", "left")
    goods = products.select(F.col("product_id").alias("_product"), "product_description", F.lit(True).alias("_goods"))
    rows = lookup_join(rows, goods, ["_product"])
    mode = F.lit("-")
    for value, label in PREMIUM_MODES.items():
        mode = F.when(null_to_blank(F.col("premium_mode")) == value, F.lit(label)).otherwise(mode)
    values = {
        "title": _title("IsLaki"),
        "name": F.upper("Holder_Name"),
        "ref": F.col("ref_no"),
        "sex": F.when(F.col("IsLaki"), F.lit(MALE_SEX)).otherwise(F.lit(FEMALE_SEX)),
        "birthplace": F.col("POB"),
        "birthdate": F.date_format("DOB", "dd MMM yyyy"),
        "email": F.col("email"),
        "mobile": F.col("mobile_phone"),
        "product": F.col("product_description"),
        "insured": whole_amount(F.col("sum_insured")),
        "years": F.col("duration"),
        "days": F.col("duration_days"),
        "premium": whole_amount(F.col("prospect_amount")),
        "fee": whole_amount(F.col("cashless_fee")),
        "mode": mode,
        "method": F.col("payment_method"),
    }
    found = F.col("_bill").isNotNull() & F.col("_quote").isNotNull() & F.col("_goods").isNotNull()
    return _queue(rows, texts, texts.quote, found, "email", values)
