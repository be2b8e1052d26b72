"""Text, number and date expressions used by the file layouts. All of them stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a text trim removes, and the number shapes accepted as an amount.
WHITESPACE_CODES = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
WHITESPACE = "".join(map(chr, WHITESPACE_CODES))
UNSIGNED_AMOUNT = r"([0-9][0-9,]*(\.[0-9]*)?|\.[0-9]+)"
LEADING_SIGN_AMOUNT = f"^[+-]?{UNSIGNED_AMOUNT}$"
TRAILING_SIGN_AMOUNT = f"^{UNSIGNED_AMOUNT}[+-]$"
WHOLE_NUMBER = "^[+-]?[0-9]+$"
DAY_FIRST_STAMP = "^[0-9]{2}/[0-9]{2}/[0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
SHORT_YEAR_STAMP = "^[0-9]{2}/[0-9]{2}/[0-9]{2}  [0-9]{2}:[0-9]{2}:[0-9]{2}$"

MONEY = "decimal(18,2)"


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks. Padding is taken off by the plain trim first,
    which is many times faster than trimming a set of characters."""
    return F.btrim(F.trim(c), F.lit(WHITESPACE))


def piece(c: Column, start: int, length: int) -> Column:
    """Fixed-width field at a 0-based offset, as it stands."""
    return F.substring(c, start + 1, length)


def tail(c: Column, start: int) -> Column:
    """Everything from a 0-based offset on."""
    return F.substr(c, F.lit(start + 1))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def null_to_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def first_filled(*columns: Column) -> Column:
    """First value that is neither NULL nor empty."""
    return F.coalesce(*[blank_to_null(c) for c in columns])


# The ``read_`` expressions take trimmed text; they mention it several times, so trim it beforehand
# in its own projection where many rows are parsed.

def read_int(text: Column) -> Column:
    """Integer or NULL; texts are sorted out by pattern, a cast is slow at refusing them."""
    return F.when(text.rlike(WHOLE_NUMBER), text.try_cast("int"))


def read_amount(text: Column, decimal_style: str = "dot") -> Column:
    """Amount or NULL: grouping commas and a leading or trailing sign are fine, exponents are not.

    ``decimal_style='comma'`` reads ``1.234,50`` instead of ``1,234.50``.
    """
    if decimal_style == "comma":
        text = F.translate(text, ".,", ",.")
    elif decimal_style != "dot":
        raise ValueError(f"unknown decimal style {decimal_style!r}")
    digits = F.translate(text, ",", "")
    unsigned = F.translate(text, ",+-", "")
    return (
        F.when(text.rlike(LEADING_SIGN_AMOUNT), digits)
        .when(text.rlike(TRAILING_SIGN_AMOUNT), F.concat(F.right(text, F.lit(1)), unsigned))
        .try_cast(MONEY)
    )


def _stamp(text: Column, year: Column, clock: int) -> Column:
    def number(start: int) -> Column:
        return piece(text, start, 2).cast("int")

    return F.try_make_timestamp_ntz(
        year, number(3), number(0), number(clock), number(clock + 3), number(clock + 6).cast("decimal(16,6)")
    )


def read_stamp(text: Column) -> Column:
    """``dd/MM/yyyy HH:mm:ss`` or NULL, free of any time zone."""
    return F.when(text.rlike(DAY_FIRST_STAMP), _stamp(text, piece(text, 6, 4).cast("int"), 11))


def read_short_stamp(text: Column) -> Column:
    """``dd/MM/yy  HH:mm:ss`` (two blanks) or NULL; years are 2000-2099."""
    return F.when(text.rlike(SHORT_YEAR_STAMP), _stamp(text, piece(text, 6, 2).cast("int") + F.lit(2000), 10))


def parse_int(c: Column) -> Column:
    return read_int(strip(c))


def parse_amount(c: Column, decimal_style: str = "dot") -> Column:
    return read_amount(strip(c), decimal_style)


def clean_description(c: Column) -> Column:
    """Trim, dashes to blanks, runs of blanks to one."""
    return F.regexp_replace(F.translate(strip(c), "-", " "), " {2,}", " ")


def whole_amount(c: Column) -> Column:
    """Whole currency units with grouping commas; zero prints as nothing, NULL as nothing."""
    units = F.round(c)
    return F.when(units.isNull() | (units == 0), F.lit("")).otherwise(F.format_number(units, 0))
