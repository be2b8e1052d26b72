"""Spreadsheet result files as a cell grid ``(row_no, FileName, sheet_no, c1..c10)``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions import text as t
from tallyline.functions.skew import lookup_join


BAD_AMOUNT = "bad amount"
# A row id is worksheet | row: the first worksheet's ids are its row numbers.
SHEET_BITS = 40


def cell_id() -> Column:
    """What names a row in its file. Worksheets number their rows apart, so the row number alone does not."""
    return F.shiftleft(F.col("sheet_no").cast("bigint") - 1, SHEET_BITS) + F.col("row_no").cast("bigint")


def cell(number: int) -> Column:
    return t.strip(F.col(f"c{number}"))


@dataclass(frozen=True)
class SheetSpec:
    """One worksheet of a layout. ``filled`` cells must not be NULL, ``amount`` and ``numeric`` ones must be amounts.

    ``broken`` lists cells that are read unchecked: a NULL there is a fault of the row.
    """

    sheet_no: int
    filled: tuple[int, ...]
    amount: int
    fields: dict[str, Callable[[], Column]]
    success: Callable[[], Column]
    numeric: tuple[int, ...] = ()
    broken: tuple[int, ...] = ()

    def usable(self) -> Column:
        test = F.col("sheet_no") == self.sheet_no
        for number in self.filled:
            test = test & F.col(f"c{number}").isNotNull()
        for number in self.numeric:
            test = test & t.parse_amount(F.col(f"c{number}")).isNotNull()
        return test

    def fault(self) -> Column:
        """Why a row of this worksheet can't be used: the first rule it breaks, NULL if none."""
        reason = F.when(self.parsed_amount().isNull(), F.lit(BAD_AMOUNT))
        for number in reversed(self.numeric):
            bad = t.parse_amount(F.col(f"c{number}")).isNull()
            reason = F.when(bad, F.lit(f"cell {number} is not a number")).otherwise(reason)
        for number in sorted({*self.filled, *self.broken}, reverse=True):
            reason = F.when(F.col(f"c{number}").isNull(), F.lit(f"cell {number} is empty")).otherwise(reason)
        return reason

    def parsed_amount(self) -> Column:
        return t.parse_amount(F.col(f"c{self.amount}"))

    def columns(self) -> dict[str, Column]:
        found = {name: make() for name, make in self.fields.items()}
        found |= {"Amount": self.parsed_amount(), "IsSukses": self.success()}
        return {
            f.name: found.get(f.name, F.lit(None)).cast(f.dataType)
            for f in schemas.PARSED
            if f.name not in ("id", "FileName")
        }

    def whole(self) -> Column:
        test = F.lit(True)
        for number in self.broken:
            test = test & F.col(f"c{number}").isNotNull()
        return test


def _policy_after_dash() -> Column:
    return t.strip(F.element_at(F.split(cell(2), "-"), -1))


# Cell numbers are fixed values of the bank formats.
CARD_SHEET_A = (
    SheetSpec(
        1,
        filled=(2, 3, 4, 6, 7),
        amount=3,
        fields={
            "AccName": lambda: cell(2),
            "ApprovalCode": lambda: cell(4),
            "PolisNo": lambda: cell(6),
            "AccNo": lambda: cell(7),
        },
        success=lambda: F.lit(True),
    ),
    SheetSpec(
        2,
        filled=(2, 3, 4, 7),
        amount=3,
        broken=(6,),
        fields={
            "AccName": lambda: cell(2),
            "PolisNo": lambda: cell(4),
            "ApprovalCode": lambda: t.null_to_blank(cell(5)),
            "Deskripsi": lambda: t.clean_description(F.col("c6")),
            "AccNo": lambda: cell(7),
        },
        success=lambda: F.lit(False),
    ),
)

CARD_SHEET_B = (
    SheetSpec(
        1,
        filled=(1, 2, 3, 4, 5, 6),
        amount=3,
        fields={"PolisNo": _policy_after_dash, "ApprovalCode": lambda: cell(5)},
        success=lambda: F.lit(True),
    ),
    SheetSpec(
        2,
        filled=(1, 2, 3, 4, 5, 6),
        amount=3,
        fields={
            "PolisNo": _policy_after_dash,
            "ApprovalCode": lambda: cell(5),
            "Deskripsi": lambda: t.clean_description(F.col("c6")),
        },
        success=lambda: F.lit(False),
    ),
)

CARD_SHEET_C = (
    SheetSpec(
        1,
        filled=(1, 4, 7, 8, 9, 10),
        amount=8,
        numeric=(1,),
        broken=(5,),
        fields={
            "PolisNo": lambda: cell(7),
            "ApprovalCode": lambda: cell(9),
            "AccNo": lambda: cell(4),
            "AccName": lambda: cell(5),
            "Deskripsi": lambda: t.clean_description(F.col("c10")),
        },
        success=lambda: cell(9) != "",
    ),
)

SHEET_LAYOUTS = {"card_sheet_a": CARD_SHEET_A, "card_sheet_b": CARD_SHEET_B, "card_sheet_c": CARD_SHEET_C}


def ingest_sheet(cells: DataFrame, layout: tuple[SheetSpec, ...]) -> DataFrame:
    """Parse a cell grid in one pass: each row takes the fields of its own worksheet, once."""
    return _parse(cells, [(F.lit(True), sheet) for sheet in layout])


def ingest_sheets(cells: DataFrame) -> DataFrame:
    """Parse grids of several layouts in one pass: a row's ``layout`` and worksheet say which fields it has."""
    return _parse(cells, [(F.col("layout") == name, sheet) for name, sheets in SHEET_LAYOUTS.items() for sheet in sheets])


def _parse(cells: DataFrame, sheets: list[tuple[Column, SheetSpec]]) -> DataFrame:
    cells = schemas.with_columns_of(cells, schemas.CELLS)
    parsed = F.lit(None)
    for mine, sheet in sheets:
        fields = F.struct(*[c.alias(n) for n, c in sheet.columns().items()])
        parsed = F.when(mine & sheet.usable() & sheet.whole(), F.array(fields)).otherwise(parsed)
    rows = cells.select(cell_id().alias("id"), "FileName", F.inline(parsed))
    return schemas.conform(rows.where(F.col("Amount").isNotNull()), schemas.PARSED)


def rejected_cells(cells: DataFrame, layout: tuple[SheetSpec, ...]) -> DataFrame:
    """Rows that ``ingest_sheet`` leaves out, with their ``id`` and the reason: the worksheet, or the first rule
    they break. Title rows are left out here too: a worksheet's first row, if its amount cell holds no amount."""
    cells = schemas.with_columns_of(cells, schemas.CELLS)
    reason = F.lit("unknown worksheet")
    for sheet in layout:
        reason = F.when(F.col("sheet_no") == sheet.sheet_no, sheet.fault()).otherwise(reason)
    faulty = cells.withColumn("id", cell_id()).withColumn("reason", reason).where(F.col("reason").isNotNull())
    first = cells.groupBy("FileName", "sheet_no").agg(F.min("row_no").alias("_first"))
    marked = lookup_join(faulty, first, ["FileName", "sheet_no"])
    title = (F.col("reason") == BAD_AMOUNT) & (F.col("row_no") == F.col("_first"))
    return marked.where(~F.coalesce(title, F.lit(False))).drop("_first")
