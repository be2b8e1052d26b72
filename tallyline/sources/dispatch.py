"""Which layout a file has, and one pass over many files of different layouts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.session import materialize
from tallyline.sources.fixed_width import (
    FIXED_LAYOUTS,
    VA_DAILY,
    VA_REALTIME,
    chosen_tries,
    ingest_fixed,
    ingest_va_auto,
    rejected_lines,
    va_tries,
    with_cuts,
)
from tallyline.sources.sheets import SHEET_LAYOUTS, ingest_sheet, ingest_sheets, rejected_cells

# Control-row id -> layout.
LAYOUT_OF_FILE = {
    1: "card_fixed_a",
    2: "card_fixed_a",
    3: "card_sheet_a",
    4: "card_sheet_b",
    5: "card_sheet_b",
    6: "card_sheet_c",
    7: "card_fixed_b",
    8: "card_fixed_b",
    9: "card_fixed_b",
    10: "card_fixed_b",
    11: "acct_fixed_a",
    12: "acct_fixed_b",
    13: "va_auto",
}


def layout_of(file_id: Column) -> Column:
    """Layout name of a control-row id, NULL for ids without a layout."""
    return reduce(
        lambda rest, item: F.when(file_id == item[0], F.lit(item[1])).otherwise(rest),
        LAYOUT_OF_FILE.items(),
        F.lit(None).cast("string"),
    )


def with_layout(rows: DataFrame, control: DataFrame) -> DataFrame:
    """Tag lines or cells with the layout of their file; files without a control row are left out."""
    # one short row per known file id, at most len(LAYOUT_OF_FILE) of them
    known = control.where(F.col("id").isin(*LAYOUT_OF_FILE) & F.col("FileName").isNotNull())
    return rows.join(F.broadcast(known.select("FileName", layout_of(F.col("id")).alias("layout"))), "FileName")


def parse_file(rows: DataFrame, file_id: int) -> DataFrame:
    """Parse the lines (or the cells) of one file by its control-row id."""
    layout = LAYOUT_OF_FILE[file_id]
    if layout == "va_auto":
        return ingest_va_auto(rows)
    if layout in SHEET_LAYOUTS:
        return ingest_sheet(rows, SHEET_LAYOUTS[layout])
    return ingest_fixed(rows, FIXED_LAYOUTS[layout])


def rejected_file(rows: DataFrame, file_id: int) -> DataFrame:
    """What ``parse_file`` leaves out of a file: ``id, FileName, value, reason``.

    Lines of virtual-account files fit neither of their two layouts; the reason is the daily one's. A
    row of cells is shown as its cells, one after another."""
    layout = LAYOUT_OF_FILE[file_id]
    if layout in SHEET_LAYOUTS:
        found = rejected_cells(rows, SHEET_LAYOUTS[layout])
        shown = F.concat_ws("|", *[F.coalesce(f"c{i}", F.lit("")) for i in range(1, 11)])
        return found.select("id", "FileName", shown.alias("value"), "reason")
    if layout != "va_auto":
        return rejected_lines(rows, FIXED_LAYOUTS[layout])
    parsed = ingest_va_auto(rows).select(F.col("id").alias("_id"), F.col("FileName").alias("_file"))
    left = rows.join(parsed, (F.col("id") == F.col("_id")) & (F.col("FileName") == F.col("_file")), "left_anti")
    return rejected_lines(left, VA_DAILY)


VA_LAYOUT = "va_auto"
VA_SPECS = (VA_DAILY, VA_REALTIME)


def _parse_lines(lines: DataFrame) -> DataFrame:
    """Lines of all layouts in one scan: one generator gives each line what its layout makes of it, and a
    virtual-account line what either of its two does. The rows are stored, for the choice between these two."""
    plain = [FIXED_LAYOUTS[name] for name in dict.fromkeys(LAYOUT_OF_FILE.values()) if name in FIXED_LAYOUTS]
    tries = F.when(F.col("layout") == VA_LAYOUT, F.array_compact(F.array(*va_tries())))
    for spec in plain:
        record = F.struct(F.lit(spec.name).alias("_try"), spec.record().alias("_record"))
        tries = F.when((F.col("layout") == spec.name) & spec.usable(), F.array(record)).otherwise(tries)
    cut = with_cuts(lines, *plain, *VA_SPECS, layouts={spec.name: VA_LAYOUT for spec in VA_SPECS})
    rows = cut.select("id", "FileName", F.inline(tries)).select("id", "FileName", "_try", "_record.*")
    of_va = F.col("_try").isin(*(spec.name for spec in VA_SPECS))
    dated = VA_DAILY.parsed()  # the other layouts have no date
    tried = materialize(rows.where(F.col("Amount").isNotNull() & (~of_va | dated)))
    return schemas.conform(tried.where(~of_va).unionByName(chosen_tries(tried.where(of_va)), allowMissingColumns=True), schemas.PARSED)


def ingest_dispatch(lines: DataFrame, cells: DataFrame, control: DataFrame) -> DataFrame:
    """Parse the lines and cells of all files, each by the layout of its control row: one scan of each."""
    return _parse_lines(with_layout(lines, control)).unionByName(ingest_sheets(with_layout(cells, control)))
