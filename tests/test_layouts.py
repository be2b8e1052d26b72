"""Parsers: rendered lines parse back, unusable lines vanish and are explained."""

from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyline.functions import text as t
from tallyline.sources import dispatch, fixed_width as fw, sheets
from tallyline.sources.tables import read_lines
from tests.conftest import rows


def put(length, **fields):
    """A line of blanks with texts at 0-based offsets, ``at_<offset>=text``."""
    line = [" "] * length
    for name, value in fields.items():
        start = int(name[3:])
        line[start : start + len(value)] = value
    return "".join(line)


def parse(spark, spec, *lines, **options):
    df = spark.createDataFrame([(i, "f", v) for i, v in enumerate(lines)], "id bigint, FileName string, value string")
    return fw.ingest_fixed(df, spec, **options).orderBy("id").collect(), fw.rejected_lines(df, spec).orderBy("id").collect()


def test_card_a(spark):
    good = dict(at_9="POL1", at_34="4111", at_54="   120.50", at_65="JO O'NEIL")
    ok, bad = parse(
        spark,
        fw.CARD_FIXED_A,
        put(163, **good) + "AB123 00",
        put(171, **good)[:-2] + "05",
        put(170, **good),
        put(171, at_54="N/A"),
    )
    assert [(r.PolisNo, r.AccNo, r.AccName, r.Amount, r.ApprovalCode, r.IsSukses) for r in ok] == [
        ("POL1", "4111", "JO O'NEIL", Decimal("120.50"), "AB123", True),
        ("POL1", "4111", "JO O'NEIL", Decimal("120.50"), "05", False),
    ]
    assert [r.reason for r in bad] == ["short line", "bad amount"]


def test_card_b_tail(spark):
    head = put(85, at_0="000001", at_6="0000000000700 00", at_22="4111", at_42="12")
    ok, bad = parse(
        spark, fw.CARD_FIXED_B, head + "APPROVE ", head + "REJECT 05 NO MONEY", head + "SHORT", head, "x" + head[1:]
    )
    assert [(r.PolisNo, r.ApprovalCode, r.Deskripsi, r.IsSukses) for r in ok] == [
        ("700 00", "APPROVE", "APPROVE ", True),
        ("700 00", "05", "NO MONEY", False),
        ("700 00", "", "", False),
        ("700 00", "", "", False),
    ]
    assert [r.reason for r in bad] == ["no line number"]


def test_account_b_block(spark):
    def line(block, status="SUCCESS"):
        return put(720, at_306=block, at_590="POL", at_634="7", at_674=status) + "done"

    ok, bad = parse(
        spark, fw.ACCT_FIXED_B, line("123/JO (IDR)"), line(" 123/JO (IDR)"), line("no slash"), line("9/X", "no")
    )
    assert [(r.AccNo, r.AccName, r.Deskripsi, r.IsSukses) for r in ok] == [
        ("123", "JO", "done", True),
        ("123", "/JO", "done", True),  # a leading blank moves the name
        ("9", "X", None, False),
    ]
    assert [r.reason for r in bad] == ["account block without slash"]


def test_dates(spark):
    daily = put(195, at_0="00001", at_112="5", at_136="31/12/2024 23:59:58")
    ok, bad = parse(spark, fw.VA_DAILY, daily, daily.replace("31/12", "31/02"), daily.replace("31/12/2024 ", "31-12-2024 "))
    assert [r.TranDate for r in ok] == [datetime(2024, 12, 31, 23, 59, 58)]
    assert [r.reason for r in bad] == ["bad date", "bad date"]
    ok, _ = parse(spark, fw.VA_REALTIME, put(133, at_1="00001", at_52="5", at_73="31/12/35  01:02:03"))
    assert ok[0].TranDate == datetime(2035, 12, 31, 1, 2, 3)


def test_va_auto_decides_per_file(spark):
    daily = put(195, at_0="00001", at_112="5", at_136="31/12/2024 23:59:58")
    real = put(133, at_1="00001", at_52="5", at_73="31/12/24  01:02:03")
    both = real.ljust(195)
    df = spark.createDataFrame(
        [(1, "a", daily), (2, "a", both), (3, "b", both), (4, "c", "junk")], "id bigint, FileName string, value string"
    )
    assert rows(fw.ingest_va_auto(df).select("id", "FileName")) == [(1, "a"), (3, "b")]


@pytest.mark.parametrize(
    "written,value",
    [
        ("1,234.50", "1234.50"),
        (" 5- ", "-5.00"),
        ("5+", "5.00"),
        ("-5", "-5.00"),
        (".5", "0.50"),
        ("1e3", None),
        ("", None),
        ("1.2.3", None),
        ("--5", None),
        ("N/A", None),
    ],
)
def test_amounts(spark, written, value):
    df = spark.createDataFrame([(written,)], "c string")
    found = df.select(t.parse_amount(F.col("c"))).first()[0]
    assert found == (Decimal(value) if value else None)


def test_decimal_comma(spark):
    df = spark.createDataFrame([("1.234,50",)], "c string")
    assert df.select(t.parse_amount(F.col("c"), "comma")).first()[0] == Decimal("1234.50")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.decimals(min_value=0, max_value=10**12, places=2), min_size=20, max_size=20))
def test_amounts_come_back(spark, amounts):
    df = spark.createDataFrame([(i, f"{a:,}") for i, a in enumerate(amounts)], "i int, c string")
    assert [r[1] for r in df.select("i", t.parse_amount(F.col("c"))).orderBy("i").collect()] == amounts


def test_text_helpers(spark):
    df = spark.createDataFrame([("\t a - b   c  ", Decimal("0.40"), Decimal("1234567.50"))], "c string, z decimal(18,2), m decimal(18,2)")
    row = df.select(
        t.clean_description(F.col("c")), t.whole_amount(F.col("z")), t.whole_amount(F.col("m")), t.parse_int(F.lit(" 7 ")),
        t.parse_int(F.lit("7.0")), t.parse_int(F.lit("99999999999")),
    ).first()
    assert tuple(row) == ("a b c", "", "1,234,568", 7, None, None)


def test_sheets(spark):
    cells = spark.createDataFrame(
        [
            (1, "f", 1, "1", "JO", "5", "OK1", None, "POL", "41", None, None, None),
            (2, "f", 2, "1", "JO", "5", "POL", None, " a-b  c ", "41", None, None, None),
            (3, "f", 2, "1", "JO", "5", "POL", "05", None, "41", None, None, None),
            (4, "f", 1, "1", None, "5", "OK1", None, "POL", "41", None, None, None),
            (5, "f", 3, "1", "JO", "5", "OK1", None, "POL", "41", None, None, None),
        ],
        "row_no bigint, FileName string, sheet_no int, " + ", ".join(f"c{i} string" for i in range(1, 11)),
    )
    found = sheets.ingest_sheet(cells, sheets.CARD_SHEET_A).orderBy("id").collect()
    second = 1 << 40  # worksheets number their rows apart
    assert [(r.id, r.PolisNo, r.ApprovalCode, r.Deskripsi, r.IsSukses) for r in found] == [
        (1, "POL", "OK1", None, True),
        (second + 2, "POL", "", "a b c", False),
    ]
    left = sheets.rejected_cells(cells, sheets.CARD_SHEET_A).select("id", "reason")
    assert rows(left) == sorted(
        [(4, "cell 2 is empty"), (2 * second + 5, "unknown worksheet"), (second + 3, "cell 6 is empty")], key=str
    )


@pytest.mark.parametrize("layout", sheets.SHEET_LAYOUTS)
def test_a_sheet_loses_only_its_title_rows(spark, sf, layout):
    """Staged and rejected rows together are all rows but the titles, each under its own id."""
    from checks.fixtures import view

    cells = view(spark, sf, f"fx_cells_{layout}")
    staged = sheets.ingest_sheet(cells, sheets.SHEET_LAYOUTS[layout]).select("FileName", "id")
    left = sheets.rejected_cells(cells, sheets.SHEET_LAYOUTS[layout])
    assert left.where("reason is null").isEmpty() and not left.isEmpty()
    every = staged.unionByName(left.select("FileName", "id"))
    titles = cells.groupBy("FileName", "sheet_no").agg(F.min("row_no").alias("row_no")).join(
        cells, ["FileName", "sheet_no", "row_no"], "left_semi"
    )
    missing = cells.withColumn("id", sheets.cell_id()).join(every, ["FileName", "id"], "left_anti")
    assert missing.select("FileName", "sheet_no", "row_no").subtract(titles.select("FileName", "sheet_no", "row_no")).isEmpty()
    assert every.distinct().count() == every.count() == cells.count() - missing.count()


def test_one_file_parses_as_in_the_mixed_pass(spark, sf):
    from checks.fixtures import view

    control, lines, cells = (view(spark, sf, n) for n in ("fx_control", "fx_lines_all", "fx_cells_all"))
    mixed = dispatch.ingest_dispatch(lines, cells, control)
    for file_id, source in ((1, lines), (12, lines), (13, lines), (3, cells)):
        name = f"bank_{file_id}.txt"
        alone = dispatch.parse_file(source.where(F.col("FileName") == name), file_id)
        assert rows(alone) == rows(mixed.where(F.col("FileName") == name)) != []


def test_read_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\r\ntwo\n\nfour\n")
    whole = read_lines(spark, str(tmp_path), file_no=3, whole_files=True)
    assert [(r.id - (3 << 55), r.FileName, r.value) for r in whole.orderBy("id").collect()] == [
        (1, "a.txt", "one"), (2, "a.txt", "two"), (3, "a.txt", ""), (4, "a.txt", "four"),
    ]
    split = read_lines(spark, str(tmp_path), file_no=3)
    assert [r.value for r in split.orderBy("id").collect()] == ["one", "two", "", "four"]


def test_split_lines_keep_unique_ordered_ids(spark, tmp_path):
    big = tmp_path / "big.txt"
    big.write_text("".join(f"{i:0199d}\n" for i in range(60000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2MB")
    try:
        lines = read_lines(spark, str(big), file_no=1)
        assert lines.rdd.getNumPartitions() > 1
        values = [int(r.value) for r in lines.orderBy("id").select("value").collect()]
        assert values == list(range(60000))
        assert lines.select("id").distinct().count() == 60000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_file_numbers_and_byte_order_mark(spark, tmp_path):
    (tmp_path / "marked.txt").write_bytes(b"\xef\xbb\xbffirst\nsecond\n")
    for whole in (True, False):
        lines = read_lines(spark, str(tmp_path), file_no=255, whole_files=whole)
        assert [r.value for r in lines.orderBy("id").collect()] == ["first", "second"]
    for number in (-1, 256, 512):
        with pytest.raises(ValueError, match="file number"):
            read_lines(spark, str(tmp_path), file_no=number)


def test_line_numbers_do_not_depend_on_the_splits(spark, tmp_path):
    """The same ids whether a file is one split or many, and whether a task reads one file or several."""
    for name, count in (("a.txt", 30_000), ("b.txt", 7), ("c.txt", 0)):
        (tmp_path / name).write_text("".join(f"line {i} of {name}\n" for i in range(1, count + 1)))
    conf = "spark.sql.files.maxPartitionBytes"
    before, found = spark.conf.get(conf), []
    try:
        for size in ("134217728", "20000", "3333"):
            spark.conf.set(conf, size)
            found.append(rows(read_lines(spark, str(tmp_path), file_no=3)))
    finally:
        spark.conf.set(conf, before)
    first = 3 << 55
    assert found[0] == found[1] == found[2]
    assert len(found[0]) == 30_007
    assert all(value == f"line {i - first} of {name}" for i, name, value in found[0])


def test_a_heavy_virtual_account_file_is_split(spark, sf):
    """One file holds nearly all lines: the choice of its layout is a join that AQE can split."""
    from checks.fixtures import view

    line = view(spark, sf, "fx_lines_va_realtime").where("length(value) >= 133").limit(1).first().value
    lines = spark.range(0, 60_000, 1, 8).select(
        "id", F.when(F.col("id") % 50 == 0, F.concat(F.lit("f"), F.col("id"))).otherwise(F.lit("big")).alias("FileName"),
        F.concat(F.lit(line), F.sha2(F.col("id").cast("string"), 512)).alias("value"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        tried = spark.createDataFrame([], "FileName string, _try string").unionByName(
            lines.select("FileName", F.when(F.col("FileName") == "big", F.lit("va_realtime")).otherwise(F.lit("va_daily")).alias("_try"))
        )
        chosen = fw.chosen_tries(tried.withColumn("id", F.monotonically_increasing_id()))
        assert len(chosen.select("id").collect()) == 60_000
        kept = chosen.select("id", "FileName", "_try")
        kept.collect()
        assert "skew=true" in kept._jdf.queryExecution().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert fw.ingest_va_auto(lines).count() == 60_000
