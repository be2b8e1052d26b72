"""Fixed-width result files: one declarative layout per bank format, one generic parser.

A line is cut into pieces first, each piece once, and the fields are made from the pieces in the next
projection. Finding an offset walks the line from its start, so cutting is what parsing costs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions import text as t
from tallyline.functions.skew import lookup_join
from tallyline.session import materialize

Cut = Callable[[str], Column]  # name of a piece -> its column
FromCuts = Callable[[Cut], Column]


@dataclass(frozen=True)
class LayoutSpec:
    """A line format. Offsets are 0-based ``(start, length)``.

    ``fields`` become trimmed fields of the same name. ``raw`` pieces are cut untrimmed for the
    ``derived`` fields: a negative start counts from the end, length None means to the end.
    ``number`` must be an integer and ``amount`` an amount, or the line is dropped; so is a line
    whose ``stamp`` does not parse. ``broken`` names further faults as ``reason -> condition``.
    """

    name: str
    min_length: int
    amount: tuple[int, int]
    fields: dict[str, tuple[int, int]]
    success: FromCuts
    number: tuple[int, int] | None = None
    stamp: tuple[tuple[int, int], Callable[[Column], Column]] | None = None
    raw: dict[str, tuple[int, int | None]] = field(default_factory=dict)
    derived: dict[str, FromCuts] = field(default_factory=dict)
    broken: dict[str, FromCuts] = field(default_factory=dict)

    def cut(self, name: str) -> Column:
        return F.col(f"_{self.name}_{name}")

    def cuts(self, line: Column) -> dict[str, Column]:
        """Every piece of a line, under the column name ``cut`` reads."""
        pieces = {name: t.strip(t.piece(line, *at)) for name, at in self.fields.items()}
        pieces["amount"] = t.strip(t.piece(line, *self.amount))
        if self.number:
            pieces["number"] = t.strip(t.piece(line, *self.number))
        if self.stamp:
            pieces["stamp"] = t.strip(t.piece(line, *self.stamp[0]))
        for name, (start, length) in self.raw.items():
            if start < 0:
                pieces[name] = F.right(line, F.lit(-start))
            else:
                pieces[name] = t.tail(line, start) if length is None else t.piece(line, start, length)
        return {f"_{self.name}_{name}": piece for name, piece in pieces.items()}

    def record(self, decimal_style: str = "dot") -> Column:
        """The fields as one struct, made from the cuts."""
        found = {name: self.cut(name) for name in self.fields}
        found |= {name: make(self.cut) for name, make in self.derived.items()}
        found["Amount"] = t.read_amount(self.cut("amount"), decimal_style)
        if self.stamp:
            found["TranDate"] = self.stamp[1](self.cut("stamp"))
        found["IsSukses"] = self.success(self.cut)
        return F.struct(
            *[
                found.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schemas.PARSED
                if f.name not in ("id", "FileName")
            ]
        )

    def usable(self) -> Column:
        """Long enough, numbered and unbroken; amount and date are judged after parsing them once."""
        test = F.col("_length") >= self.min_length
        if self.number:
            test = test & t.read_int(self.cut("number")).isNotNull()
        for faulty in self.broken.values():
            test = test & ~faulty(self.cut)
        return test

    def parsed(self) -> Column:
        """Amount, and date where the layout has one, came out."""
        return F.col("Amount").isNotNull() & (F.col("TranDate").isNotNull() if self.stamp else F.lit(True))

    def fault(self, decimal_style: str = "dot") -> Column:
        """Why a line cannot be used, NULL for a good one."""
        faults: list[tuple[Column, str]] = [(F.col("_length") < self.min_length, "short line")]
        if self.number:
            faults.append((t.read_int(self.cut("number")).isNull(), "no line number"))
        faults.append((t.read_amount(self.cut("amount"), decimal_style).isNull(), "bad amount"))
        if self.stamp:
            faults.append((self.stamp[1](self.cut("stamp")).isNull(), "bad date"))
        faults += [(test(self.cut), reason) for reason, test in self.broken.items()]
        found = F.lit(None).cast("string")
        for test, reason in reversed(faults):
            found = F.when(test, F.lit(reason)).otherwise(found)
        return found


# --- the layouts -----------------------------------------------------------------------------
# Offsets, lengths and status words are fixed values of the bank formats.

CARD_FIXED_A = LayoutSpec(
    "card_fixed_a",
    min_length=171,
    amount=(54, 9),
    fields={"PolisNo": (9, 25), "AccNo": (34, 16), "AccName": (65, 26)},
    raw={"last8": (-8, 8), "last2": (-2, 2)},
    derived={
        "ApprovalCode": lambda cut: F.when(cut("last2") == "00", t.strip(t.piece(cut("last8"), 0, 6))).otherwise(
            cut("last2")
        )
    },
    success=lambda cut: cut("last2") == "00",
)


def _b_approved(cut: Cut) -> Column:
    return t.strip(cut("note")) == "APPROVE"


def _b_code(cut: Cut) -> Column:
    refused = F.when(F.length(cut("note")) >= 9, t.piece(cut("note"), 7, 2)).otherwise(F.lit(""))
    return F.when(_b_approved(cut), F.lit("APPROVE")).otherwise(refused)


CARD_FIXED_B = LayoutSpec(
    "card_fixed_b",
    min_length=85,
    number=(0, 6),
    amount=(42, 8),
    fields={"AccNo": (22, 16)},
    raw={"policy": (6, 16), "note": (85, None)},
    derived={
        # zeros on the left go, blanks stay
        "PolisNo": lambda cut: F.ltrim(cut("policy"), F.lit("0")),
        "ApprovalCode": _b_code,
        "Deskripsi": lambda cut: F.when(_b_approved(cut), cut("note")).otherwise(t.tail(cut("note"), 10)),
    },
    success=_b_approved,
)

ACCT_FIXED_A = LayoutSpec(
    "acct_fixed_a",
    min_length=205,
    amount=(74, 18),
    fields={
        "PolisNo": (92, 15),
        "AccNo": (37, 11),
        "AccName": (48, 26),
        "ApprovalCode": (129, 9),
        "Deskripsi": (138, 51),
    },
    success=lambda cut: F.lower(cut("ApprovalCode")) == "berhasil",
)


def _before_slash(cut: Cut) -> Column:
    return F.substring_index(t.strip(cut("block")), "/", 1)


def _after_slash(cut: Cut) -> Column:
    # measured from the untrimmed block, so a leading blank moves the name along
    name = F.substr(cut("block"), F.length(_before_slash(cut)) + 2)
    return t.strip(F.replace(name, F.lit("(IDR)"), F.lit("")))


def _settled(cut: Cut) -> Column:
    return F.lower(cut("ApprovalCode")) == "success"


ACCT_FIXED_B = LayoutSpec(
    "acct_fixed_b",
    min_length=720,
    amount=(634, 40),
    fields={"PolisNo": (590, 40), "ApprovalCode": (674, 46)},
    raw={"block": (306, 244), "rest": (720, None)},
    derived={
        "AccNo": lambda cut: t.strip(_before_slash(cut)),
        "AccName": _after_slash,
        "Deskripsi": lambda cut: F.when(_settled(cut), t.strip(cut("rest"))),
    },
    broken={"account block without slash": lambda cut: ~F.contains(cut("block"), F.lit("/"))},
    success=_settled,
)

VA_DAILY = LayoutSpec(
    "va_daily",
    min_length=195,
    number=(0, 5),
    amount=(112, 22),
    stamp=((136, 19), t.read_stamp),
    fields={"PolisNo": (11, 19), "AccName": (45, 31), "Deskripsi": (158, 37)},
    success=lambda cut: F.lit(True),
)

VA_REALTIME = LayoutSpec(
    "va_realtime",
    min_length=133,
    number=(1, 5),
    amount=(52, 19),
    stamp=((73, 18), t.read_short_stamp),
    fields={"PolisNo": (8, 20), "AccName": (28, 18), "Deskripsi": (100, 33)},
    success=lambda cut: F.lit(True),
)

FIXED_LAYOUTS = {
    spec.name: spec
    for spec in (CARD_FIXED_A, CARD_FIXED_B, ACCT_FIXED_A, ACCT_FIXED_B, VA_DAILY, VA_REALTIME)
}


# --- operators -------------------------------------------------------------------------------

def with_cuts(lines: DataFrame, *specs: LayoutSpec, layouts: dict[str, str] | None = None) -> DataFrame:
    """Lines with the pieces of each layout. With several, a line is cut only by those of its ``layout``;
    ``layouts`` names the layout of specs that share one."""
    line = F.col("value")
    pieces = {"_length": F.length(line)}
    for spec in specs:
        mine = F.col("layout") == (layouts or {}).get(spec.name, spec.name)
        pieces |= {n: c if len(specs) == 1 else F.when(mine, c) for n, c in spec.cuts(line).items()}
    return lines.withColumns(pieces)


def ingest_fixed(lines: DataFrame, spec: LayoutSpec, decimal_style: str = "dot") -> DataFrame:
    """Parse ``(id, FileName, value)`` lines; unusable lines are left out (see ``rejected_lines``).

    A line is a generator of no row or one row, so that each field is computed once: a filter on the
    parsed fields stays above the generator and is not repeated below it.
    """
    one = F.when(spec.usable(), F.array(spec.record(decimal_style)))
    rows = with_cuts(lines, spec).select("id", "FileName", F.inline(one))
    return schemas.conform(rows.where(spec.parsed()), schemas.PARSED)


def rejected_lines(lines: DataFrame, spec: LayoutSpec, decimal_style: str = "dot") -> DataFrame:
    """The lines ``ingest_fixed`` leaves out, each with its reason."""
    reason = F.explode(F.array(spec.fault(decimal_style))).alias("reason")
    return with_cuts(lines, spec).select("id", "FileName", "value", reason).where(F.col("reason").isNotNull())


def va_tries() -> list[Column]:
    """What a virtual-account line is by each of its two layouts: ``struct(_try, _record)``, NULL if it can't be."""
    return [
        F.when(spec.usable(), F.struct(F.lit(spec.name).alias("_try"), spec.record().alias("_record")))
        for spec in (VA_DAILY, VA_REALTIME)
    ]


def chosen_tries(tried: DataFrame) -> DataFrame:
    """Rows of stored tries that count: the daily ones, and the realtime ones of files without any daily line.

    The choice reads two columns of the stored rows and is one row per file; a file that holds most of the
    rows is split in the join."""
    daily = tried.where(F.col("_try") == VA_DAILY.name).select("FileName").distinct().withColumn("_daily", F.lit(True))
    marked = lookup_join(tried, daily, ["FileName"])
    return marked.where((F.col("_try") == VA_DAILY.name) | F.col("_daily").isNull())


def ingest_va_auto(lines: DataFrame) -> DataFrame:
    """Virtual-account files: the daily layout, or the realtime one for files without any daily line. The lines
    are read and parsed once, both ways, and stored; the choice is made on what is stored."""
    pieces = with_cuts(lines.withColumn("layout", F.lit("va")), VA_DAILY, VA_REALTIME, layouts=dict.fromkeys((VA_DAILY.name, VA_REALTIME.name), "va"))
    both = pieces.select("id", "FileName", F.inline(F.array_compact(F.array(*va_tries()))))
    tried = materialize(both.select("id", "FileName", "_try", "_record.*").where(VA_DAILY.parsed()))
    return schemas.conform(chosen_tries(tried), schemas.PARSED)
