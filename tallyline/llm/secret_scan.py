"""Secret scans: certain secrets by pattern, weak candidates by linking the parts of a credential.

Base kinds (``assign``, ``access``, ``hex``) are always reported. Weak candidates (user or client ids,
high-variety tokens, endpoints) are reported only when complementary parts stand in one scope, that is
with at most ``SCOPE`` code points between them:

* ``token`` with an identifier (``access``, ``ident``) or an ``endpoint``,
* ``ident`` with a secret (``assign``, ``hex``, ``token``),
* ``endpoint`` with an identifier and a secret.

Parts are linked by an interval join: each part's scope covers some cells of SCOPE code points, parts
meet in cells of the same document, and the exact gap is tested after. Cells, not documents, are what a
task holds together, so a document of any length spreads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import whole
from tallyline.session import materialize

SCOPE = 200

# The base patterns. The count is the least length, of group 1 where there is one.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {
    "assign": (ASSIGN, 6),
    "access": (r"AKIA[A-Z0-9]{16,}", 20),  # a maximal run, so the same as any run of which 20 are kept
    "hex": (r"[0-9a-f]{24,}", 24),
}
WEAK = {
    "ident": (
        r"""(?i:access_?key_?id|client_?id|account_?id|user_?name|user|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]+)""",
        3,
    ),
    "token": (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/_=-])", 32),
    "endpoint": (r"""(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]*+://[^\s"'<>]+""", 8),
}
KINDS = [*BASE, *WEAK]
IDENTIFIERS, SECRETS = ("access", "ident"), ("assign", "hex", "token")
SPANS = "array<struct<start:int,end:int>>"


def spans(text: Column, pattern: str, least: int) -> Column:
    """Leftmost non-overlapping matches as spans in code points, those under ``least`` dropped.

    What stands between the matches comes from splitting at them; lengths of both add up to places."""
    grouped = "(" in pattern.replace("(?", "")
    hits = F.regexp_extract_all(text, F.lit(pattern), 0)
    sizes = F.regexp_extract_all(text, F.lit(pattern), 1) if grouped else hits
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), hits.alias("hit"), sizes.alias("measured")
    )
    none = F.array().cast("array<struct<start:int,end:int,size:int>>")
    walked = F.aggregate(
        F.slice(parts, 1, F.size(hits)),
        F.struct(F.lit(0).alias("at"), none.alias("found")),
        lambda seen, part: F.struct(
            (seen["at"] + F.length(part["gap"]) + F.length(part["hit"])).alias("at"),
            F.concat(
                seen["found"],
                F.array(
                    F.struct(
                        (seen["at"] + F.length(part["gap"])).alias("start"),
                        (seen["at"] + F.length(part["gap"]) + F.length(part["hit"])).alias("end"),
                        F.length(part["measured"]).alias("size"),
                    )
                ),
            ).alias("found"),
        ),
        lambda seen: seen["found"],
    )
    kept = F.transform(
        F.filter(walked, lambda s: s["size"] >= least), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))
    )
    return F.when(text.rlike(pattern), kept).otherwise(F.array().cast(SPANS))


def parts_of(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and one column of spans per kind, from one pass over the texts."""
    text = docs.select(*keep, whole("text").alias("_text"))
    found = {kind: spans(F.col("_text"), *rule) for kind, rule in (BASE | WEAK).items()}
    return text.select(*keep, *[column.alias(kind) for kind, column in found.items()])


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``_row, weak``: per row that has any, its weak candidates with complementary parts in scope."""
    shown = F.flatten(F.array(*[F.transform(F.col(kind), _named(kind)) for kind in KINDS]))
    flat = (
        parts.where(F.greatest(*[F.size(k) for k in WEAK]) > 0)
        .select("_row", F.explode(shown).alias("s"))
        .select("_row", "s.kind", "s.start", "s.end")
    )
    cell = lambda place: F.floor(place / scope)
    weak = flat.where(F.col("kind").isin(list(WEAK))).select(
        "_row", "kind", "start", "end",
        F.explode(F.sequence(cell(F.col("start") - scope), cell(F.col("end") + scope))).alias("cell"),
    )
    other = flat.select(
        "_row", F.col("kind").alias("by"), F.col("start").alias("by_start"), F.col("end").alias("by_end"),
        # Each part stands in the cell of its start; one that began before the scope reaches into it by its other cells.
        F.explode(F.sequence(cell(F.col("start")), cell(F.col("end") - 1))).alias("cell"),
    )
    near = (F.col("by_start") - F.col("end") <= scope) & (F.col("start") - F.col("by_end") <= scope)
    ident, secret = F.col("by").isin(*IDENTIFIERS), F.col("by").isin(*SECRETS)
    met = (
        weak.join(other, ["_row", "cell"]).where(near & ((F.col("by") != F.col("kind")) | (F.col("by_start") != F.col("start"))))
        .groupBy("_row", "kind", "start", "end")
        .agg(F.max(ident).alias("ident"), F.max(secret).alias("secret"), F.max(F.col("by") == "endpoint").alias("endpoint"))
    )
    shows = (
        F.when(F.col("kind") == "token", F.col("ident") | F.col("endpoint"))
        .when(F.col("kind") == "ident", F.col("secret"))
        .otherwise(F.col("ident") & F.col("secret"))
    )
    return met.where(shows).groupBy("_row").agg(
        F.collect_list(F.struct("kind", "start", "end")).alias("weak")
    )


def _named(kind: str):
    return lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))


def _ordered(items: Column) -> Column:
    """Spans by start, then kind as listed, then end."""
    rank = F.create_map(*[F.lit(x) for i, kind in enumerate(KINDS) for x in (kind, i)])
    keyed = F.transform(items, lambda s: F.struct(s["start"], rank[s["kind"]], s["end"], s["kind"].alias("kind")))
    return F.transform(
        F.sort_array(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )


def _written(items: Column) -> Column:
    return F.array_join(
        F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def found_spans(docs: DataFrame, *keep: str, scope: int = SCOPE) -> DataFrame:
    """Per row of ``docs``: ``keep`` columns, the base kinds' span columns, ``base`` and ``spans`` (all),
    both ordered arrays of struct(kind, start, end).

    Rows get a number when their spans are stored, so rows without an id or with a repeated one are
    kept apart. The stored table has the spans alone, no text."""
    parts = materialize(parts_of(docs, *keep).withColumn("_row", F.monotonically_increasing_id()))
    base = F.flatten(F.array(*[F.transform(F.col(kind), _named(kind)) for kind in BASE]))
    weak = F.coalesce(F.col("weak"), F.array().cast("array<struct<kind:string,start:int,end:int>>"))
    return (
        parts.join(linked(parts, scope), "_row", "left")
        .select(*keep, *BASE, base.alias("_base"), weak.alias("_weak"))
        .select(*keep, *BASE, _ordered(F.col("_base")).alias("base"), _ordered(F.concat("_base", "_weak")).alias("spans"))
    )


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    Null and empty texts have no spans (the digest is that of the empty string). Other columns are
    ignored; an empty table gives an empty result. Spans of different kinds may overlap."""
    found = found_spans(docs, "doc_id", scope=scope)
    return found.select(
        "doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in BASE],
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, mask: str = "[REDACTED]", scope: int = SCOPE) -> DataFrame:
    """``docs`` with every found span replaced by ``mask`` (overlapping ones by one mask) and ``n_chars``
    counted anew where texts changed. Rows, other columns and their order stay.

    Spans are joined back by id and hash of the text; only rows with spans take part on that side."""
    keyed = docs.select(F.col("doc_id").alias("_id"), F.xxhash64(whole("text")).alias("_hash"), "text")
    found = (
        found_spans(keyed, "_id", "_hash", scope=scope)
        .where(F.size("spans") > 0).groupBy("_id", "_hash").agg(F.first("spans").alias("_spans"))
    )
    text = docs["text"]
    walked = F.aggregate(
        found["_spans"],
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda seen, s: F.struct(
            F.greatest(seen["at"], s["end"]).alias("at"),
            F.when(s["start"] < seen["at"], seen["out"]).otherwise(
                F.concat(seen["out"], F.array(F.substring(text, seen["at"] + 1, s["start"] - seen["at"]), F.lit(mask)))
            ).alias("out"),
        ),
        lambda seen: F.concat(F.array_join(seen["out"], ""), F.substring(text, seen["at"] + 1, F.length(text))),
    )
    joined = docs.join(
        found, docs["doc_id"].eqNullSafe(found["_id"]) & (F.xxhash64(whole(text)) == found["_hash"]), "left"
    )
    changed = F.when(found["_spans"].isNotNull(), walked).otherwise(text)
    columns = [
        changed.alias("text") if c == "text"
        else F.when(found["_spans"].isNotNull(), F.length(changed).cast(docs.schema[c].dataType)).otherwise(docs[c]).alias(c)
        if c == "n_chars" else docs[c]
        for c in docs.columns
    ]
    return joined.select(*columns)
