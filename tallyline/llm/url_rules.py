"""URL filtering: fixed host and path rules first, mined association rules for the rest.

Spark's FP-growth mines combinations of URL tokens from labelled URLs. A combination becomes a
blocking rule when enough labelled URLs hold it (support) and enough of those are bad (confidence).
Rules that need more tokens than another rule of no lower confidence are dropped. URLs are matched
by an inverted index from token to rule: a URL fits a rule when it holds all of the rule's tokens.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LABEL = "label:bad"  # no URL token starts with "label:"


@dataclass(frozen=True)
class Fixed:
    verdict: str
    rule: str  # host, then the path from its slash on

    @property
    def host(self) -> str:
        return self.rule.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.split("/", 1)[1]


FIXED = (
    Fixed("block", "net/"),
    Fixed("allow", "example.net/en/"),
    Fixed("block", "example.com/de/"),
    Fixed("allow", "org/fr/"),
)


@dataclass(frozen=True)
class Mining:
    """``least``: labelled URLs that hold a rule's tokens and are bad, a count that other URLs don't change;
    ``confidence``: share of bad ones among the labelled URLs with the tokens."""

    least: int = 20
    confidence: float = 0.6


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(host: Column, path: Column, fixed: Fixed) -> Column:
    return ((host == fixed.host) | host.endswith("." + fixed.host)) & path.startswith(fixed.path)


def fixed_rule(host: Column, path: Column, rules=FIXED) -> Column:
    """The longest fixed rule that fits, as struct(rule, verdict), else null."""
    longest = sorted(rules, key=lambda r: -len(r.rule))
    found = [
        F.when(fits(host, path, r), F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in longest
    ]
    return F.coalesce(*found)


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: host labels, the last two labels, words inside labels, path parts (numbers as
    ``#``), file endings and names of query fields. Empty for a URL without a host and path."""
    labels = F.split(host, r"\.", -1)
    site = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    parts = F.split(path, r"[/.]+", -1)
    words = F.array_except(F.split(host, r"[^a-z0-9]+", -1), labels)
    fields = F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([^=&#]+)"), 1)

    def named(kind: str, items: Column) -> Column:
        shown = F.transform(items, lambda x: F.when(x.rlike("^[0-9]+$"), F.lit("#")).otherwise(x))
        return F.transform(F.filter(shown, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))

    every = [
        named("host:", labels), named("site:", F.array(site)), named("word:", words),
        named("path:", parts), named("field:", fields),
    ]
    return F.array_distinct(F.concat(*every))


def mine(labelled: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """Blocking rules ``rule_id, tokens, confidence, support`` from ``tokens array<string>, bad
    boolean`` rows. No labelled rows, or none that are bad: no rule."""
    spark = labelled.sparkSession
    known = labelled.where(F.col("bad").isNotNull() & (F.size("tokens") > 0)).select("tokens", "bad")
    known = materialize(known.withColumn("row", F.monotonically_increasing_id()))
    n = known.count()
    # A token that fewer bad URLs hold is in no rule. Without those, counting sets stays cheap.
    each = known.select("row", "bad", F.explode("tokens").alias("token"))
    frequent = materialize(each.where("bad").groupBy("token").count().where(F.col("count") >= mining.least).select("token"))
    none = "rule_id string, tokens array<string>, confidence double, support double"
    if frequent.isEmpty():
        return spark.createDataFrame([], none)
    # Tokens of exactly the same rows are one item: the sets of each other's tokens need not be counted.
    like = materialize(alike(each.join(frequent, "token")))
    named = like.select("item", F.explode("members").alias("token"))
    # Rows left with no token have no part in a rule; n counts them in the support.
    held = materialize(each.join(named, "token").groupBy("row", "bad").agg(F.collect_set("item").alias("tokens")).select(
        F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(LABEL)))).otherwise(F.col("tokens")).alias("items")
    ))
    n_held = held.count()
    # Half a URL less, so that rounding doesn't ask for one more than ``least``.
    support = max(mining.least - 0.5, 0.5) / n_held
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=mining.confidence).fit(held)
    rules = model.associationRules.where(F.col("consequent") == F.array(F.lit(LABEL))).select(
        F.array_sort("antecedent").alias("tokens"), "confidence",
        (F.col("support") * n_held / n).alias("support"),
    )
    return spelled_out(without_longer(rules.withColumn("rule_id", F.array_join("tokens", " "))), like)


def alike(each: DataFrame) -> DataFrame:
    """``item, members``: tokens (of ``row, token`` rows) that lie in exactly the same rows, by the number, the
    sum and the exclusive or of the rows' hashes. The least token names the item."""
    of = F.xxhash64("row")
    rows = each.groupBy("token").agg(
        F.count("*").alias("n"), F.sum(of.cast("decimal(38,0)")).alias("sum"), F.bit_xor(of).alias("xor")
    )
    return rows.groupBy("n", "sum", "xor").agg(F.min("token").alias("item"), F.collect_set("token").alias("members")).select("item", "members")


def spelled_out(rules: DataFrame, like: DataFrame) -> DataFrame:
    """The rules with every token that an item stands for: each choice of one member per item is a rule."""
    parts = rules.select("rule_id", "confidence", "support", F.explode("tokens").alias("item")).join(like, "item")
    held = parts.groupBy("rule_id", "confidence", "support").agg(F.collect_list("members").alias("choices"))
    none = F.array(F.array().cast("array<string>"))
    chosen = F.aggregate(
        "choices", none,
        lambda made, members: F.flatten(F.transform(made, lambda one: F.transform(members, lambda m: F.concat(one, F.array(m))))),
    )
    every = held.select("confidence", "support", F.explode(chosen).alias("tokens"))
    tokens = F.array_sort("tokens")
    return every.select(F.array_join(tokens, " ").alias("rule_id"), tokens.alias("tokens"), "confidence", "support")


def without_longer(rules: DataFrame) -> DataFrame:
    """Drop each rule of which a proper subset of tokens is a rule of no lower confidence. Found by
    the same inverted index that matches URLs."""
    short = rules.select(
        F.col("rule_id").alias("by"), F.size("tokens").alias("need"), F.col("confidence").alias("by_confidence"),
        F.explode("tokens").alias("token"),
    )
    long = rules.select("rule_id", "confidence", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    beaten = (
        long.join(short, "token")
        .where((F.col("need") < F.col("n")) & (F.col("by_confidence") >= F.col("confidence")))
        .groupBy("rule_id", "by", "need").count()
        .where(F.col("count") == F.col("need"))
        .select("rule_id")
    )
    return rules.join(beaten, "rule_id", "left_anti").select("rule_id", "tokens", "confidence", "support")


def matched(urls: DataFrame, rules: DataFrame, *key: str) -> DataFrame:
    """Keys of the rows whose ``tokens`` hold all tokens of some rule, once each."""
    index = rules.select("rule_id", F.size("tokens").alias("need"), F.explode("tokens").alias("token"))
    return (
        urls.select(*key, F.explode("tokens").alias("token"))
        .join(index, "token")
        .groupBy(*key, "rule_id", "need").count()
        .where(F.col("count") == F.col("need"))
        .select(*key).distinct()
    )


def judge(pages: DataFrame, rules: DataFrame, fixed=FIXED) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    A fixed rule decides where one fits (the longest), else a mined rule blocks and all other URLs are
    allowed. Null URLs and URLs without ``://`` have an empty host and path and are allowed. Rows with
    equal ids are judged each on its own; other columns are ignored."""
    url = F.col("url")
    parsed = pages.select("page_id", "url").withColumns({"_host": host_of(url), "_path": path_of(url)})
    parsed = parsed.withColumns(
        {"_fixed": fixed_rule(F.col("_host"), F.col("_path"), fixed), "tokens": tokens_of(url, F.col("_host"), F.col("_path"))}
    )
    open_urls = parsed.where(F.col("_fixed").isNull()).select("url", "tokens").dropDuplicates(["url"])
    mined = matched(open_urls, rules, "url").select(F.col("url").alias("_url"))
    return parsed.join(mined, (parsed.url == F.col("_url")) & parsed._fixed.isNull(), "left").select(
        "page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_fixed.rule").alias("rule"),
        F.coalesce(F.col("_fixed.verdict"), F.when(F.col("_url").isNotNull(), "block").otherwise("allow")).alias("verdict"),
    )


def label_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``tokens, bad``: pages with a label of their id. Bad: low quality or toxic. Labels without
    either value are left out; a page with several labels is bad if one of them is."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    known = labels.groupBy("doc_id").agg(F.max(bad).alias("bad")).where("doc_id is not null and bad is not null")
    url = F.col("url")
    return (
        pages.where("url is not null").select("page_id", "url").join(known, F.col("page_id") == F.col("doc_id"))
        .select(tokens_of(url, host_of(url), path_of(url)).alias("tokens"), "bad")
    )
