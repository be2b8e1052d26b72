"""The registered query of each corpus operator: production parameters over the whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyline.llm import (
    collocations,
    compression_quality,
    decontaminate,
    html_text,
    jaccard_join,
    lsh_forest,
    piece_tokens,
    quality_rules,
    secret_scan,
    token_alignment,
    toxicity,
    url_rules,
    warc,
)
from tallyline.llm.common import table
from tallyline.session import shared_folder


def piece_model() -> str:
    """The tokenizer file the production queries use; the operator takes any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_tokens.encode(table(spark, sf_dir, "documents"), piece_model())


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "words", "matched")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.rate(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/tallyline/warc-{uuid.uuid4().hex}"
    index = warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return compression_quality.rate(docs, compression_quality.train(docs, table(spark, sf_dir, "labels")))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rules = url_rules.mine(url_rules.label_urls(pages, table(spark, sf_dir, "labels")))
    return url_rules.judge(pages, rules)


def op11_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_copies(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.summarize(table(spark, sf_dir, "documents"), byte_model(), piece_model())


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = (
        op1_html_text, op2_piece_tokens, op3_decontaminate, op4_jaccard_join, op5_secret_scan, op6_quality_rules,
        op7_toxicity, op8_warc, op9_compression_quality, op10_url_rules, op11_lsh_forest,
        op12_token_alignment, op13_collocations,
    )
    return {query.__name__: query for query in made}
