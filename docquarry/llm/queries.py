"""The registered queries of this subpackage, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversations, language, media, mixing, oracles, pieces, pii, quality, simhash, suffix_dedup, token_counts, url_filter, warc, whitening
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), "word_bpe_49k.json", limit=2048)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = language.fit(docs)
    found = language.identify(docs, model=model).unionByName(language.identify_pages(pages, model), allowMissingColumns=True)
    return found.select("doc_id", "page_id", "lang", "confidence", "text_lang", "kept")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.rule_frame(spark, url_filter.RULES))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc.archive_pages(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), "piece_bpe_32k.model")


def op10_media_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_media(table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damaged_and_repaired(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_mixing_sources, op2_token_counts, op3_simhash_near_dedup, op4_quality_rules, op5_pii, op6_language_id, op7_url_filters, op8_warc, op9_sentencepiece, op10_media_gif, op11_suffix_dedup, op12_embedding_whitening, op13_conversation_repair)}

ORACLE_SQL: dict[str, str] = {"op1_mixing_sources": oracles.OP1, "op4_quality_rules": oracles.OP4, "op7_url_filters": oracles.OP7, "op8_warc": oracles.OP8}
