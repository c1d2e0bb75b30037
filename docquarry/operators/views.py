"""Reports over the corpus tables: each takes the tables by name and gives a DataFrame.

Small dimensions are left for Spark to broadcast by their measured size.
Quotes are counted before they meet documents, and a document's parts are rolled
up in one aggregation.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import MAYBE, NO, YES

Tables = Mapping[str, DataFrame]


def _is(values: tuple[str, ...]):
    return F.sum(F.when(F.col("match").isin(*values), 1).otherwise(0))


def processing_summary(t: Tables) -> DataFrame:
    """Totals over finished runs: one row always, with null sums if there is none."""
    total = {c: F.sum(c) for c in ("pairs_processed", "pairs_saved", "pairs_failed", "processing_seconds", "janitor_imported", "janitor_seconds")}
    return (
        t["run_stats"]
        .where("finished_at IS NOT NULL")
        .agg(
            F.count("*").alias("total_runs"),
            *(s.alias(f"total_{c}") for c, s in total.items()),
            F.round(total["processing_seconds"] / 3600.0, 2).alias("total_processing_hours"),
            F.min("started_at").alias("first_run"),
            F.max("finished_at").alias("last_run"),
        )
    )


def result_summary(t: Tables) -> DataFrame:
    """Verdict and quote counts of each document; zeros where there are none."""
    verdicts = t["result_category"].groupBy("result_id").agg(
        F.countDistinct("category_id").alias("categories_processed"), _is(YES).alias("yes_count"), _is(MAYBE).alias("maybe_count"), _is(NO).alias("no_count")
    )
    quotes = t["result_category_blockquote"].groupBy("result_id").agg(F.count("*").alias("total_blockquotes"))
    counts = ("categories_processed", "yes_count", "maybe_count", "no_count", "total_blockquotes")
    return (
        t["result"]
        .select("result_id", "filepath", "content_sha256", "created_at")
        .join(verdicts, "result_id", "left")
        .join(quotes, "result_id", "left")
        .select("result_id", "filepath", "content_sha256", "created_at", *(F.coalesce(c, F.lit(0)).alias(c) for c in counts))
    )


def blockquotes_by_category(t: Tables) -> DataFrame:
    """Quotes with their document, category and verdict, by document and category."""
    return (
        t["result_category_blockquote"]
        .select("result_id", "category_id", "blockquote", "created_at")
        .join(t["result_category"].select("result_id", "category_id", "match"), ["result_id", "category_id"])
        .join(t["result"].select("result_id", "filepath"), "result_id")
        .join(t["category"].select("category_id", "category_name", "category_description"), "category_id")
        .select("result_id", "filepath", "category_id", "category_name", "category_description", "match", "blockquote", "created_at")
        .orderBy("result_id", "category_id")
    )


def category_matches(t: Tables) -> DataFrame:
    """Verdicts with the names of their document and category, by both."""
    return (
        t["result_category"]
        .join(t["result"].select("result_id", "filepath"), "result_id")
        .join(t["category"].select("category_id", "category_name"), "category_id")
        .orderBy("result_id", "category_id")
        .select("result_id", "filepath", "category_name", "match", "reasoning_trace", "created_at")
    )


def document_category_aggregate(t: Tables) -> DataFrame:
    """Verdicts of split documents over their parts: yes before maybe before no; parts in numeric order."""
    parts = t["result"].where("part_number IS NOT NULL").select("result_id", "part_number", "parent_result_id")
    parents = t["result"].select(F.col("result_id").alias("parent_result_id"), F.col("filepath").alias("original_filepath"))
    document = F.coalesce("parent_result_id", "result_id")
    rolled = (
        parts.join(t["result_category"].select("result_id", "category_id", "match"), "result_id")
        .groupBy(document.alias("document_id"), "category_id")
        .agg(
            F.max("parent_result_id").alias("parent_result_id"),
            F.countDistinct("result_id").alias("parts_processed"),
            _is(YES).alias("yes_parts"),
            _is(MAYBE).alias("maybe_parts"),
            F.array_join(F.array_sort(F.collect_set("part_number")), ",").alias("matching_parts"),
        )
    )
    verdict = F.when(F.col("yes_parts") > 0, "yes").when(F.col("maybe_parts") > 0, "maybe").otherwise("no")
    return (
        rolled.join(t["category"].select("category_id", "category_name", "category_description"), "category_id")
        .join(parents, "parent_result_id", "left")
        .select(
            "document_id", "original_filepath", "category_id", "category_name", "category_description", verdict.alias("aggregate_match"),
            "parts_processed", "yes_parts", "maybe_parts", "matching_parts",
        )
    )


def document_blockquotes(t: Tables) -> DataFrame:
    """Distinct quotes of each whole document, by document and category."""
    documents = t["result"].select("result_id", "filepath", "parent_result_id")
    parents = t["result"].select(F.col("result_id").alias("parent_result_id"), F.col("filepath").alias("parent_filepath"))
    return (
        t["result_category_blockquote"]
        .select("result_id", "category_id", "blockquote")
        .join(documents, "result_id")
        .join(t["category"].select("category_id", "category_name"), "category_id")
        .join(parents, "parent_result_id", "left")
        .select(F.coalesce("parent_result_id", "result_id").alias("document_id"), F.coalesce("parent_filepath", "filepath").alias("original_filepath"), "category_id", "category_name", "blockquote")
        .distinct()
        .orderBy("document_id", "category_id")
    )


VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    f.__name__: f for f in (processing_summary, result_summary, blockquotes_by_category, category_matches, document_category_aggregate, document_blockquotes)
}


def match_distribution(t: Tables) -> DataFrame:
    return t["result_category"].groupBy("match").agg(F.count("*").alias("verdicts"))


def category_coverage(t: Tables) -> DataFrame:
    """Documents and categories that have verdicts."""
    return t["result_category"].agg(F.countDistinct("result_id").alias("documents"), F.countDistinct("category_id").alias("categories"), F.count("*").alias("verdicts"))
