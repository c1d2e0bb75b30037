"""Document-category pairs that are still to be processed.

Pairs are made of ids alone: a document's text would be carried once for each
category through every join.  It comes back by id after all filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.split import LIMIT

#: Categories are a hand-written dimension; above this many the cross join is left to Spark.
CATEGORIES = 10_000


def eligible(result: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Parts, and whole documents of at most ``limit`` characters that have no parts."""
    parents = result.where("parent_result_id IS NOT NULL").select(F.col("parent_result_id").alias("__parent")).distinct()
    part = F.col("part_number").isNotNull()
    whole = F.col("parent_result_id").isNull() & F.col("part_number").isNull() & (F.length("content") <= limit)
    rows = result.where(part | whole)  # one scan; the anti-join asks whole documents alone
    return rows.join(parents, (rows["result_id"] == parents["__parent"]) & rows["part_number"].isNull(), "left_anti")


def pending_pairs(result: DataFrame, category: DataFrame, verdicts: DataFrame, *, limit_chars: int = LIMIT, completed: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """``result_id, category_id`` of eligible pairs without a verdict or a completed reply, in order.

    ``limit`` counts what is left after all filters; none or 0 means all.
    """
    documents = eligible(result.select("result_id", "part_number", "parent_result_id", "content"), limit_chars).select("result_id")
    categories = category.select("category_id")
    if categories.count() <= CATEGORIES:
        categories = F.broadcast(categories)
    key = ["result_id", "category_id"]
    pairs = documents.crossJoin(categories).join(verdicts.select(*key), key, "left_anti")
    if completed is not None:
        pairs = pairs.join(completed.select(*key), key, "left_anti")
    pairs = pairs.orderBy(*key)
    return pairs.limit(limit) if limit else pairs


def count_pending(result: DataFrame, category: DataFrame, verdicts: DataFrame, limit_chars: int = LIMIT) -> DataFrame:
    return pending_pairs(result, category, verdicts, limit_chars=limit_chars).agg(F.count("*").alias("pending"))


def corpus_status(result: DataFrame, category: DataFrame, verdicts: DataFrame, limit_chars: int = LIMIT) -> DataFrame:
    """Counters of a corpus in one row.

    ``pending_pairs`` here is the product less all verdicts, whatever they belong
    to; it may be negative, unlike the count of ``pending_pairs``.
    """
    own = result.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("parent_result_id").isNull()).alias("original_documents"),
        F.countDistinct("parent_result_id").alias("split_documents"),
        F.count_if(F.col("part_number").isNotNull()).alias("split_parts"),
    )
    one = lambda df, name: df.agg(F.count("*").alias(name))
    out = own.crossJoin(one(eligible(result, limit_chars), "eligible_documents")).crossJoin(one(category, "total_categories")).crossJoin(one(verdicts, "processed_pairs"))
    out = out.withColumn("total_possible_pairs", F.col("eligible_documents") * F.col("total_categories"))
    return out.withColumn("pending_pairs", F.col("total_possible_pairs") - F.col("processed_pairs"))


#: The parts of a request that do not change.
PROMPT_HEAD = "# Category Instructions\n\n"
PROMPT_DOCUMENT = "\n\n# Document to Analyze\n\n"
PROMPT_TAIL = (
    "\n\n# Response Format\n\nExplain your reasoning in 1-2 sentences. Then respond with JSON. Do not use a fenced codeblock.\n"
    '{"match": "yes" or "maybe" or "no", "blockquotes": ["verbatim quote 1", "verbatim quote 2"]}'
)
TEMPERATURE, MAX_TOKENS = 0.0, 32000


def request(content: Column, prompt: Column, system_prompt: str, model: str) -> Column:
    """A chat request as a struct; ``to_json`` makes it a body."""
    user = F.concat(F.lit(PROMPT_HEAD), F.coalesce(prompt, F.lit("")), F.lit(PROMPT_DOCUMENT), content, F.lit(PROMPT_TAIL))
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.struct(
        F.lit(model).alias("model"), F.array(message("system", F.lit(system_prompt)), message("user", user)).alias("messages"), F.lit(TEMPERATURE).alias("temperature"), F.lit(MAX_TOKENS).alias("max_tokens")
    )


def requests(pairs: DataFrame, result: DataFrame, category: DataFrame, prompts: DataFrame, system_prompt: str, model: str, partitions: int | None = None) -> DataFrame:
    """``custom_id, result_id, category_id, body`` for each pair; a category without a prompt has an empty one.

    ``partitions`` deals the pairs out by document before their texts come to them: a text moves once, whatever the number
    of its categories, and bodies don't move at all.

    ``prompts`` (category_filename, prompt) holds the present texts: versions of
    a category share them.
    """
    from ..functions.text import custom_id

    if partitions:
        pairs = pairs.repartition(partitions, "result_id").hint("merge")
    categories = category.select("category_id", "category_filename").join(prompts, "category_filename", "left").select("category_id", "prompt")
    full = pairs.join(result.select("result_id", "content"), "result_id").join(categories, "category_id")
    return full.select(custom_id(F.col("result_id"), F.col("category_id")).alias("custom_id"), "result_id", "category_id", F.to_json(request(F.col("content"), F.col("prompt"), system_prompt, model)).alias("body"))
