"""Sync of categories and documents into a store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import split, text
from ..scratch import materialise
from ..store import CorpusStore, dense_ids


def new_categories(files: DataFrame, known: DataFrame) -> DataFrame:
    """Category files (``category_filename, category_name, category_description, prompt_sha256``) not in the table as they are.

    An edited file is a new version beside the old one.
    """
    return files.join(known.select("category_filename", "prompt_sha256"), ["category_filename", "prompt_sha256"], "left_anti")


def sync_categories(store: CorpusStore, files: DataFrame) -> int:
    """Add unseen categories, ids in the order of file names; the number of files."""
    new = materialise(new_categories(files, store.read("category")))
    if not new.isEmpty():
        store.append("category", dense_ids(new, ["category_filename"], "category_id", store.next_id("category", "category_id")).withColumn("created_at", F.current_timestamp()))
    return files.count()


def new_documents(files: DataFrame, known: DataFrame) -> DataFrame:
    """Files (``filepath, content, content_sha256``) whose path and hash are not in the table, with ``reason``."""
    return text.with_reason(files.join(known.select("filepath", "content_sha256"), ["filepath", "content_sha256"], "left_anti"))


def document_rows(valid: DataFrame, limit: int = split.LIMIT, size: int = split.TARGET, overlap: int = split.OVERLAP) -> DataFrame:
    """Valid files as rows without ids: the document, and the parts of large ones (``part_number``, ``parent_path``)."""
    none = F.lit(None)
    whole = valid.select("filepath", "content", "content_sha256", none.cast("int").alias("part_number"), none.cast("string").alias("parent_path"), F.col("filepath").alias("sort_path"))
    parts = split.split_documents(valid.select("filepath", "content"), limit, size, overlap)
    parts = parts.select(
        F.concat_ws("_", "filepath", F.col("part_number").cast("string")).alias("filepath"), F.col("part_content").alias("content"), F.sha2("part_content", 256).alias("content_sha256"),
        F.col("part_number").cast("int").alias("part_number"), F.col("filepath").alias("parent_path"), F.col("filepath").alias("sort_path"),
    )
    return whole.unionByName(parts)


def with_ids(rows: DataFrame, start: int = 1) -> DataFrame:
    """Consecutive ids in path order, a document before its parts, and the parts' parents."""
    rows = materialise(dense_ids(rows.withColumn("sort_part", F.coalesce("part_number", F.lit(0))), ["sort_path", "sort_part"], "result_id", start))
    parents = rows.where("part_number IS NULL").select(F.col("filepath").alias("parent_path"), F.col("result_id").alias("parent_result_id"))
    return rows.join(parents, "parent_path", "left").drop("parent_path", "sort_path", "sort_part")


def sync_documents(store: CorpusStore, files: DataFrame, *, on_change: str = "error", limit: int = split.LIMIT, size: int = split.TARGET, overlap: int = split.OVERLAP) -> dict:
    """Add unseen valid documents; the numbers synced, skipped and split.

    A known path with another hash is an error, as paths are unique; with
    ``on_change="replace"`` the old document, its parts and what hangs on them go.
    Everything is checked before the one commit that publishes it, deletes and new rows together.
    """
    if files.isEmpty():
        raise ValueError("no documents found")
    known = store.read("result")
    new = materialise(new_documents(files, known))
    valid = new.where("reason IS NULL").drop("reason")
    changed = materialise(valid.select("filepath").join(known.select("filepath", "result_id"), "filepath"))
    deletes: list[tuple[str, str, DataFrame]] = []
    if not changed.isEmpty():
        if on_change == "error":
            raise ValueError(f"changed documents, for instance {changed.first().filepath}")
        parts = known.join(changed.select(F.col("result_id").alias("parent_result_id")), "parent_result_id").select("result_id")
        gone = materialise(changed.select("result_id").union(parts))
        deletes = [(name, "replace", store.read(name).join(gone, "result_id", "left_anti")) for name in ("result_category_blockquote", "result_category", "result")]
    counts = new.agg(F.count_if(F.col("reason").isNotNull()).alias("skipped"), F.count_if(F.col("reason").isNull() & (F.length("content") > limit)).alias("split")).first()
    rows = with_ids(document_rows(valid, limit, size, overlap), store.next_id("result", "result_id")).withColumn("created_at", F.current_timestamp())
    store.commit(*deletes, ("result", "append", rows))
    return {"synced": files.count() - counts.skipped, "skipped": counts.skipped, "split": counts.split}
