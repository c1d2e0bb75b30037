"""Preflight: documents that hold no usable text, and their removal."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..scratch import materialise
from ..store import CorpusStore


def scan(result: DataFrame, **thresholds) -> DataFrame:
    """``result_id, filepath, content_sha256, reason``; ``reason`` is null for valid documents."""
    rows = result.select("result_id", "filepath", "content_sha256", "content")
    return text.with_reason(rows, flight=True, **thresholds).drop("content")


def tallies(scanned: DataFrame) -> DataFrame:
    bad = F.count_if(F.col("reason").isNotNull())
    return scanned.agg(F.count("*").alias("total"), (F.count("*") - bad).alias("valid"), bad.alias("problematic"))


def reasons(scanned: DataFrame) -> DataFrame:
    """How often each reason occurs, most frequent first."""
    return scanned.where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("documents")).orderBy(F.desc("documents"), "reason")


def kinds(reasons: DataFrame) -> DataFrame:
    """Reasons without their numbers, which are as many as lengths and ratios: ``kind, documents``, most frequent first."""
    kind = F.regexp_replace("reason", r"(?<![\w.])[0-9]+(\.[0-9]+)?(?= chars|%|\))", "N")
    return reasons.groupBy(kind.alias("kind")).agg(F.sum("documents").alias("documents")).orderBy(F.desc("documents"), "kind")


def excluded(before: DataFrame, scanned: DataFrame, now=None) -> DataFrame:
    """The exclusions with those of a scan: the last writer of a file path wins."""
    new = scanned.where("reason IS NOT NULL").select("filepath", "reason", "content_sha256", (F.current_timestamp() if now is None else now).alias("excluded_at"), F.lit(1).alias("turn"))
    rows = before.select("filepath", "reason", "content_sha256", "excluded_at").withColumn("turn", F.lit(0)).unionByName(new)
    last = Window.partitionBy("filepath").orderBy(F.desc("turn"), F.desc("excluded_at"))
    return rows.withColumn("place", F.row_number().over(last)).where("place = 1").drop("place", "turn")


def without(table: DataFrame, scanned: DataFrame) -> DataFrame:
    """``table``'s rows of documents that the scan doesn't reject."""
    return table.join(scanned.where("reason IS NOT NULL").select("result_id"), "result_id", "left_anti")


def run(store: CorpusStore, delete: bool = False, **how) -> dict:
    """Scan a store's documents; with ``delete`` exclude the bad ones and remove them, their verdicts and quotes, in one commit.

    All reasons are written as a table beside the store's; ``by_reason`` counts their kinds, which are few.
    """
    scanned = materialise(scan(store.read("result"), **how))
    out = tallies(scanned).first().asDict() | {"deleted": 0}
    out["reasons"] = f"{store.root}/_reports/preflight_reasons"
    reasons(scanned).write.mode("overwrite").parquet(out["reasons"])
    out["by_reason"] = {r.kind: r.documents for r in kinds(store.spark.read.parquet(out["reasons"])).collect()}
    if delete and out["problematic"]:
        rest = ((name, "replace", without(store.read(name), scanned)) for name in ("result_category_blockquote", "result_category", "result"))
        store.commit(("excluded_file", "replace", excluded(store.read("excluded_file"), scanned)), *rest)
        out["deleted"] = out["problematic"]
    return out
