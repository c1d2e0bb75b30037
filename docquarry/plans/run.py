"""The data-plane verbs: fetch, prep, preflight, process, import, and all of them in a row."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions import split
from ..operators import importer, infer, ledger, pairs, preflight, prep, units
from ..sources import archive, files
from ..scratch import materialise
from ..store import CorpusStore


@dataclass(frozen=True)
class InferenceConfig:
    """How a run asks its model."""

    model: str = "rules"
    concurrency: int = 8
    partitions: int | None = None
    attempts: int = infer.ATTEMPTS
    #: Pairs of a unit, about, whose replies are saved together: what a dead run can lose.
    wave: int = 20_000


def fetch(spark: SparkSession, folder: str, urls: list[str] | None = None, fetcher: archive.Fetcher | None = None) -> dict:
    """Fetch archive URLs into a folder of markdown files; counts, and the failures' reasons."""
    asked = archive.demo_urls(spark, urls)
    known = None
    if files.exists(spark, folder, "*.md"):  # pages that are there aren't downloaded again
        known = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").load(folder).select(F.regexp_extract("path", "[^/]*$", 0).alias("filename"))
    there = archive.planned(asked).where("error IS NULL").join(known, "filename", "left_semi").count() if known is not None else 0
    found = materialise(archive.write_markdown(archive.fetch(asked, fetcher or archive.Web(), known), folder))
    counts = {r.status: r["count"] for r in found.groupBy("status").count().collect()}
    failed = [(r.url, r.error) for r in found.where("status = 'failed'").collect()]  # no more than the caller's own list
    return {"written": counts.get("written", 0), "skipped": there + counts.get("exists", 0), "failed": counts.get("failed", 0), "errors": failed}


def prep_db(store: CorpusStore, input_dir: str, prompts_dir: str, **how) -> dict:
    """Make the store if need be, sync categories and documents; the corpus status and what was done."""
    created = store.create()
    synced = prep.sync_categories(store, files.categories(store.spark, prompts_dir).drop("prompt"))
    found = files.documents(store.spark, input_dir)
    rejected = found.where("NOT valid_utf8").count()
    done = prep.sync_documents(store, found.where("valid_utf8").drop("valid_utf8"), **how)
    status = pairs.corpus_status(store.read("result"), store.read("category"), store.read("result_category"), how.get("limit", split.LIMIT)).first().asDict()
    return {"created": created, "categories": synced, "rejected": rejected, **done, "status": status}


def process(store: CorpusStore, prompts_dir: str, system_prompt: str, output_dir: str, backend: infer.Backend, config: InferenceConfig = InferenceConfig(), limit: int | None = None, limit_chars: int = split.LIMIT) -> dict:
    """Ask the backend for all pending pairs; save usable replies, and keep the ledger.

    The corpus is read once, to lay the pairs out beside their texts (``operators.units``); then units are asked one by
    one, each saved before the next.  A run that dies loses its unit, and the next run goes on with the layout.
    """
    spark, began = store.spark, time.monotonic()
    run_id = ledger.start(store, config.model)
    prompts = materialise(files.categories(spark, prompts_dir).select("category_filename", "prompt"))
    versions = [store.versions(t) for t in ("result", "category", "result_category")]
    made_from = units.fingerprint(versions, sorted(map(tuple, prompts.collect())), system_prompt, config.model, config.wave, limit, limit_chars)
    layout = units.found(spark, output_dir)
    if layout is None or layout.fingerprint != made_from:
        done = files.completed_pairs(files.reply_records(spark, output_dir))
        todo = pairs.pending_pairs(store.read("result"), store.read("category"), store.read("result_category"), limit_chars=limit_chars, completed=done, limit=limit)
        layout = units.lay_out(todo, store.read("result"), output_dir, config.wave, made_from)
    categories = units.asked_categories(store.read("category"), prompts)
    none = spark.createDataFrame([], "result_id bigint, category_id bigint")
    asked = list(units.open_units(spark, output_dir, layout))
    for unit in asked:
        requests = units.requests_of(spark, output_dir, layout, unit, categories, system_prompt, config.model, config.partitions or spark.sparkContext.defaultParallelism)
        replies = infer.infer(requests, backend, concurrency=config.concurrency, attempts=config.attempts)
        units.save(infer.outcomes(replies, none), output_dir, layout, unit)
    rows = spark.read.schema("outcome string, elapsed_sec double").parquet(*[units.saved_in(output_dir, layout, k) for k in asked]) if asked else None
    tally = infer.run_tallies(rows).first().asDict() if asked else dict.fromkeys(infer.TALLIES, 0)
    times = infer.request_times(rows).first().asDict() if asked else {}
    units.close(spark, output_dir)
    ledger.finish(store, run_id, tally["processed"], tally["saved"], tally["failed"], tally["skipped"], tally["processing_seconds"], None if asked else "No pairs to process")
    return {"run_id": run_id, "total_time_sec": time.monotonic() - began, **tally, **times}


def import_results(store: CorpusStore, input_dir: str) -> dict:
    return importer.run(store, files.reply_records(store.spark, input_dir))


def run(store: CorpusStore, input_dir: str, prompts_dir: str, system_prompt: str, output_dir: str, backend: infer.Backend, config: InferenceConfig = InferenceConfig(), **how) -> dict:
    """Prep, preflight with removal, process and import."""
    out = {"prep": prep_db(store, input_dir, prompts_dir, **how), "preflight": preflight.run(store, delete=True)}
    out["process"] = process(store, prompts_dir, system_prompt, output_dir, backend, config)
    return out | {"import": import_results(store, output_dir)}

