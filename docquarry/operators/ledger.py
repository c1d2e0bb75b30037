"""The run ledger: begin and end events are appended, the latest state of a run is read."""

from __future__ import annotations

import socket

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..store import CorpusStore


def latest(events: DataFrame) -> DataFrame:
    """One row for each run: its end if there is one, else its begin."""
    last = Window.partitionBy("run_id").orderBy(F.desc_nulls_last("finished_at"))
    return events.withColumn("place", F.row_number().over(last)).where("place = 1").drop("place")


def start(store: CorpusStore, model: str) -> int:
    run_id = store.next_id("run_stats", "run_id")
    row = store.spark.range(1).select(
        F.lit(run_id).alias("run_id"), F.date_trunc("second", F.current_timestamp()).alias("started_at"), F.lit(None).alias("finished_at"), F.lit(model).alias("model"),
        *(F.lit(0).alias(c) for c in ("pairs_processed", "pairs_saved", "pairs_failed", "pairs_skipped")), F.lit(None).alias("processing_seconds"),
        F.lit(0).alias("janitor_imported"), F.lit(None).alias("janitor_seconds"), F.lit(socket.gethostname()).alias("hostname"), F.lit(None).alias("notes"),
    )
    store.append("run_stats", row)
    return run_id


def finish(store: CorpusStore, run_id: int, processed: int, saved: int, failed: int, skipped: int, seconds: float, notes: str | None = None) -> None:
    begun = latest(store.read("run_stats")).where(F.col("run_id") == run_id)
    values = {"pairs_processed": processed, "pairs_saved": saved, "pairs_failed": failed, "pairs_skipped": skipped, "processing_seconds": float(seconds), "notes": notes}
    store.append("run_stats", begun.withColumns({c: F.lit(v) for c, v in values.items()}).withColumn("finished_at", F.date_trunc("second", F.current_timestamp())))
