"""Incremental import: reply files that arrive in a folder are imported as they come.

A file source finds new files and its checkpoint remembers them; each micro-batch
goes through the batch import, which leaves out pairs that are there already, so
a batch that is run again changes nothing.  Of a pair's records in one batch the
first wins, as in the batch import: files by name, and lines by their place.  A
large file is read in splits by many tasks, so a line's place is the byte at which
its split begins, and its number within the split.  Many small batches are put
together now and then, so a read opens few folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import importer
from ..sources import files
from ..store import CorpusStore


def replies(store: CorpusStore, folder: str, glob: str = "r*_c*.json", files_per_batch: int = 10_000, by_line: bool = False) -> DataFrame:
    """The stream of a folder's reply files, with each value's file and the byte where its split of the file begins: one a file, or one a line."""
    lines = store.spark.readStream.format("text").schema("value string").option("wholetext", not by_line).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).load(folder)
    return lines.select("value", "_metadata.file_name", "_metadata.file_block_start")


def records(batch: DataFrame, by_line: bool = False) -> DataFrame:
    """A micro-batch's values as records in the order of their places; lines are numbered before anything moves them."""
    if by_line:
        return files.placed(batch, 1)
    return batch.select(F.lit(1).alias("source_rank"), F.col("file_name").alias("source"), F.lit(0).cast("long").alias("line"), "value")


def stream_import(store: CorpusStore, folder: str, checkpoint: str, *, continuous: bool = False, by_line: bool = False, **how) -> StreamingQuery:
    """Start importing; without ``continuous`` the query ends when all present files are in."""

    def take(batch: DataFrame, _: int) -> None:
        importer.run(store, records(batch, by_line))
        store.compact()

    writer = replies(store, folder, by_line=by_line, **how).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime="10 seconds") if continuous else writer.trigger(availableNow=True)).start()
