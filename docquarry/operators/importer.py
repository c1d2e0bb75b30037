"""Import of replies: the first record of a pair wins, later ones are skipped.

Records come with an order (``source_rank, source, line``).  Everything that
counts is an outcome on the row: ``imported``, ``skipped`` or ``error``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.strict_json import parse_records
from ..scratch import materialise
from ..store import CorpusStore, dense_ids

KEY = ["result_id", "category_id"]


def parse(records: DataFrame) -> DataFrame:
    """``records`` (``source_rank, source, line, value``) with ``record`` and its ids."""
    return parse_records(records).withColumns({k: F.col(f"record.{k}") for k in KEY})


def judge(parsed: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Parsed records with ``outcome``."""
    good = parsed.where("record.status = 'ok'")
    first = Window.partitionBy(*KEY).orderBy("source_rank", "source", "line")
    known = verdicts.select(*KEY).distinct().withColumn("known", F.lit(True))
    good = good.withColumn("place", F.row_number().over(first)).join(known, KEY, "left")
    good = good.withColumn("outcome", F.when((F.col("place") == 1) & F.col("known").isNull(), "imported").otherwise("skipped")).drop("place", "known")
    rest = parsed.where("record.status <> 'ok'").withColumn("outcome", F.when(F.col("record.status") == "ignored", "skipped").otherwise("error"))
    return good.unionByName(rest)


def classify(records: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``records`` with ``record`` and ``outcome``."""
    return judge(parse(records), verdicts)


def known_verdicts(store: CorpusStore, parsed: DataFrame) -> DataFrame:
    """The store's verdicts that records may meet: the bounds of the records' ids go into the read, so files and row groups of
    other ids are passed over.  Replies come by ranges of ids, as they were asked for."""
    first, last = parsed.where("record.status = 'ok'").agg(F.min("result_id"), F.max("result_id")).first()
    return store.read("result_category").select(*KEY).where(F.lit(False) if first is None else F.col("result_id").between(first, last))


def new_verdicts(classified: DataFrame) -> DataFrame:
    return classified.where("outcome = 'imported'").select(*KEY, "record.match", "record.reasoning_trace")


def new_quotes(classified: DataFrame) -> DataFrame:
    """Quotes of imported records, with their place in the record's array."""
    imported = classified.where("outcome = 'imported'")
    return imported.select(*KEY, "source_rank", "source", "line", F.posexplode("record.blockquotes").alias("position", "blockquote"))


def tallies(classified: DataFrame) -> DataFrame:
    """One row: records by outcome, and quotes.  A record with a bad quote is imported and an error."""
    outcome = lambda name: F.count_if(F.col("outcome") == name)
    imported = F.col("outcome") == "imported"
    return classified.agg(
        F.count("*").alias("total"),
        outcome("imported").alias("imported"),
        outcome("skipped").alias("skipped"),
        (outcome("error") + F.count_if(imported & F.col("record.quote_error"))).alias("errors"),
        F.coalesce(F.sum(F.when(imported, F.size("record.blockquotes"))), F.lit(0)).cast("long").alias("blockquotes"),
    )


def run(store: CorpusStore, records: DataFrame) -> dict:
    """Import records into a store, verdicts and quotes in one commit; importing them again changes nothing.

    Small files and splits are many tasks, and each step after the read would have as many, and write as many files: the
    read's go together into as many as a shuffle has.  Records have their places already, so nothing else changes.
    """
    tasks = int(store.spark.conf.get("spark.sql.shuffle.partitions"))
    parsed = materialise(parse(records.coalesce(tasks)))
    classified = materialise(judge(parsed, known_verdicts(store, parsed)))
    out = tallies(classified).first().asDict()
    if out["imported"]:
        now = F.current_timestamp()
        quotes = dense_ids(new_quotes(classified), ["source_rank", "source", "line", "position"], "blockquote_id", store.next_id("result_category_blockquote", "blockquote_id"))
        verdicts = new_verdicts(classified).withColumn("created_at", now)
        store.commit(("result_category", "append", verdicts), ("result_category_blockquote", "append", quotes.withColumn("created_at", now)))
    return out
