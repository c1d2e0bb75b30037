"""Work for a model, laid out once: pending pairs beside their documents' texts, in units that are done one by one.

The corpus is read when the work is laid out and not again: a unit is a range of
document ids in a folder of its own, each document's text once with the ids of
its pending categories.  A unit's replies go to a folder of their own, and a mark
in the ledger of units says that they are whole; a run that dies loses the unit
it was at.  The next run goes on with the same layout as long as the corpus, the
categories and what is asked are the same, and else lays out anew what is
pending then.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import file_names, materialise, read_text, remove, write_text
from .pairs import CATEGORIES, request

WORK = "unit int, result_id bigint, content string, categories array<bigint>"


@dataclass(frozen=True)
class Layout:
    """A layout under ``folder/work``: its name, what it was made from, and how much there is."""

    name: str
    fingerprint: str
    units: int
    pairs: int


def fingerprint(*parts: object) -> str:
    """A digest of what a layout depends on."""
    return hashlib.sha256(json.dumps(parts, default=str, sort_keys=True).encode()).hexdigest()


def ranges(pairs: DataFrame, size: int) -> DataFrame:
    """``unit, result_id, categories`` of pairs: documents in the order of their ids, about ``size`` pairs a unit.

    Documents are dealt to sorted ranges; a running sum within each and one over the ranges' totals number the units, so
    no task holds all of them.
    """
    documents = pairs.groupBy("result_id").agg(F.sort_array(F.collect_list("category_id")).alias("categories"))
    documents = materialise(documents.repartitionByRange("result_id").withColumn("__range", F.spark_partition_id()).withColumn("__n", F.size("categories").cast("long")))
    before = Window.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = documents.groupBy("__range").agg(F.sum("__n").alias("n"))
    shifts = totals.select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__shift"))
    within = Window.partitionBy("__range").orderBy("result_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = documents.withColumn("__before", F.coalesce(F.sum("__n").over(within), F.lit(0))).join(shifts, "__range")
    return rows.select(F.floor((F.col("__before") + F.col("__shift")) / size).cast("int").alias("unit"), "result_id", "categories")


def lay_out(pairs: DataFrame, result: DataFrame, folder: str, size: int, made_from: str) -> Layout:
    """Write the work for ``pairs`` under ``folder/work``; the manifest comes last, so half a layout is none."""
    spark = pairs.sparkSession
    remove(spark, f"{folder}/work")
    planned = materialise(ranges(pairs, size))
    told = planned.agg(F.countDistinct("unit").alias("units"), F.coalesce(F.sum(F.size("categories")), F.lit(0)).alias("pairs")).first()
    layout = Layout(uuid.uuid4().hex, made_from, told.units, told.pairs)
    texts = planned.join(result.select("result_id", "content"), "result_id")
    texts.repartition("unit").sortWithinPartitions("unit", "result_id").write.partitionBy("unit").parquet(f"{folder}/work/{layout.name}")
    write_text(spark, f"{folder}/work/layout.json", json.dumps(asdict(layout)))
    return layout


def found(spark: SparkSession, folder: str) -> Layout | None:
    """The layout that is there, if any."""
    text = read_text(spark, f"{folder}/work/layout.json")
    return None if text is None else Layout(**json.loads(text))


def open_units(spark: SparkSession, folder: str, layout: Layout) -> Iterator[int]:
    """The numbers of the units that have no mark; units without documents have nothing to do."""
    done = set(file_names(spark, f"{folder}/work/done"))
    there = {int(n.removeprefix("unit=")) for n in file_names(spark, f"{folder}/work/{layout.name}") if n.startswith("unit=")}
    return (k for k in sorted(there) if str(k) not in done)


def requests_of(spark: SparkSession, folder: str, layout: Layout, unit: int, categories: DataFrame, system_prompt: str, model: str, partitions: int) -> DataFrame:
    """``custom_id, result_id, category_id, body`` of a unit's pairs, texts dealt out once to ``partitions`` tasks.

    ``categories`` has ``category_id, prompt``.
    """
    from ..functions.text import custom_id

    columns = ", ".join(WORK.split(", ")[1:])
    rows = spark.read.schema(columns).parquet(f"{folder}/work/{layout.name}/unit={unit}").repartition(partitions, "result_id")
    rows = rows.select("result_id", "content", F.explode("categories").alias("category_id")).join(categories, "category_id")
    return rows.select(custom_id(F.col("result_id"), F.col("category_id")).alias("custom_id"), "result_id", "category_id", F.to_json(request(F.col("content"), F.col("prompt"), system_prompt, model)).alias("body"))


def asked_categories(category: DataFrame, prompts: DataFrame) -> DataFrame:
    """``category_id, prompt``, to be sent to all tasks while they are few."""
    rows = materialise(category.select("category_id", "category_filename").join(prompts, "category_filename", "left").select("category_id", "prompt"))
    return F.broadcast(rows) if rows.count() <= CATEGORIES else rows


def save(outcomes: DataFrame, folder: str, layout: Layout, unit: int) -> None:
    """Save a unit's outcomes and mark it as done; what a run that died left of the unit goes."""
    spark = outcomes.sparkSession
    outcomes.select("custom_id", F.when(F.col("outcome") == "saved", F.col("record")).alias("record"), "outcome", "elapsed_sec").write.mode("overwrite").parquet(saved_in(folder, layout, unit))
    write_text(spark, f"{folder}/work/done/{unit}", "")


def saved_in(folder: str, layout: Layout, unit: int) -> str:
    return f"{folder}/replies/layout={layout.name}/unit={unit}"


def close(spark: SparkSession, folder: str) -> None:
    """The work is done: the texts and the ledger of units go, the replies stay."""
    remove(spark, f"{folder}/work")
