"""Corpus pipeline: documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.  All stages but the last
return the columns of ``documents``; the last adds each text's pieces.

1. ``language_id`` drops documents whose language is rejected;
2. ``near_dedup`` keeps of each group of near copies the smallest doc_id;
3. ``pii`` puts the kind of each span of personal data in its place;
4. ``mixing`` repeats or leaves out documents, in the order of training;
5. ``sentencepiece`` adds piece ids, checked by decoding them.

Nulls in any column, empty and long texts, repeated rows, empty tables and other
columns are treated as the stages' operators say; other columns are kept.
SQL can't express stages 1, 2 and 5, so there is no SQL for the whole; the
tests hold it against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm import language, mixing, pieces, pii, simhash
from docquarry.llm.common import table
from docquarry.scratch import new_folder, remove


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.masked(docs)
    if "n_chars" in out.columns:  # it counts the text that is there now
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])).select(*docs.columns)
    return out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.with_pieces(docs, "piece_bpe_32k.model")


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("pii", personal_data), ("mixing", mix_sources), ("sentencepiece", sentencepiece)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.

    What lies between them is beside the checkpoints; a stage's table goes when the next one is written, and the last
    one's when the session ends.
    """
    folder = new_folder(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
    return docs
