"""Parquet tables as sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, if its files have too few row groups for half of them.

    Row groups aren't split, so a small table in one file would be one task.
    Large tables have many, and stay as they are: nothing is shuffled then.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"))
