"""Folders for what lies between jobs: the session's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: The cluster's setting for the folder that the driver and all executors share.
SETTING = "spark.checkpoint.dir"


def checkpoint_folder(spark: SparkSession) -> str:
    """The checkpoint folder in use; taken from the session's setting if none is.

    A local master may do without the setting.  On a cluster a folder of the
    driver's machine would be read by nobody else, so that is an error.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get(SETTING, None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError(f"{SETTING} must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="docquarry-checkpoint-")
        context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()


def materialise(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, its lineage cut."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def _place(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def new_folder(spark: SparkSession, prefix: str) -> str:
    """A new folder's path beside the checkpoints.  It goes when the session's JVM ends: results may be read from it until then."""
    path = f"{checkpoint_folder(spark)}/{prefix}-{uuid.uuid4().hex}"
    fs, at = _place(spark, path)
    fs.mkdirs(at)  # only what is there can be marked
    fs.deleteOnExit(at)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    fs, at = _place(spark, path)
    fs.delete(at, True)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder; none if it isn't there."""
    fs, at = _place(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; null if it isn't there."""
    fs, at = _place(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file: it appears whole, by a rename."""
    fs, at = _place(spark, path)
    aside = at.suffix(f".{uuid.uuid4().hex}.tmp")
    stream = fs.create(aside)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.delete(at, False)
    if not fs.rename(aside, at):
        raise OSError(f"{path} could not be written")
