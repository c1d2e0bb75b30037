"""A corpus store: tables as Parquet folders, published by manifests.

A commit writes the folders of all tables that it touches, and then one manifest
that names the folders of every table, put into place by a rename.  Readers go
by the last manifest, so the tables of a commit appear together or not at all: a
run that dies leaves folders that no manifest names, and the next commit writes
over them.  An append writes the new rows alone, and only deletes rewrite a
table.  One writer at a time is assumed; a second one's manifest is refused.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import schema
from .scratch import materialise

#: Folders of a table above which ``compact`` puts them into one.
FOLDERS = 64


def dense_ids(df: DataFrame, order: list[str], name: str, start: int = 1) -> DataFrame:
    """``df`` with consecutive ids in ``order``: sorted by ranges, numbered in each, and shifted by the ranges before.

    No window holds all rows: only one count for each range is gathered.
    """
    parts = materialise(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__range", F.spark_partition_id()))
    before = Window.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.groupBy("__range").agg(F.count("*").alias("n")).select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__shift"))
    within = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return parts.withColumn("__row", within).join(shifts, "__range").withColumn(name, (F.col("__row") + F.col("__shift") + F.lit(start - 1)).cast("long")).drop("__range", "__row", "__shift")


class CorpusStore:
    """The corpus tables under ``root``, any path that Spark can write to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _manifest(self) -> tuple[int, dict[str, list[str]]]:
        """The last commit's number and the folders of each table, oldest first."""
        folder = self._path(f"{self.root}/_commits")
        if not self._fs.exists(folder):
            return 0, {}
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        numbers = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
        if not numbers:
            return 0, {}
        stream = self._fs.open(self._path(f"{self.root}/_commits/{max(numbers):08d}.json"))
        try:
            return max(numbers), json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, number: int, state: dict[str, list[str]]) -> None:
        final = self._path(f"{self.root}/_commits/{number:08d}.json")
        aside = self._path(f"{self.root}/_commits/.{uuid.uuid4().hex}")
        stream = self._fs.create(aside)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        if self._fs.exists(final) or not self._fs.rename(aside, final):
            self._fs.delete(aside, False)
            raise RuntimeError(f"commit {number} of {self.root} is there already: another writer")

    def commit(self, *changes: tuple[str, str, DataFrame]) -> None:
        """Publish changes together: each is a table, ``append`` or ``replace``, and rows."""
        number, state = self._manifest()
        number += 1
        for k, (table, how, rows) in enumerate(changes):
            name = f"{number:08d}-{k}"
            self._write(table, name, rows)
            state[table] = [name] if how == "replace" else [*state.get(table, []), name]
        self._publish(number, state)

    def _write(self, table: str, name: str, rows: DataFrame) -> None:
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.tables()[table]]
        rows.select(*columns).write.mode("overwrite").parquet(f"{self.root}/{table}/{name}")

    def versions(self, table: str) -> list[str]:
        """The folders that hold a table's rows, oldest first."""
        return self._manifest()[1].get(table, [])

    def create(self) -> bool:
        """Make all tables, empty; False if they were there."""
        there = self._manifest()[1]
        missing = [t for t in schema.tables() if t not in there]
        if missing:
            self.commit(*((t, "replace", self.empty(t)) for t in missing))
        return bool(missing)

    def empty(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], schema.tables()[table])

    def read(self, table: str) -> DataFrame:
        names = self.versions(table)
        if not names:
            return self.empty(table)
        return self.spark.read.schema(schema.tables()[table]).parquet(*[f"{self.root}/{table}/{n}" for n in names])

    def append(self, table: str, df: DataFrame) -> None:
        self.commit((table, "append", df))

    def replace(self, table: str, df: DataFrame) -> None:
        self.commit((table, "replace", df))

    def compact(self, folders: int = FOLDERS) -> list[str]:
        """Put tables of more than ``folders`` folders into one each; their names.  The old folders stay for those who read them.

        Rows with a document's id are laid out by it, so a read of some ids opens few files.
        """
        state = self._manifest()[1]
        large = [t for t, names in state.items() if len(names) > folders]

        def laid_out(table: str) -> DataFrame:
            rows = self.read(table)
            return rows.repartitionByRange("result_id").sortWithinPartitions("result_id") if "result_id" in rows.columns else rows

        if large:
            self.commit(*((t, "replace", laid_out(t)) for t in large))
        return large

    def vacuum(self) -> int:
        """Delete folders that the last manifest doesn't name, and older manifests; nobody may be reading them."""
        number, state = self._manifest()
        gone = 0
        for table in schema.tables():
            folder = self._path(f"{self.root}/{table}")
            for entry in self._fs.listStatus(folder) if self._fs.exists(folder) else []:
                if entry.getPath().getName() not in state.get(table, []):
                    gone += bool(self._fs.delete(entry.getPath(), True))
        folder = self._path(f"{self.root}/_commits")
        for entry in self._fs.listStatus(folder) if number else []:
            if entry.getPath().getName() != f"{number:08d}.json":
                self._fs.delete(entry.getPath(), False)
        return gone

    def next_id(self, table: str, column: str) -> int:
        return (self.read(table).agg(F.max(column)).first()[0] or 0) + 1

    def views(self) -> None:
        """Temporary views of the tables and of the reports over them."""
        from .operators import views

        for name in schema.tables():
            self.read(name).createOrReplaceTempView(name)
        tables = {n: self.read(n) for n in schema.tables()}
        for name, view in views.VIEWS.items():
            view(tables).createOrReplaceTempView(name)
