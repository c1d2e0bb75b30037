"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import materialise
from ..scratch import new_folder as new_folder
from ..ship import ship
from ..sources.tables import read_table

#: Words everywhere: maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows in an Arrow batch of these operators: their bytes are bounded anew by ``by_bytes``, in steps below Spark's own bound.
ROWS = 512
SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession, rows: int = ROWS) -> None:
    """Lower the session's Arrow batch size to ``rows`` (never raise it), and see that workers have the code.

    A plan takes the setting of its session when it runs, so it has to stay lowered.
    """
    ship(spark)
    now = int(spark.conf.get(SETTING, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(SETTING, str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the path may be one that only Spark can open."""
    return read_table(spark, sf_dir, name)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    return materialise(df)


def own(*names: str) -> list[str]:
    """Column names for one call's use, which no table of a caller can have."""
    mark = uuid.uuid4().hex
    return [f"__{name}_{mark}" for name in names]


def by_bytes(batches: Iterable[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slice batches so that ``column`` holds about ``limit`` bytes at most (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            if row > start and held + (size or 0) > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size or 0
        yield batch.slice(start)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding it."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


#: What a join's small side may hold to be broadcast, in rows and bytes; beyond, Spark joins by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20


def _width(value: Column, kind: T.DataType) -> Column:
    """About the bytes that a value takes in a broadcast table."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value)
    elif isinstance(kind, T.ArrayType):
        flat = not isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType))
        size = F.size(value) * 8 if flat else F.octet_length(F.to_json(value)) * 2
    elif isinstance(kind, (T.StructType, T.MapType)):
        size = F.octet_length(F.to_json(value)) * 2
    else:
        return F.lit(8)
    return F.coalesce(size, F.lit(0)) + 8


def small(df: DataFrame) -> DataFrame:
    """``df`` (narrow rows), materialised, and marked for broadcast only if it has few rows and bytes."""
    df = cut(df)
    width = sum((_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(0))
    n, size = df.agg(F.count("*"), F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()
    return F.broadcast(df) if n <= BROADCAST_ROWS and size <= BROADCAST_BYTES else df


def sums_before(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with, for each name of ``sums``, the sum of its column over all rows before a row in ``order``.

    Rows are dealt to sorted ranges; a window runs within each range, and one over the ranges' totals.  No task
    holds all rows.  Sums are exact as long as numbers are whole or stay below 2^53.
    """
    at, first = own("range", "first")
    named = {name: own(name)[0] for name in sums}
    ranged = cut(df.repartitionByRange(*order).withColumn(at, F.spark_partition_id()))
    before = Window.partitionBy(F.lit(0)).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(at).agg(*(F.sum(c).alias(named[k]) for k, c in sums.items()))  # a row for each range
    shifts = totals.select(F.col(at).alias(first), *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in named.values()))
    within = Window.partitionBy(at).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.withColumns({k: F.coalesce(F.sum(c).over(within), F.lit(0)) for k, c in sums.items()})
    out = out.join(F.broadcast(shifts), F.col(at) == F.col(first)).withColumns({k: F.col(k) + F.col(n) for k, n in named.items()})
    return out.drop(at, first, *named.values())
