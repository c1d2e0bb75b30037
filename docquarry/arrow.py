"""What every Arrow function needs: its code on the workers, and batches of bounded size.

Spark bounds a batch in bytes (``spark.sql.execution.arrow.maxBytesPerBatch``, 64 MB
unless a session says otherwise), so long texts fill a batch with fewer rows and no
setting of the session is changed.  A function whose rows bring more than they
carry in takes them in slices; one on long texts takes them in slices of few bytes
and gives each slice's results away, so a worker holds Python objects of one slice,
however full its batches are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from .ship import ship

#: Bytes of text that are Python objects at a time.
SLICE = 1 << 20


def ready(spark: SparkSession | None = None) -> None:
    """See that the workers of a session (the active one, unless one is given) have the package's code."""
    spark = spark or SparkSession.getActiveSession()
    if spark is not None:
        ship(spark)


def in_slices(batches: Iterable[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Batches of at most so many rows."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at : at + rows].reset_index(drop=True)


def in_bytes(columns: Iterable[tuple[pa.Array, ...]], limit: int = SLICE) -> Iterator[tuple[list, ...]]:
    """The values of string columns in slices of about ``limit`` bytes at most (one row at least)."""
    for arrays in columns:
        sizes = [sum(filter(None, row)) for row in zip(*(pc.binary_length(a).to_pylist() for a in arrays))]
        start = held = 0
        for row, size in enumerate(sizes):
            if row > start and held + size > limit:
                yield tuple(a.slice(start, row - start).to_pylist() for a in arrays)
                start, held = row, 0
            held += size
        if sizes:
            yield tuple(a.slice(start).to_pylist() for a in arrays)
