"""Embedding whitening by one-sided Jacobi SVD of a TSQR factor.

Entries become whole numbers on a grid, so sums over all rows are exact and the
centred rows, (n*x - S) / n, are right to the last bit.  Each task reduces blocks
of centred rows to one triangular factor R (TSQR); factors of a number of tasks
are stacked and reduced again, level by level, until one is left: R'R = n * V for
the covariance V.  Plane rotations make R's columns orthogonal, all disjoint pairs
of columns at a time; the accumulated rotations are the components, and the
columns' lengths over sqrt(n) are the standard deviations, to full relative
accuracy, as V itself is never formed.  Rows are whitened where they are.

Nothing is shuffled but sums and factors: a task holds some blocks of rows, and
one factor.  The driver gets the sums, the ``COMPONENTS`` chosen components and
the largest error.

Defined results: rows whose vector is null, or holds null or non-finite entries,
are dropped, and so are vectors shorter than the longest (a covariance needs one
length); null ids, ties and repeated rows are rows like any other; entries must be
below 2^40 in size; a component without variance has ``whitened`` and
``explained`` 0 and is left out of ``identity_error``; an empty table, or one of empty vectors, gives
an empty table; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, cut

#: Components that are kept; steps of the grid in one, and what is added to its numbers.
COMPONENTS, GRID, OFFSET = 32, 64, 1_000_000
#: Rows of a block, and factors that are put together in one task.
BLOCK, FAN = 4096, 16
#: Entries above this have no place on the grid.
MOST = 2.0**40


def rows_of(df: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``id, v`` of the rows whose vectors are whole and finite and have the longest length."""
    vector = df[vector_column].cast("array<double>")
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(df[id_column].alias("id"), vector.alias("v")).where(good)
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    return rows.where(F.size("v") == longest).where(F.size("v") > 0)


def grid(batch: pa.Array) -> np.ndarray:
    """The vectors of a batch as whole numbers on the grid, a row each."""
    flat = batch.flatten().to_numpy(zero_copy_only=False)
    if len(flat) and not np.abs(flat).max() < MOST:
        raise ValueError(f"an entry is {np.abs(flat).max()}: entries must be below {MOST}")
    return (np.floor(GRID * flat).astype(np.int64) + OFFSET).reshape(len(batch), -1)


def _blocks(batches: Iterator[pa.RecordBatch], column: int = 1) -> Iterator[np.ndarray]:
    """Grid rows of batches in blocks of about ``BLOCK`` rows."""
    held: list[np.ndarray] = []
    for batch in batches:
        if batch.num_rows:
            held.append(grid(batch.column(column)))
        if sum(map(len, held)) >= BLOCK:
            yield np.concatenate(held)
            held = []
    if held:
        yield np.concatenate(held)


def sums(rows: DataFrame) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for x in _blocks(batches):
            n, total = n + len(x), x.sum(axis=0) if total is None else total + x.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array([n] * len(total), pa.int64()), pa.array(total)], ["at", "n", "s"])

    found = rows.mapInArrow(run, "at int, n long, s long").groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    told = found.orderBy("at").collect()  # a row for each dimension
    return (told[0].n if told else 0), [int(r.s) for r in told]


@dataclass(frozen=True)
class Centre:
    """The sums of the fit list."""

    n: int
    total: tuple[int, ...]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """``n*x - S``, exactly: as machine integers where they and their squares' sum fit, else as Python's."""
        most = self.n * int(max(abs(int(x.max())), abs(int(x.min())))) + max(map(abs, self.total))
        if most < 1 << 62:
            out = self.n * x - np.array(self.total, np.int64)
            if len(self.total) * int(np.abs(out).max()) ** 2 < 1 << 63:
                return out
        return self.n * x.astype(object) - np.array(self.total, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.scaled(x) / self.n).astype(np.float64)


def combined(parts: DataFrame, join: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """Arrays of tasks (``part, data``, rows of doubles) put together ``FAN`` at a time, in tasks, until one is left."""
    parts = cut(parts)
    n = parts.select("part").agg(F.max("part")).first()[0]
    if n is None:
        return None

    def run(pdf):
        import pandas as pd

        arrays = [np.array(list(map(np.asarray, x)), np.float64) for x in pdf.sort_values("part")["data"]]
        return pd.DataFrame({"part": [int(pdf["group"].iloc[0])], "data": [join(arrays).tolist()]})

    while True:
        parts = cut(parts.withColumn("group", F.floor(F.col("part") / FAN)).groupBy("group").applyInPandas(run, "part long, data array<array<double>>"))
        if n < FAN:
            return np.array(parts.first().data, np.float64)
        n //= FAN


def stacked(factors: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.concatenate(factors), mode="r")


def factor(rows: DataFrame, centre: Centre) -> np.ndarray | None:
    """R of the centred rows: triangular, as many columns as dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for x in _blocks(batches):
            block = centre.centred(x)
            r = np.linalg.qr(block if r is None else np.concatenate([r, block]), mode="r")
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.tolist()], pa.list_(pa.list_(pa.float64())))], ["data"])

    parts = rows.mapInArrow(run, "data array<array<double>>")
    return combined(parts.select(F.spark_partition_id().cast("long").alias("part"), "data"), stacked)


def jacobi(r: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of ``r``, falling, and the right singular vectors as columns, by rotations of its columns.

    A sweep rotates each pair of columns once, in rounds of disjoint pairs (a tournament's).  It ends when no two
    columns have a cosine above the rounding error.
    """
    d = r.shape[1]
    even = d + d % 2
    a = np.zeros((max(r.shape[0], 1), even))  # an odd number of columns gets one of zeros
    a[: r.shape[0], :d] = r
    v = np.eye(even)
    seats = np.arange(even)
    eps = np.finfo(np.float64).eps
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(even - 1):
            p, q = seats[: even // 2], seats[even // 2 :][::-1]
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
            alpha, beta, gamma = (a[:, p] ** 2).sum(0), (a[:, q] ** 2).sum(0), (a[:, p] * a[:, q]).sum(0)
            limit = np.sqrt(alpha) * np.sqrt(beta)
            turn = np.abs(gamma) > eps * limit
            if not turn.any():
                continue
            p, q, alpha, beta, gamma, limit = (x[turn] for x in (p, q, alpha, beta, gamma, limit))
            worst = max(worst, float((np.abs(gamma) / limit).max()))
            zeta = (beta - alpha) / (2 * gamma)
            tan = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cos = 1 / np.hypot(1.0, tan)
            sin = cos * tan
            for m in (a, v):
                m[:, p], m[:, q] = cos * m[:, p] - sin * m[:, q], sin * m[:, p] + cos * m[:, q]
        if worst <= 4 * eps:
            break
    lengths = np.sqrt((a[:, :d] ** 2).sum(0))  # the column of zeros is never turned
    order = np.argsort(-lengths, kind="stable")
    vectors = v[:d, order]
    return lengths[order], vectors / np.sqrt((vectors**2).sum(0))


@dataclass(frozen=True)
class Whitener:
    """Components as columns, what each is divided by (0: no variance), and its share of the variance."""

    centre: Centre
    vectors: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        scale = np.divide(1.0, self.deviations, out=np.zeros_like(self.deviations), where=self.deviations > 0)
        return self.centre.centred(x) @ self.vectors * scale


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Components of ``rows`` (id, v); none if there are no rows."""
    n, total = sums(rows)
    if not n:
        return None
    centre = Centre(n, tuple(total))
    r = factor(rows, centre)
    lengths, vectors = jacobi(r)
    least = lengths[0] * len(lengths) * np.finfo(np.float64).eps  # below it there is rounding alone
    lengths = np.where(lengths > least, lengths, 0.0)
    variance = (lengths**2).sum()
    explained = lengths**2 / variance if variance else np.zeros_like(lengths)
    return Whitener(centre, vectors[:, :components], lengths[:components] / np.sqrt(n), explained[:components])


def moments(parts: list[np.ndarray]) -> np.ndarray:
    """Moments of several parts as those of all: a row of the count and the means, then sums of centred products."""
    out = parts[0].copy()
    for b in parts[1:]:
        n, m = out[0, 0], b[0, 0]
        delta = b[0, 1:] - out[0, 1:]
        out[1:, 1:] += b[1:, 1:] + np.outer(delta, delta) * (n * m / (n + m))
        out[0, 1:] += delta * (m / (n + m))
        out[0, 0] = n + m
    return out


def identity_error(rows: DataFrame, whitener: Whitener) -> float:
    """The largest entry of the whitened rows' covariance less the identity, over components that have variance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for x in _blocks(batches):
            w = whitener.apply(x)
            mean = w.mean(axis=0)
            own = np.zeros((w.shape[1] + 1, w.shape[1] + 1))
            own[0, 0], own[0, 1:], own[1:, 1:] = len(w), mean, (w - mean).T @ (w - mean)
            out = own if out is None else moments([out, own])
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.list_(pa.float64())))], ["data"])

    parts = rows.mapInArrow(run, "data array<array<double>>")
    all_of = combined(parts.select(F.spark_partition_id().cast("long").alias("part"), "data"), moments)
    varied = np.flatnonzero(whitener.deviations > 0)
    covariance = all_of[1:, 1:][np.ix_(varied, varied)] / all_of[0, 0]
    return float(np.abs(covariance - np.eye(len(varied))).max()) if len(varied) else 0.0


RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component: the whitened value beside the figures of the fit."""
    spark = df.sparkSession
    bound_batches(spark)
    rows = rows_of(df, id_column=id_column, vector_column=vector_column)
    kind = dict(rows.dtypes)["id"]
    whitener = fit(rows, components)
    if whitener is None:
        return spark.createDataFrame([], f"id {kind}, {RESULT}").withColumnRenamed("id", id_column)
    error = identity_error(rows, whitener)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = grid(batch.column(1))
            w = whitener.apply(x)
            m, k = w.shape
            deviation = (whitener.centre.scaled(x) ** 2).sum(axis=1)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, whitener.centre.n, np.int64)),
                    pa.array(deviation.tolist(), pa.int64()).take(each), pa.array(w.reshape(-1)), pa.array(np.tile(whitener.explained, m)), pa.array(np.full(m * k, error)),
                ],
                ["id", *(c.split(" ")[0] for c in RESULT.split(", "))],
            )

    return rows.mapInArrow(run, f"id {kind}, {RESULT}").withColumnRenamed("id", id_column)
