"""Whitening against numpy's own eigenvectors and Python's own integers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docquarry.llm import whitening
from docquarry.llm.queries import op12_embedding_whitening

SCHEMA = "vec_id long, embedding array<float>"


def brute(vectors):
    """``n, deviations, explained, whitened`` (up to signs) of rows of floats."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], object)
    n, total = len(x), x.sum(axis=0)
    deviation = [int(sum((n * a - s) ** 2 for a, s in zip(row, total))) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, total)] for row in x], float)
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:32]
    return n, deviation, values[order] / values.sum(), centred @ parts[:, order] / np.sqrt(np.maximum(values[order], 1e-300))


def held(got, vectors, ids):
    n, deviation, explained, white = brute(vectors)
    rows = {(r.vec_id, r.component): r for r in got}
    assert len(got) == len(rows) == len(ids) * min(32, len(vectors[0]))
    for k in range(min(32, len(vectors[0]))):
        mine = [rows[i, k + 1] for i in ids]
        assert all(r.n == n and r.identity_error <= 1e-9 and abs(r.explained / explained[k] - 1) < 1e-9 for r in mine)
        assert [r.deviation for r in mine] == deviation
        values = np.array([r.whitened for r in mine])
        sign = np.sign(values @ white[:, k])
        assert np.abs(values - sign * white[:, k]).max() < 1e-6


def test_given_embeddings(spark):
    path = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").collect()
    held(op12_embedding_whitening(spark, path).collect(), [r.embedding for r in rows], [r.vec_id for r in rows])


@pytest.mark.parametrize("dims", [3, 5, 40])
def test_spread_over_many_tasks(spark, dims):
    """More tasks than are put together at once, some without rows; columns of very different sizes."""
    random = np.random.default_rng(dims)
    vectors = (random.normal(size=(300, dims)) * 10 ** np.linspace(2, -1, dims)).astype(np.float32).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), SCHEMA).repartition(70)
    held(whitening.whiten(df).collect(), vectors, range(300))


def test_bad_vectors_and_clashing_columns(spark):
    good = [[1.0, 2.0], [3.0, 5.0], [-1.0, 0.5], [3.0, 5.0]]
    rows = [(k, v) for k, v in enumerate(good)] + [(9, None), (10, [1.0, None]), (11, [math.nan, 1.0]), (12, [math.inf, 1.0]), (13, [1.0]), (14, [])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit("x")).withColumn("v", F.lit(None)).withColumn("n", F.lit(1))
    held(whitening.whiten(df).collect(), good, range(4))


def test_no_variance(spark):
    """One dimension never changes, and one row alone has no variance at all."""
    df = spark.createDataFrame([(None, [1.0, 2.0]), (2, [3.0, 2.0]), (2, [3.0, 2.0])], SCHEMA)
    got = whitening.whiten(df).collect()
    assert len(got) == 6 and all(r.whitened == 0 and r.explained == 0 for r in got if r.component == 2)
    assert all(abs(r.explained - 1) < 1e-12 and r.identity_error < 1e-12 for r in got if r.component == 1)
    alone = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], SCHEMA)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(1, 1, 0, 0, 0, 0), (2, 1, 0, 0, 0, 0)]


def test_empty(spark):
    for rows in ([], [(1, None)], [(1, [])]):
        out = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
        assert out.columns[0] == "vec_id" and out.count() == 0


def test_large_sums(spark):
    """Squares beyond machine integers within, and a result that still fits."""
    centre = whitening.Centre(1 << 40, (0, (1 << 40) * 1_000_000))
    x = np.array([[0, 1_000_001]])
    assert centre.scaled(x).tolist() == [[0, 1 << 40]]
    assert centre.centred(x).tolist() == [[0.0, 1.0]]


def test_jacobi_is_accurate():
    """Singular values of a graded matrix keep their relative accuracy."""
    random = np.random.default_rng(1)
    q, _ = np.linalg.qr(random.normal(size=(20, 20)))
    sizes = 10.0 ** -np.arange(20)
    lengths, vectors = whitening.jacobi(np.diag(sizes) @ q.T)
    assert np.abs(lengths / sizes - 1).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(20)).max() < 1e-13
