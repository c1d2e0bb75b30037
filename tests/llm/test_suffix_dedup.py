"""Suffix deduplication against the windows of all texts, counted in plain Python."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docquarry.llm import suffix_dedup
from docquarry.llm.queries import op11_suffix_dedup

SCHEMA = "doc_id long, text string"


def brute(rows, window):
    """``n_bytes, n_removed, n_spans, kept`` of each row, in order."""
    data = [(text or "").encode() for _, text in rows]
    counts = Counter(b[k : k + window] for b in data for k in range(len(b) - window + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - window + 1):
            if counts[b[k : k + window]] > 1:
                gone[k : k + window] = True
        spans = int(np.count_nonzero(np.diff(gone.astype(np.int8)) == -1))
        out.append((len(b), int(gone.sum()), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def held(got, rows, window):
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=key) == sorted(((i, *x) for (i, _), x in zip(rows, brute(rows, window))), key=key)


def texts(seed, n=60):
    """Texts of a small alphabet with passages, copies, repetitions of their own, and many bytes a letter."""
    random = np.random.default_rng(seed)
    letters = np.array(list("abé𝄞"))
    passages = ["".join(random.choice(letters, size)) for size in (9, 12, 13, 14, 30, 55)]
    out = []
    for k in range(n):
        parts = ["".join(random.choice(letters, random.integers(0, 25))) for _ in range(4)]
        out.append(parts[0] + passages[random.integers(6)] + parts[1] + (passages[random.integers(6)] if k % 3 else "a" * (k % 40)) + parts[2])
    return out + out[:5] + ["ab" * 40, "ab" * 20, "", "a" * 11, "a" * 12, "a" * 13]


@pytest.mark.parametrize("window", [5, 12, 19, 50])
@pytest.mark.parametrize("sizes", [None, (7, 3, 5, 2, 1), (64, 16, 40, 8, 3)])
def test_small_windows(spark, monkeypatch, window, sizes):
    """Covers of several moduli; bounds small enough for every way of a name, a run and a group."""
    if sizes:
        for name, size in zip(("NAMED", "LOOKED", "HELD", "RUN", "HOT"), sizes):
            monkeypatch.setattr(suffix_dedup, name, size)
    rows = [*enumerate(texts(window)), (None, None), (3, "ab" * 20), (None, "b" * 30)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("key", F.lit(1)).withColumn("pairs", F.lit("x"))
    held(suffix_dedup.remove_repeats(df, window=window).collect(), rows, window)


def test_covers():
    """Any two residues are taken into the cover by a common shift."""
    for modulus, residues in suffix_dedup.COVERS.items():
        assert {(a - b) % modulus for a in residues for b in residues} == set(range(modulus))
    cover = suffix_dedup.Cover.of(200)
    assert (cover.modulus, cover.tuple) == (133, 68)
    for n in (0, 67, 68, 69, 200, 1000):
        every = [p for p in range(max(n - 67, 0)) if p % 133 in cover.residues]
        assert cover.places(np.arange(cover.count(n))).tolist() == every


def test_given_documents(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (*x[:3], hashlib.sha256(x[3]).hexdigest()) for (i, _), x in zip(rows, brute(rows, 200))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op11_suffix_dedup(spark, path).collect()}
    assert got == want and any(x[1] for x in want.values())


def test_exact_length(spark):
    """A passage of 200 bytes is found wherever it lies, one of 199 never is."""
    random = np.random.default_rng(3)
    word = lambda n: "".join(map(chr, random.integers(97, 123, n)))
    long, short = word(200), word(199)
    edge = [chr(33 + k) for k in range(40)]  # no two texts agree beside the passage
    rows = [(k, word(int(random.integers(0, 400))) + edge[k] + (long if k % 2 else short) + edge[k] + word(int(random.integers(0, 400)))) for k in range(40)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all((r.n_removed, r.n_spans) == ((200, 1) if r.doc_id % 2 else (0, 0)) for r in got)
    held(got, rows, 200)


def test_long_and_hot(spark):
    """A long text of one letter, and a passage that most texts hold, within ever other surroundings."""
    random = np.random.default_rng(4)
    word = lambda n: "".join(map(chr, random.integers(97, 123, n)))
    passage = word(350)
    rows = [(k, word(150) + passage + word(150)) for k in range(3000)]
    whole = brute(rows, 200)
    got = suffix_dedup.remove_repeats(spark.createDataFrame([*rows, (-1, "z" * 1_000_000)], SCHEMA).repartition(4)).collect()
    assert len(got) == 3001
    assert {r.doc_id: r.n_removed for r in got} == {-1: 1_000_000, **{k: x[1] for k, x in enumerate(whole)}}


def test_empty(spark):
    assert suffix_dedup.report(spark.createDataFrame([], SCHEMA)).collect() == []
    only = suffix_dedup.report(spark.createDataFrame([(1, None)], SCHEMA)).first()
    assert tuple(only) == (1, 0, 0, 0, hashlib.sha256().hexdigest())
