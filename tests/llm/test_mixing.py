import hashlib
import random
import re
from collections import defaultdict

import pytest

from docquarry.llm import mixing


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Reshare round by round, as the contract says it."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    open_, left = set(names), share * sum(sizes.values())
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_.discard(s)
    return target


def rows():
    random.seed(6)
    out = []
    for i in range(400):
        source = random.choice(["a", "b", "é", "z", "", None] + ["hot"] * 4)
        text = random.choice([None, "", " \n"] + [" ".join("w" * random.randint(1, 4) for _ in range(random.randint(1, 80)))] * 9)
        out.append((i, text, source))
    return [*out, out[5], out[5], (None, "one two", "a"), (900, None, "empty"), (901, "", "empty")]


@pytest.mark.parametrize("digits", [20_000, 2])
def test_mix_matches_brute_force(spark, digits, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", digits)
    data = rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in data], "doc_id long, text string, source string, target string, size int")
    got = mixing.mix(df).collect()
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in data]
    total = defaultdict(int)
    for (_, _, s), n in zip(data, size):
        total[s] += n
    want = brute_targets(total)
    places = defaultdict(list)
    for (i, t, s), n in zip(data, size):
        places[s].append((hashlib.md5(f"{'' if i is None else i} {t or ''}".encode()).hexdigest(), i, n))
    taken = []
    for s, docs in places.items():
        goal, at = int(round(want[s], 6) + 0.5), 0
        passes, rest = divmod(goal, total[s]) if total[s] else (0, 0)
        for _, i, n in sorted(docs, key=lambda x: x[0]):
            taken.append((str(i), n, total[s], passes * n + min(max(rest - at, 0), n)))
            at += n
    assert sorted((str(r.doc_id), r["size"], r.source_size, r.taken) for r in got) == sorted(taken)
    assert all(abs(r.target - want[s]) < 1e-6 for s in want for r in got if r.source_size == total[s] and list(total.values()).count(total[s]) == 1)
    assert all(r.taken <= 2 * r["size"] for r in got)
    positions = [r.position for r in got if r.position is not None]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1
    assert got == mixing.mix(df.repartition(3)).collect()


def test_schedule_is_inverted(spark):
    for knots in mixing.SCHEDULES:
        areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
        df = spark.range(0, 101).select((mixing.F.col("id") / 100).alias("y")).withColumn("t", mixing.invert(mixing.F.col("y"), knots))
        for r in df.collect():
            held = 0.0
            for (t, v), (u, w) in zip(knots, knots[1:]):
                x = min(max(r.t - t, 0), u - t)
                held += v * x + (w - v) / (u - t) * x * x / 2
            assert abs(held / sum(areas) - r.y) < 1e-9


def test_mixed_rows_repeat_whole_documents(spark):
    data = rows()
    df = spark.createDataFrame([(*r, 7) for r in data], "doc_id long, text string, source string, extra int")
    out = mixing.mixed_rows(df)
    assert out.columns == df.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r.source] += len((r.text or "").split())
    total = defaultdict(int)
    for _, t, s in data:
        total[s] += len((t or "").split())
    want = brute_targets(total)
    assert all(abs(words[s] - want[s]) <= 80 for s in want)
    assert mixing.mixed_rows(df.limit(0)).count() == 0 and mixing.mix(df.limit(0)).count() == 0
