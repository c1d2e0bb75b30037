import random
import re

import numpy as np
import pytest
import xxhash

from docquarry.llm import shingle_join, simhash
from docquarry.llm.components import components


def brute_fingerprint(text, shingle=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        least[find(i)] = min(least.get(find(i), x), x)
    return [least[find(i)] for i in range(len(ids))]


def test_masks_cover_every_pair_in_the_radius():
    random.seed(1)
    masks = simhash.covering_masks()
    assert len(masks) == 15
    for _ in range(3000):
        bits = random.sample(range(64), random.randint(0, 3))
        flip = sum(1 << b for b in bits)
        table = [m for m in masks if not flip & m]
        assert table
        for kept in table[:2]:
            assert any(not flip & x for x in simhash.block_masks(kept))


def test_fingerprint_matches_brute_force():
    random.seed(2)
    for _ in range(200):
        text = "".join(random.choice("aB cÄé\n\t\x0b  x") for _ in range(random.randint(0, 60)))
        assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)
    assert simhash.fingerprint(None) == 0


def test_forest_spans_the_links():
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 1 << 60))
    members = np.array(sorted({base ^ sum(1 << int(b) for b in rng.integers(0, 30, 3)) for _ in range(150)}), np.int64)
    edges = [(int(members[u]), int(members[v])) for u, v in simhash.forest(members)]
    assert all(bin((u ^ v) & (1 << 64) - 1).count("1") <= 3 for u, v in edges)
    want = brute_components(list(range(len(members))), [int(x) for x in members])
    got = {int(m): int(m) for m in members}
    for _ in members:
        for u, v in edges:
            got[u] = got[v] = min(got[u], got[v])
    assert len(set(want)) == len(set(got.values()))


@pytest.fixture
def texts():
    random.seed(4)
    words = ["w%d" % i for i in range(60)]
    base = [" ".join(random.choice(words) for _ in range(200)) for _ in range(8)]
    rows = []
    for i in range(240):
        text = random.choice(base).split(" ")
        for _ in range(random.randint(0, 2)):
            text[random.randrange(len(text))] = random.choice(words)
        rows.append((1000 - i, " ".join(text)))
    return [*rows, (5, None), (6, ""), (7, " \n"), (8, "A b"), (8, "A b"), (9, "long " * 20000)]


@pytest.mark.parametrize("light, members", [(256, 8192), (2, 8192), (2, 6)])
def test_components_match_brute_force(spark, texts, light, members, monkeypatch):
    monkeypatch.setattr(simhash, "LIGHT", light)
    monkeypatch.setattr(simhash, "MEMBERS", members)
    df = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, fp string")
    rows = simhash.near_duplicates(df).collect()
    fps = [brute_fingerprint(t) for _, t in texts]
    want = brute_components([i for i, _ in texts], fps)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in rows) == sorted((i, f"{f:016x}", c) for (i, _), f, c in zip(texts, fps, want))
    kept = simhash.keep_one(df, likeness=simhash.STRICT).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(near_components([i for i, _ in texts], [t for _, t in texts], 3)))
    assert kept[0].asDict().keys() == {"doc_id", "text", "fp"}


def brute_shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]
    if not words:
        return frozenset()
    return frozenset(b" ".join(words[k : k + 5]) for k in range(max(len(words) - 4, 1)))


def near_components(ids, texts, shingle=5):
    """Components of near copies, pair by pair: 5-word fingerprints within 3 bits, or sets of 5-word shingles similar by 0.8."""
    both = [(brute_fingerprint(t, shingle), brute_shingles(t)) for t in texts]
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, (a, x) in enumerate(both):
        for j in range(i):
            b, y = both[j]
            if (a ^ b).bit_count() <= 3 or x and y and 10 * len(x & y) >= 8 * len(x | y):
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        least[find(i)] = min(least.get(find(i), x), x)
    return [least[find(i)] for i in range(len(ids))]


def changed(words, share, vocabulary):
    out = list(words)
    for at in random.sample(range(len(out)), int(share * len(out))):
        out[at] = random.choice(vocabulary)
    return out


def near_texts():
    """Texts with copies of every likeness around the threshold, common passages, and short ones."""
    random.seed(46)
    vocabulary = ["w%d" % i for i in range(400)]
    passage = [random.choice(vocabulary) for _ in range(50)]
    out = []
    for n in (5, 6, 9, 25, 60, 200):
        for _ in range(5):
            base = [random.choice(vocabulary) for _ in range(n)]
            out.append(base)
            for share in (0.01, 0.02, 0.03, 0.04, 0.06):
                out.append(changed(base, share, vocabulary))
                out.append(base[: int(n * (1 - 4 * share))])
    out += [passage + [random.choice(vocabulary) for _ in range(k)] for k in range(1, 25)]  # mostly the passage
    out += [random.sample(out[-1], len(out[-1])) for _ in range(15)]
    return [" ".join(x).title() if k % 7 == 0 else " ".join(x) for k, x in enumerate(out)]


def test_near_copies_match_brute_force(spark, texts):
    rows = [*texts[-120:], *((2000 + k, t) for k, t in enumerate(near_texts())), (6000, "A b c"), (6001, "a  B\tc"), (6002, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = near_components([i for i, _ in rows], [t for _, t in rows])
    assert sorted(r.doc_id for r in simhash.keep_one(df).collect()) == sorted(set(want))
    assert 100 < len(set(want)) < len(rows) - 100


@pytest.mark.parametrize("held, texts_most", [(1 << 20, 1 << 16), (300, 1 << 16), (1 << 20, 3)])
def test_every_similar_pair_is_linked(spark, monkeypatch, held, texts_most):
    """The join alone, against all pairs."""
    monkeypatch.setattr(shingle_join, "HELD", held)
    monkeypatch.setattr(shingle_join, "TEXTS", texts_most)
    texts = [*near_texts(), None, "", " "]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] * 2, "key long, text string").repartition(6)
    got = {r.node: r.root for r in shingle_join.linked(df, spark.createDataFrame([], "u long, v long")).collect()}
    sets, want = [brute_shingles(t) for t in texts], list(range(len(texts)))
    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 10 * len(x & sets[j]) >= 8 * len(x | sets[j]):
                low, high = sorted((want[i], want[j]))
                want = [low if w == high else w for w in want]
    assert {k: got.get(k, k) for k in range(len(texts))} == dict(enumerate(want)) and len(got) > 50


def test_the_same_words_in_other_orders_stay_apart_in_linear_time(spark):
    """Permutations of a text's words are no near copies; many of them take no longer than other texts."""
    import time

    random.seed(47)
    words = ["w%d" % k for k in range(60)]
    took = []
    for n in (2000, 8000):
        rows = [(k, " ".join(random.sample(words, 60))) for k in range(n)]
        df = spark.createDataFrame([*rows, (n, rows[3][1] + " w1 end")], "doc_id long, text string").repartition(4)
        began = time.monotonic()
        assert simhash.keep_one(df).count() == n
        took.append(time.monotonic() - began)
    assert took[1] < 4 * took[0] + 20


def test_many_near_copies_of_one_text(spark):
    """A large group is linked without its pairs, and outsiders that meet it at its shingles are compared."""
    random.seed(48)
    vocabulary = ["v%d" % k for k in range(5000)]
    base = [random.choice(vocabulary) for _ in range(120)]
    rows = [(k, " ".join(changed(base, 0.009, vocabulary))) for k in range(1, 1500)]
    rows += [(5000 + k, " ".join(base[:60] + [random.choice(vocabulary) for _ in range(60)])) for k in range(50)]
    kept = sorted(r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect())
    assert kept == [1, *range(5000, 5050)]


def test_copies_near_the_threshold_are_ruled_out_before_they_are_compared(spark, monkeypatch):
    """Of many copies too far from each other, few pairs are left to compare; those above the threshold all are."""
    random.seed(49)
    vocabulary = ["v%d" % k for k in range(50000)]
    base = [random.choice(vocabulary) for _ in range(140)]
    texts = [" ".join(changed(base, random.choice((0.015, 0.022, 0.03, 0.036)), vocabulary)) for _ in range(500)]
    compared, verified = [], shingle_join._verified

    def counted(pairs, sets):
        compared.append(pairs.count())
        return verified(pairs, sets)

    monkeypatch.setattr(shingle_join, "_verified", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "key long, text string").repartition(4)
    got = {r.node: r.root for r in shingle_join.linked(df, spark.createDataFrame([], "u long, v long")).collect()}
    sets, want, similar = [brute_shingles(t) for t in texts], list(range(len(texts))), 0
    for i, x in enumerate(sets):
        for j in range(i):
            if 10 * len(x & sets[j]) >= 8 * len(x | sets[j]):
                similar += 1
                low, high = sorted((want[i], want[j]))
                want = [low if w == high else w for w in want]
    assert {k: got.get(k, k) for k in range(len(texts))} == dict(enumerate(want)) and 100 < len(set(want)) < 450
    assert len(compared) == 3 and compared[-1] < similar + 500, (compared, similar)


@pytest.mark.parametrize("members, blind", [(8192, False), (60, True)])
def test_a_group_near_the_threshold_is_linked_without_its_pairs(spark, monkeypatch, members, blind):
    """Tables of pairs hold a few for each text, where parities tell much; where they tell nothing, links are the same."""
    random.seed(51)
    vocabulary = ["v%d" % k for k in range(50000)]
    base = [random.choice(vocabulary) for _ in range(280)]
    # Four changed words and two are similar, and four and four are not: most texts are linked by any of a few.
    texts = [" ".join(changed(base, 0.0075 if k % 10 == 0 else 0.0145, vocabulary)) for k in range(400)]
    made, cut = [], shingle_join.cut

    def counted(df):
        done = cut(df)
        if {"u", "v"} <= set(done.columns):
            made.append(done.select("u", "v").distinct().count())
        return done

    monkeypatch.setattr(shingle_join, "cut", counted)
    monkeypatch.setattr(shingle_join, "MEMBERS", members, raising=False)
    if blind:
        monkeypatch.setattr(shingle_join, "parity", lambda found: np.zeros(16, np.int64))
    df = spark.createDataFrame(list(enumerate(texts)), "key long, text string").repartition(4)
    got = {r.node: r.root for r in shingle_join.linked(df, spark.createDataFrame([], "u long, v long")).collect()}
    sets, want, similar = [brute_shingles(t) for t in texts], list(range(len(texts))), 0
    for i, x in enumerate(sets):
        for j in range(i):
            if 10 * len(x & sets[j]) >= 8 * len(x | sets[j]):
                similar += 1
                low, high = sorted((want[i], want[j]))
                want = [low if w == high else w for w in want]
    assert {k: got.get(k, k) for k in range(len(texts))} == dict(enumerate(want)) and len(set(want)) < 200
    assert similar > 20 * len(texts)
    assert blind or max(made) < 4 * len(texts), (made, similar)


def test_a_forest_spans_what_can_be_linked():
    rng = np.random.default_rng(52)
    for n, share, more in ((2, 0.3, 0), (60, 0.5, 0), (60, 0.2, 0), (60, 0.5, 3), (60, 0.5, 60)):
        base = rng.integers(-(1 << 63), 1 << 63, 100, dtype=np.int64)
        sets = [np.unique(np.append(base[: 100 - k], rng.integers(-(1 << 63), 1 << 63, k, dtype=np.int64))) for k in rng.integers(0, 22, n)]
        texts = {"key": rng.permutation(n).astype(np.int64) - 5, "size": np.array([len(x) for x in sets]), "place": rng.integers(0, 16, n), "root": rng.integers(0, 1 + int(share * n), n)}
        texts |= {"held": texts["size"], "parity": np.array([shingle_join.parity(x) for x in sets]).view(np.uint64)}
        key, size, place, root = (texts[c].tolist() for c in ("key", "size", "place", "root"))

        def can(i, j):
            small, large = sorted((i, j), key=lambda x: (size[x], key[x]))
            differ = int(np.bitwise_count(texts["parity"][i] ^ texts["parity"][j]).sum())
            both = size[i] + size[j]
            return root[i] != root[j] and 9 * place[small] <= size[small] and 9 * min(size[i] - place[i], size[j] - place[j]) >= 4 * both and 9 * (both - differ) >= 8 * both

        want = {(max(key[i], key[j]), min(key[i], key[j])) for i in range(n) for j in range(i) if can(i, j)}
        refuted = set(sorted(want)[::5]) if n > 2 else set()
        got = shingle_join.forest(texts, refuted, more)
        assert len(got) == len(set(got)) and set(got) <= want - refuted

        def parts(pairs):
            of = dict(zip(key, root))
            for u, v in pairs:
                low, high = sorted((of[u], of[v]))
                of = {k: low if r == high else r for k, r in of.items()}
            return of

        assert parts(got) == parts(want - refuted)
        assert len(got) < len(set(root)) if not more else more < n or set(got) == want - refuted


def test_parities_never_tell_of_more_differences_than_there_are():
    rng = np.random.default_rng(50)
    for size, other, common in ((0, 3, 0), (1, 1, 1), (30, 25, 20), (140, 130, 120), (3000, 2500, 2200)):
        x = rng.integers(-(1 << 63), 1 << 63, size + other, dtype=np.int64)
        one, two = x[:size], np.append(x[:common], x[size : size + other - common])
        told = int(np.bitwise_count(shingle_join.parity(one) ^ shingle_join.parity(two)).sum())
        assert told <= size + other - 2 * common and (size > 1000 or told >= (size + other - 2 * common) * 0.8)


def test_changed_words_are_found_and_other_texts_stay(spark):
    random.seed(44)
    vocabulary = ["%s%d" % (random.choice("abcdefgh"), i) for i in range(3000)]
    fresh = lambda: [vocabulary[min(int(random.paretovariate(0.7)), 2999)] for _ in range(250)]
    rows, copies = [], []
    for i in range(150):
        text = fresh()
        rows.append((i, " ".join(text)))
        for at in random.sample(range(250), 4):
            text[at] = random.choice(vocabulary)
        copies.append((1000 + i, " ".join(text)))
    df = spark.createDataFrame(rows + copies + [(5000 + i, " ".join(fresh())) for i in range(150)], "doc_id long, text string")
    kept = {r.doc_id for r in simhash.keep_one(df).collect()}
    assert kept >= {i for i, _ in rows} | {5000 + i for i in range(150)}
    similar = [10 * len(x & y) >= 8 * len(x | y) for (_, t), (_, u) in zip(rows, copies) for x, y in [(brute_shingles(t), brute_shingles(u))]]
    assert sum(similar) > 100 and not any(i in kept for (i, _), s in zip(copies, similar) if s)


def test_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (3, "a b c d"), (None, "q r s t u")], "doc_id long, text string")
    assert sorted(simhash.near_duplicates(df).select("doc_id", "component_id").collect(), key=str) == sorted([(None, 3), (None, 3), (3, 3), (None, None)], key=str)
    assert sorted((r.doc_id or 0, r.text) for r in simhash.keep_one(df).collect()) == [(0, "q r s t u"), (3, "a b c d")]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 200)}


def test_rounds_of_a_small_graph_are_few_tasks(spark):
    """However many partitions a shuffle has; the components are the same."""
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)]
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = components(spark.createDataFrame(edges, "u long, v long").repartition(60))
        assert {r.node: r.root for r in found.collect()} == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 200)}
        assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
