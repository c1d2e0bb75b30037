"""Texts whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more: an exact prefix-filter join.

*Shared shingles.*  Every distinct text's shingles are dealt out by hash, packed, and
counted: how many texts hold each.  One that a single text holds can't be in a
common part, and goes no further; so a text whose other shingles are too few for
0.8 with any text is done, which most are.

*Prefixes.*  A text's shingles are ordered by the number of texts that hold them, the
rarest (its own) first.  Of n shingles the first n - ceil(0.8 n) + 1 are its prefix:
two texts above the threshold share a shingle of both prefixes, and from the places
of the first such one, and the sizes, follows how much they can share at most.
Texts meet at the shared shingles of their prefixes, so mostly at rare ones.

*Links.*  Of the texts that meet, each is compared with one of them first, and, where
several components still meet, with another one; that links
a large group of copies without its pairs.  Where texts of several components meet
after that, all outside the largest one there are held against all others: the smaller text of a pair
within the first ninth of its shingles, as it must share eight ninths of them with a
text that isn't smaller.  Of these pairs most are ruled out by a bitmap of each set's
parities: bits that differ are shingles that one of both sets lacks, so the number of
them bounds the common part from above, and no pair above the threshold is lost.  Up to
some 2000 shingles the bound is close; for larger sets it tells less.  The texts of a
shingle are one call (more than ``MEMBERS`` of them are dealt into parts, and each two
parts are a call), and a call gives a spanning forest of its pairs that are left, not
the pairs.  These are compared exactly, over both whole sets.  Where all of a forest are
above the threshold, nothing else of that call can change the components.  Where some
are not, the call gives another forest, without them and with some more pairs of each
text, 16 times as many each round: a call that refutes all it gives has soon given all
its pairs, others end after a round or two.

Hashes have 40 bits besides their bucket's number; buckets grow in number with the
texts' bytes, not with a session's partitions: each names its texts, so many small ones
would hold more names than shingles.  A bucket's shingles are counted in some turns, so
a task holds those of one turn.  A hash that two shingles share makes a rare shingle seem less rare to all
texts alike, and is next to never in two texts that are compared.

Defined results: equal texts are one; a text of one to four words has one shingle, all
of it; a text without words is in no pair; an empty table gives no links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, by_bytes, cut, small, utf8
from .components import components

SHINGLE, SEED = 5, 42
#: Shingles that a task deals out together; bits of a hash in its bucket.
HELD, BITS = 1 << 20, 40
#: Texts dealt out together, at most: their numbers have 16 bits.
TEXTS = 1 << 16
#: Bytes of text a bucket, and buckets at least; turns in which a task counts its bucket's shingles.
BUCKET, BUCKETS, TURNS = 16 << 20, 12, 4

PACKED = "bucket int, shingles binary, texts binary, keys binary, sizes binary"
SHARED = "key long, size int, shingles binary, counts binary"
SETS = "key long, size int, alone int, shingles array<long>, prefix array<long>, parity array<long>"
#: Bits of a set's parities.
PARITY = 1024
#: Texts in one call, about; times more pairs of a text from round to round.
MEMBERS, MORE = 8192, 16
MET = "shingle long, p int, q int, u long, v long"


def shingles(text: bytes) -> np.ndarray:
    """Hashes of the distinct shingles of a text (A-Z lower-cased, words between ASCII white space)."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    return np.unique(np.array([digest(b" ".join(x), SEED) for x in zip(*(words[k:] for k in range(SHINGLE)))], np.uint64))


def parity(found: np.ndarray) -> np.ndarray:
    """For each remainder of hashes modulo ``PARITY``, whether an odd number of them have it: two sets differ by as many hashes at least as these by bits."""
    odd = np.bincount(found.view(np.uint64) % np.uint64(PARITY), minlength=PARITY) % 2
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def needed(size: int) -> int:
    """Shingles that a text must share to reach the threshold with any other."""
    return (4 * size + 4) // 5


def enough(shared: Column, size: Column, other: Column) -> Column:
    """Whether so many common shingles are a similarity of 0.8 for sets of these sizes."""
    return 9 * shared >= 4 * (size + other)


def _narrow(numbers: np.ndarray) -> bytes:
    """Numbers of ``BITS`` bits in as many bytes as they need."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : BITS // 8]).tobytes()


def _wide(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) * 8 // BITS, 8), np.uint8)
    out[:, : BITS // 8] = np.frombuffer(data, np.uint8).reshape(-1, BITS // 8)
    return out.view("<u8")[:, 0]


def _dealt(texts: DataFrame, buckets: int) -> DataFrame:
    """Shingles of distinct texts (``key, text``), packed by bucket."""

    def rows(held: list[tuple[int, np.ndarray]]) -> Iterator[tuple]:
        hashes = np.concatenate([x for _, x in held])
        sizes = np.array([len(x) for _, x in held], np.int32)
        texts = np.repeat(np.arange(len(held), dtype=np.uint16), sizes)
        keys = np.array([k for k, _ in held], np.int64)
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        numbers = (hashes // np.uint64(buckets)) & np.uint64((1 << BITS) - 1)
        for b in range(buckets):
            mine = order[ends[b] : ends[b + 1]]
            if len(mine):
                used, at = np.unique(texts[mine], return_inverse=True)
                yield b, _narrow(numbers[mine]), at.astype(np.uint16).tobytes(), keys[used].tobytes(), sizes[used].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), *[pa.binary()] * 4]
        held, size, seen = [], 0, set()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size
            if held:
                done = list(rows(held))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(kinds)], [c.split(" ")[0] for c in PACKED.split(", ")])
            held.clear()
            seen.clear()
            size = 0

        for batch in by_bytes(batches, "text"):
            for key, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                if key in seen:
                    continue
                found = shingles(text or b"")
                if len(found):
                    seen.add(key)
                    held.append((key, found))
                    size += len(found)
                    if size >= HELD or len(held) == TEXTS:
                        yield from flush()
        yield from flush()

    return texts.mapInArrow(run, PACKED)


def _shared(dealt: DataFrame, buckets: int) -> DataFrame:
    """Of each text the shingles that others hold too, with the numbers of texts that hold them; some rows a text."""
    names = [c.split(" ")[0] for c in SHARED.split(", ")]

    def repeated(held: list[tuple], turn: int) -> list[np.ndarray]:
        """Hashes of one turn that several texts hold, with the texts' keys and sizes and the numbers of texts."""
        numbers, texts = [], []
        for some, which, _, _ in held:
            wide = _wide(some)
            mine = wide % TURNS == turn
            numbers.append(wide[mine])
            texts.append(np.frombuffer(which, np.uint16)[mine])
        begins = np.cumsum([0, *map(len, numbers)])
        numbers = np.concatenate(numbers)
        order = np.argsort(numbers, kind="stable")
        numbers = numbers[order]
        same = numbers[1:] == numbers[:-1]
        same = (np.append(False, same) | np.append(same, False))[: len(numbers)]
        order, numbers = order[same], numbers[same]  # few: only these get the names of their texts
        keys, sizes = np.zeros(len(order), np.int64), np.zeros(len(order), np.int32)
        places = np.argsort(order, kind="stable")
        bounds = np.searchsorted(order[places], begins)
        for k, (_, _, keys_k, sizes_k) in enumerate(held):
            mine = places[bounds[k] : bounds[k + 1]]
            at = texts[k][order[mine] - begins[k]]
            keys[mine], sizes[mine] = np.frombuffer(keys_k, np.int64)[at], np.frombuffer(sizes_k, np.int32)[at]
        order = np.lexsort((keys, numbers))
        new = np.append(True, (numbers[order][1:] != numbers[order][:-1]) | (keys[order][1:] != keys[order][:-1]))[: len(order)]
        order = order[new]  # copies of a text come from several tasks
        numbers, keys, sizes = numbers[order], keys[order], sizes[order]
        starts = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])[: len(numbers)])
        each = np.diff(np.append(starts, len(numbers)))
        counts = np.repeat(each, each)
        good = counts > 1
        return [numbers[good], keys[good], sizes[good], counts[good].astype(np.int32)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = [], 0
        for batch in batches:
            for bucket, *row in zip(batch.column(0).to_pylist(), *batch.columns[1:]):
                held.append([x.as_buffer() for x in row])  # no copies: they are the whole bucket
        if not held:
            return
        numbers, keys, sizes, counts = map(np.concatenate, zip(*(repeated(held, turn) for turn in range(TURNS))))
        held.clear()
        order = np.argsort(keys, kind="stable")
        full = (numbers * np.uint64(buckets) + np.uint64(bucket)).view(np.int64)[order]
        keys, sizes, counts = keys[order], sizes[order], counts[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        ends = np.append(starts[1:], len(keys))
        for k in range(0, len(starts), 4096):
            a, b = starts[k : k + 4096], ends[k : k + 4096]
            columns = [pa.array(keys[a]), pa.array(sizes[a]), pa.array([full[x:y].tobytes() for x, y in zip(a, b)], pa.binary()), pa.array([counts[x:y].tobytes() for x, y in zip(a, b)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return dealt.repartitionById(buckets, F.col("bucket")).mapInArrow(run, SHARED)


def _sets(shared: DataFrame) -> DataFrame:
    """Texts that can reach the threshold: all their shared shingles, and those of the prefix (which ``alone`` of their own come before)."""
    kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 3]
    names = [c.split(" ")[0] for c in SETS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, size, held = None, 0, []

        def end() -> Iterator[tuple]:
            found, counts = np.concatenate([x for x, _ in held]), np.concatenate([c for _, c in held])
            alone, prefix = size - len(found), size - needed(size) + 1
            if alone < prefix:
                order = np.lexsort((found, counts))[: prefix - alone]
                yield now, size, alone, np.sort(found), found[order], parity(found)

        for batch in batches:
            done = []
            for key, of, found, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if key != now:
                    if held:
                        done += end()
                    now, size, held = key, of, []
                held.append((np.frombuffer(found, np.int64), np.frombuffer(counts, np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(kinds)], names)
        if held:
            done = list(end())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(kinds)], names)

    return shared.repartition("key").sortWithinPartitions("key").mapInArrow(run, SETS)


def similar_sets(texts: DataFrame) -> DataFrame:
    """``SETS`` of texts (``key, text``) that may have a partner."""
    bound_batches(texts.sparkSession)
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(BUCKETS, -(-size // BUCKET))
    return cut(_sets(_shared(_dealt(texts, buckets), buckets)))


def _possible(a: str, b: str) -> Column:
    """Whether two texts can reach the threshold if the shingle where they meet is the first that they share."""
    rest = lambda x: F.col(f"{x}.size") - F.col(f"{x}.place")
    return enough(F.least(rest(a), rest(b)), F.col(f"{a}.size"), F.col(f"{b}.size"))


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (``u, v``) of which it is true."""
    one = lambda n: sets.select(F.col("key").alias(n), F.col("size").alias(f"size_{n}"), F.col("shingles").alias(f"set_{n}"))
    joined = pairs.join(one("u"), "u").join(one("v"), "v")
    return joined.where(enough(F.size(F.array_intersect("set_u", "set_v")), F.col("size_u"), F.col("size_v"))).select("u", "v")


def _among(sets: DataFrame, keys: DataFrame) -> DataFrame:
    """The sets of some texts: most are in no pair, and aren't moved."""
    return sets.join(small(keys.distinct()), "key", "left_semi")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (``u, v``) of which it is true, of any of the sets."""
    pairs = cut(pairs)
    keys = pairs.select(F.col("u").alias("key")).unionByName(pairs.select(F.col("v").alias("key")))
    return _compared(pairs, _among(sets, keys))


def _pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    u, v = F.col(f"{a}.key"), F.col(f"{b}.key")
    return rows.where((u != v) & _possible(a, b)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()


def forest(texts: dict[str, np.ndarray], refuted: set[tuple[int, int]], more: int) -> list[tuple[int, int]]:
    """Pairs (larger key first) that span all pairs of texts that can reach the threshold, have different roots and aren't refuted; and of each text ``more`` of these.

    ``texts`` has ``key, size, place, root, held`` and the rows of ``parity`` of all that meet at a shingle.
    """
    order = np.argsort(texts["key"])  # calls with the same texts give the same pairs
    texts = {c: x[order] for c, x in texts.items()}
    key, size, held, parity = texts["key"], texts["size"], texts["held"], texts["parity"].view(np.uint64)
    rest, early = size - texts["place"], 9 * texts["place"] <= size
    rank = np.empty(len(key), np.int64)
    rank[np.lexsort((key, size))] = np.arange(len(key))
    _, root, sizes = np.unique(texts["root"], return_inverse=True, return_counts=True)
    label, open_ones = root.copy(), np.ones(len(key), bool)
    at = {k: i for i, k in enumerate(key.tolist())} if refuted else {}
    gone: dict[int, list[int]] = {}
    for u, v in refuted:
        if u in at and v in at:
            gone.setdefault(at[u], []).append(at[v])
            gone.setdefault(at[v], []).append(at[u])
    out = []
    for i in np.flatnonzero(root != sizes.argmax()).tolist():  # one of a pair is outside the largest component
        left = open_ones & (root != root[i]) if more else label != label[i]
        open_ones[i] = False
        left[gone.get(i, [])] = False
        # The smaller text of a pair shares eight ninths of its shingles or more, so it meets the other one early.
        left &= early | (rank > rank[i]) if early[i] else early & (rank < rank[i])
        x = np.flatnonzero(left)
        x = x[9 * np.minimum(rest[i], rest[x]) >= 4 * (size[i] + size[x])]
        if len(x):
            differ = np.bitwise_count(parity[x] ^ parity[i]).sum(axis=1, dtype=np.int64)
            x = x[9 * (held[i] + held[x] - differ) >= 8 * (size[i] + size[x])]
        if len(x):
            labels, first = np.unique(label[x], return_index=True)
            first = first[labels != label[i]]
            label[np.isin(label, labels)] = label[i]
            out += [(max(a, b), min(a, b)) for a, b in ((int(key[i]), int(key[j])) for j in x[np.union1d(first, np.arange(min(more, len(x))))])]
    return out


def _met(open_ones: DataFrame, sets: DataFrame, refuted: DataFrame | None, more: int) -> DataFrame:
    """``MET``: the forests of all calls, without pairs that were ``refuted`` there."""
    sketch = sets.select(F.col("key").alias("of"), F.size("shingles").alias("held"), "parity")
    rows = open_ones.join(sketch, F.col("x.key") == F.col("of")).select("shingle", "n", F.struct("x.*", "root", "held", "parity").alias("x"))
    parts = F.ceil(F.col("n") * 2 / MEMBERS).cast("int")
    one, other = F.pmod(F.xxhash64("x.key"), parts).cast("int"), F.explode(F.when(F.col("n") > MEMBERS, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.lit(0))))
    rows = rows.withColumn("p", F.when(F.col("n") > MEMBERS, one).otherwise(0)).withColumn("q", other)
    rows = rows.select("shingle", F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q"), "x")
    calls = rows.groupBy("shingle", "p", "q").agg(F.collect_list("x").alias("texts"))
    if refuted is None:
        calls = calls.withColumn("refuted", F.expr("CAST(array() AS array<struct<u:long,v:long>>)"))
    else:
        pairs = refuted.groupBy("shingle", "p", "q").agg(F.collect_list(F.struct("u", "v")).alias("refuted"))
        calls = calls.join(pairs, ["shingle", "p", "q"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                call = batch.slice(k, 1)
                found = call.column("texts").flatten()
                texts = dict(zip((f.name for f in found.type), found.flatten()))
                parity = texts.pop("parity").flatten().to_numpy().reshape(-1, PARITY // 64)
                gone = {(x["u"], x["v"]) for x in call.column("refuted").to_pylist()[0] or ()}
                pairs = forest({c: x.to_numpy().astype(np.int64) for c, x in texts.items()} | {"parity": parity}, gone, more)
                if pairs:
                    same = [call.column(c).to_numpy().repeat(len(pairs)) for c in ("shingle", "p", "q")]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, same), *(pa.array(x, pa.int64()) for x in zip(*pairs))], [c.split(" ")[0] for c in MET.split(", ")])

    return calls.mapInArrow(run, MET)


def _settled(places: DataFrame, found: DataFrame, sets: DataFrame) -> DataFrame:
    """``found`` with the links of all texts that still meet in several components."""
    refuted, more = None, 0
    while True:
        met = cut(_met(_open(places, found), sets, refuted, more))
        pairs = met.select("u", "v").distinct()
        true = cut(_compared(pairs, sets) if more else _verified(pairs, sets))
        found = _joined(found, true)
        wrong = cut(met.join(small(true), ["u", "v"], "left_anti"))
        if wrong.isEmpty():
            return found
        # Calls whose forests are true are done; the others go on, without the pairs that are not.
        places = cut(places.join(small(wrong.select("shingle").distinct()), "shingle", "left_semi"))
        sets = cut(_among(sets, places.select("x.key")))
        refuted = wrong if refuted is None else cut(refuted.unionByName(wrong))
        more = max(more, 1) * MORE


def linked(texts: DataFrame, links: DataFrame) -> DataFrame:
    """``node, root`` of the components that links of texts (``u, v``, keys) and all pairs above the threshold make; roots have no row."""
    sets = similar_sets(texts)
    places = sets.select("key", "size", "alone", F.posexplode("prefix").alias("at", "shingle")).select("shingle", F.struct("key", "size", (F.col("alone") + F.col("at")).alias("place")).alias("x"))
    places = cut(places)
    found = components(links.select("u", "v").unionByName(_verified(_stars(places, 0), sets)))
    found = _joined(found, _verified(_stars(_open(places, found), 1), sets))
    return _settled(places, found, sets)


def _stars(places: DataFrame, turn: int) -> DataFrame:
    """One text of each shingle with all that meet there, but those of its own ``root`` if that is known: the same one wherever it occurs."""
    known = [c for c in ("root",) if c in places.columns]
    first = places.groupBy("shingle").agg(F.min(F.struct(F.xxhash64(F.lit(turn), "x.key").alias("order"), "x", *known)).alias("c"), F.count("*").alias("n")).where("n > 1")
    met = places.join(first, "shingle")
    met = met.where("root <> c.root") if known else met
    return _pairs(met.select("x", F.col("c.x").alias("y")), "x", "y")


def _open(places: DataFrame, found: DataFrame) -> DataFrame:
    """The places of shingles where several components meet, with their ``root`` and the number ``n`` of texts there."""
    known = found.select(F.col("node").alias("of"), F.col("root").alias("top"))
    rooted = cut(places.join(known, F.col("x.key") == F.col("of"), "left").select("shingle", "x", F.coalesce("top", "x.key").alias("root")))
    parts = rooted.groupBy("shingle", "root").agg(F.count("*").alias("n")).groupBy("shingle").agg(F.sum("n").alias("n"), F.count("*").alias("parts"))
    return rooted.join(parts.where("parts > 1").select("shingle", "n"), "shingle")


def _joined(found: DataFrame, more: DataFrame) -> DataFrame:
    """Components with further links between their texts."""
    more = cut(more)
    if more.isEmpty():
        return found
    return components(found.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more))
