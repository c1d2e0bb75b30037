"""Removal of repeated passages by suffix sorting with a difference cover.

A byte goes if it is covered by a string of ``WINDOW`` bytes that starts in two
places at least.  So suffixes need to be sorted by their first ``WINDOW`` bytes
only, and two neighbours in that order that agree in so many are a repetition.

*Sample.*  Positions whose residue lies in a difference cover are a sample: for
any two positions some shift below the modulus takes both into it.  Each sampled
position is named by its tuple, the bytes that a window holds after any such
shift (68 at every place of 12 of 133).  Names are dealt out and sorted; a name
in one place alone is dropped.  If two windows are equal, the tuples at their
common shift are, so only windows with a repeated tuple are left.

*Recursion.*  What is left is the same problem over the windows left, with a
cover of all positions: every one of their suffixes takes part, sampled or not.

*Merge.*  Windows meet in groups, by the least hash of the tuples that they
hold, which depends on their bytes alone.  Neighbouring windows mostly share it,
so a run of them travels as one string: its windows plus 199 bytes.  In a group
suffixes are sorted by their bytes, and neighbours' prefixes are compared.

Hashes only decide who meets; bytes decide what is equal, but in groups of over
``HOT`` strings: these are dealt out again by 128-bit names of each window.

Hot passages: equal tuples, and equal strings, are found within a task's memory
first, so what is said in a great many places leaves a task once, and its places
are known to be repeated there and then.  Equal texts are one text, named by MD5,
and all of it goes if it is as long as a window.  No task gathers more than a
share of the names, one text's ranges, or ``HOT`` strings.

Of tuples (triples, with the modulus 3) two thirds of all positions would be
sampled, which is some 18 bytes for each byte of text on disk; with the modulus
133 it is 9 of 100 positions.

Defined results: null text is empty; repeated rows and equal texts are
occurrences of each other; a text shorter than the window stays; null ids are
ids; an empty table gives an empty table; other columns, whatever their names,
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, by_bytes, cut, small, utf8
from ..scratch import new_folder

#: Bytes of a repeated string.
WINDOW = 200
#: Difference covers by their modulus (perfect difference sets).
COVERS = {1: (0,), 7: (0, 1, 3), 13: (0, 1, 3, 9), 31: (0, 1, 3, 8, 12, 18), 57: (0, 1, 3, 13, 32, 36, 43, 52), 133: (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)}
#: Samples named together in a task, windows looked at together, strings held together.
NAMED, LOOKED, HELD = 1 << 19, 1 << 18, 1 << 15
#: Windows of a string at most; strings of a group at most, beyond which it is dealt out by windows.
RUN, HOT = 256, 2000


@dataclass(frozen=True)
class Cover:
    """The sampled positions for a window: residues of a modulus, and the length of a tuple."""

    window: int
    modulus: int
    residues: tuple[int, ...]

    @classmethod
    def of(cls, window: int) -> Cover:
        """The widest cover whose tuples are at least half as long as its modulus."""
        modulus = max(m for m in COVERS if 2 * (window - m + 1) >= m)
        return cls(window, modulus, COVERS[modulus])

    @property
    def tuple(self) -> int:
        return self.window - self.modulus + 1

    def count(self, n: int) -> int:
        """Samples whose tuples lie within ``n`` bytes."""
        whole, rest = divmod(max(n - self.tuple + 1, 0), self.modulus)
        return whole * len(self.residues) + sum(r < rest for r in self.residues)

    def places(self, index: np.ndarray) -> np.ndarray:
        """Positions of samples by their numbers."""
        return index // len(self.residues) * self.modulus + np.array(self.residues)[index % len(self.residues)]


def union(pairs: np.ndarray) -> np.ndarray:
    """Half-open ranges (rows lo, hi) as disjoint ones in order; those that touch are one."""
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    ends = np.maximum.accumulate(pairs[:, 1])
    first = np.ones(len(pairs), bool)
    first[1:] = pairs[1:, 0] > ends[:-1]
    starts = np.flatnonzero(first)
    return np.stack([pairs[starts, 0], ends[np.append(starts[1:], len(pairs)) - 1]], axis=1)


def _distinct(batches: Iterable[pa.RecordBatch], least: int, *more: int) -> Iterator[tuple]:
    """``key, bytes`` and further columns of texts of at least ``least`` bytes (columns 0 and 1), one for equal texts of a batch."""
    for batch in by_bytes(batches, "text"):
        seen = set()
        for key, text, *rest in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), *(batch.column(k).to_pylist() for k in more)):
            if text is not None and len(text) >= least and key not in seen:
                seen.add(key)
                yield key, text, *rest


# Ranges of a text travel as packed pairs of positions.

RANGES = "key binary, pairs binary"


def _packed(keys: list[bytes], pairs: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([p.astype(np.int32).tobytes() for p in pairs], pa.binary())], ["key", "pairs"])


def _unpacked(pairs: bytes) -> np.ndarray:
    return np.frombuffer(pairs, np.int32).reshape(-1, 2).astype(np.int64)


def _by_key(keys: np.ndarray, pairs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Ranges of keys (rows of two numbers) as packed rows, one a key."""
    if not len(keys):
        return
    order = np.lexsort((pairs[:, 0], keys[:, 1], keys[:, 0]))
    keys, pairs = keys[order], pairs[order]
    starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
    parts = np.split(pairs, starts[1:])
    for at in range(0, len(parts), 4096):
        yield _packed([k.tobytes() for k in keys[starts[at : at + 4096]]], [union(p) for p in parts[at : at + 4096]])


def merged(ranges: DataFrame) -> DataFrame:
    """All ranges of each key in one row, disjoint and in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size = None, [], 0
        for batch in batches:
            keys, pairs = [], []
            for key, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != now:
                    if held:
                        keys.append(now)
                        pairs.append(union(np.concatenate(held)))
                    now, held, size = key, [], 0
                held.append(_unpacked(packed))
                size += len(held[-1])
                if size > 1 << 16:  # a text that many tasks tell of
                    held = [union(np.concatenate(held))]
                    size = 0
            yield _packed(keys, pairs)
        if held:
            yield _packed([now], [union(np.concatenate(held))])

    return ranges.repartition("key").sortWithinPartitions("key").mapInArrow(run, RANGES)


# Sample.

SAMPLES = "bucket int, names binary, numbers binary, keys binary, starts binary, firsts binary"


def _name_samples(texts: DataFrame, cover: Cover, buckets: int) -> DataFrame:
    """Names of the sampled tuples, packed by bucket.

    A row's entries are a name and the sample's number among those named together (-1: places that are in a row without
    names, as they are known to be repeated); ``keys``, ``starts`` and ``firsts`` say which text a number belongs to,
    and which of the text's samples it is.
    """
    digest, length = xxhash.xxh3_64_intdigest, cover.tuple

    def rows(pieces: list[tuple[bytes, int, np.ndarray]], shift: int) -> Iterator[tuple]:
        names = np.concatenate([p[2] for p in pieces])
        starts = np.concatenate([[0], np.cumsum([len(p[2]) for p in pieces])[:-1]])
        order = np.argsort(names, kind="stable")
        ordered = names[order]
        new = np.append(True, ordered[1:] != ordered[:-1])
        sizes = np.diff(np.append(np.flatnonzero(new), len(ordered)))
        names, numbers = ordered[new], np.where(sizes == 1, order[new], -1)
        known = np.sort(order[np.repeat(sizes > 1, sizes)])
        keys = np.frombuffer(b"".join(p[0] for p in pieces), np.uint64).reshape(-1, 2)
        firsts = np.array([p[1] for p in pieces])

        def row(bucket: int, names: np.ndarray, numbers: np.ndarray) -> tuple:
            used = np.unique(np.searchsorted(starts, numbers[numbers >= 0], "right") - 1)
            return bucket, names.tobytes(), numbers.astype(np.int32).tobytes(), keys[used].tobytes(), starts[used].astype(np.int64).tobytes(), firsts[used].astype(np.int64).tobytes()

        at = (names % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        ends = np.searchsorted(at[order], np.arange(buckets + 1))
        for b in range(buckets):
            mine = order[ends[b] : ends[b + 1]]
            if len(mine):
                yield row(b, names[mine], numbers[mine])
        if len(known):
            yield row(shift % buckets, names[:0], known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), *[pa.binary()] * 5]
        pieces, held, turns, seen = [], 0, 0, set()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, turns
            if held:
                done = list(rows(pieces, int.from_bytes(pieces[0][0][:4], "little")))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(kinds)], [c.split(" ")[0] for c in SAMPLES.split(", ")])
            pieces.clear()
            seen.clear()
            held, turns = 0, turns + 1

        for key, text in _distinct(batches, cover.window):
            if key in seen:
                continue
            seen.add(key)
            n = cover.count(len(text))
            for first in range(0, n, NAMED):
                places = cover.places(np.arange(first, min(first + NAMED, n)))
                names = np.fromiter((digest(text[s : s + length]) for s in places.tolist()), np.uint64, len(places))
                pieces.append((key, first, names))
                held += len(names)
                if held >= NAMED:
                    yield from flush()
        yield from flush()

    return texts.mapInArrow(run, SAMPLES)


def _repeated_samples(samples: DataFrame, cover: Cover, buckets: int) -> DataFrame:
    """Ranges of windows around the samples whose names are repeated, for each text (packed, some rows a text)."""
    before = cover.modulus - 1

    def places(row: list, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys (two numbers each) and positions of a row's samples."""
        keys, starts, firsts = np.frombuffer(row[3], np.uint64).reshape(-1, 2), np.frombuffer(row[4], np.int64), np.frombuffer(row[5], np.int64)
        text = np.searchsorted(starts, numbers, "right") - 1
        return keys[text], cover.places(numbers - starts[text] + firsts[text])

    def told(keys: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
        yield from _by_key(keys, np.stack([np.maximum(at - before, 0), at + 1], axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[1]:
                    rows.append(row)
                else:  # known to be repeated
                    yield from told(*places(row, np.frombuffer(row[2], np.int32).astype(np.int64)))
        if not rows:
            return
        names = np.concatenate([np.frombuffer(r[1], np.uint64) for r in rows])
        numbers = np.concatenate([np.frombuffer(r[2], np.int32) for r in rows])
        source = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[1]) // 8 for r in rows])
        rows = [(None, None, None, *r[3:]) for r in rows]
        order = np.argsort(names, kind="stable")
        names = names[order]
        same = np.append(False, names[1:] == names[:-1])
        same |= np.append(same[1:], False)  # a name that a task has in many places already is only news to others
        order, names = order[same], names[same]
        numbers, source = numbers[order].astype(np.int64), source[order]
        keys, at = np.zeros((len(names), 2), np.uint64), np.full(len(names), -1)
        for k in np.unique(source):
            mine = np.flatnonzero((source == k) & (numbers >= 0))
            keys[mine], at[mine] = places(rows[k], numbers[mine])
        # Copies of a text that other tasks have named are the same place: each place counts once, many places as many.
        order = np.lexsort((at, keys[:, 1], keys[:, 0], names))
        names, keys, at = names[order], keys[order], at[order]
        again = np.append(False, (names[1:] == names[:-1]) & (keys[1:] == keys[:-1]).all(axis=1) & (at[1:] == at[:-1]) & (at[1:] >= 0))
        names, keys, at = names[~again], keys[~again], at[~again]
        several = np.append(False, names[1:] == names[:-1])
        several |= np.append(several[1:], False)
        good = several & (at >= 0)
        yield from told(keys[good], at[good])

    return samples.repartitionById(buckets, F.col("bucket")).mapInArrow(run, RANGES)


def candidates(texts: DataFrame, cover: Cover) -> DataFrame:
    """``key, pairs``: ranges of the windows of each text (``key, text``) that hold a repeated tuple."""
    buckets = 2 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return merged(_repeated_samples(_name_samples(texts, cover, buckets), cover, buckets))


# Recursion and merge.

STRINGS = "least long, string binary, key binary, at int, windows int, many boolean, within boolean"
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xFF51AFD7ED558CCD)


def _tuple_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of each ``length`` bytes: differences of running sums, weighted by powers of an odd number, which has an inverse."""
    n = len(data)
    powers, inverse = np.full(n, _BASE), np.full(n, np.uint64(pow(int(_BASE), -1, 1 << 64)))
    powers[0] = inverse[0] = 1
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * np.cumprod(powers))])
        out = (sums[length:] - sums[:-length]) * np.cumprod(inverse)[: n - length + 1]
        out ^= out >> np.uint64(33)
        out *= _MIX
        return out ^ (out >> np.uint64(29))


def _least(hashes: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours: of what is left of a block, and of what is begun of the next."""
    n = len(hashes) - width + 1
    padded = np.full(-(-len(hashes) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(hashes)] = hashes
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    left = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(left[:n], ahead[width - 1 : width - 1 + n])


def _runs(text: bytes, lo: int, hi: int, cover: Cover) -> Iterator[tuple[int, int, int, bool]]:
    """``least, at, windows, within`` of runs of windows from lo to hi that share their least tuple; ``within``: the run holds that tuple twice."""
    for start in range(lo, hi, LOOKED):
        end = min(start + LOOKED, hi)
        hashes = _tuple_hashes(np.frombuffer(text, np.uint8, end - start + cover.window - 1, start), cover.tuple)
        least = _least(hashes, cover.modulus)
        edges = np.append(np.flatnonzero(np.append(True, least[1:] != least[:-1])), len(least))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            for c in range(a, b, RUN):
                d = min(c + RUN, b)
                yield int(least[c].view(np.int64)), start + c, d - c, np.count_nonzero(hashes[c : d + cover.modulus - 1] == least[c]) > 1


def _strings(texts: DataFrame, cover: Cover) -> DataFrame:
    """Runs of windows as strings (texts come with their ``pairs``).

    Strings that a task holds in several places are one row (``many``), and a row without a string for each place.
    """
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_()]
    names = [c.split(" ")[0] for c in STRINGS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        places, seen = 0, set()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal places
            rows = []
            for string, (least, within, *at) in held.items():
                rows.append((least, string, *at[0], len(string) - cover.window + 1, len(at) > 1, within))
                if len(at) > 1:
                    rows += [(None, None, *x, len(string) - cover.window + 1, True, False) for x in at]
            for k in range(0, len(rows), 8192):
                part = rows[k : k + 8192]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in part], t) for c, t in enumerate(kinds)], names)
            held.clear()
            seen.clear()
            places = 0

        for key, text, pairs in _distinct(batches, cover.window, 2):
            if key in seen:
                continue
            seen.add(key)
            for lo, hi in _unpacked(pairs).tolist():
                for least, at, windows, within in _runs(text, lo, min(hi, len(text) - cover.window + 1), cover):
                    held.setdefault(text[at : at + windows + cover.window - 1], [least, within]).append((key, at))
                    places += 1
                if places >= HELD:
                    yield from flush()
        yield from flush()

    return texts.mapInArrow(run, STRINGS)


def _compared(group: list[tuple], window: int) -> list[tuple[bytes, int, int]]:
    """``key, lo, hi`` of the repeated windows of strings (``string, key, at, many, within``) with one least tuple, that aren't known yet."""
    if len(group) == 1 and (group[0][3] or not group[0][4]):
        return []
    places: dict[bytes, set] = {}
    several, out = set(), []
    for string, key, at, many, _ in group:
        mine = places.setdefault(string, set())
        if many:
            several.add(string)
        else:
            mine.add((key, at))
    open_ones = []
    for string, mine in places.items():
        if string in several or len(mine) > 1:
            out += [(key, at, at + len(string) - window + 1) for key, at in mine]
        else:
            open_ones.append(string)
    if open_ones:  # sort the suffixes of all strings, and compare neighbours
        suffixes = sorted((s[k : k + window], n, k) for n, s in enumerate(places) for k in range(len(s) - window + 1))
        strings, found = list(places), {}
        for a, b in zip(suffixes, suffixes[1:]):
            if a[0] == b[0]:
                found.setdefault(a[1], set()).add(a[2])
                found.setdefault(b[1], set()).add(b[2])
        still = set(open_ones)
        for n, at in found.items():
            if strings[n] in still:
                (key, start), = places[strings[n]]
                ranges = union(np.array([(start + k, start + k + 1) for k in at]))
                out += [(key, lo, hi) for lo, hi in ranges.tolist()]
    return out


def _repeated_windows(strings: DataFrame, window: int) -> DataFrame:
    """``key, lo, hi`` of repeated windows: those known from the start, those of groups, and those of hot groups."""
    schema = "key binary, lo int, hi int"
    known = strings.where("string IS NULL").select("key", F.col("at").alias("lo"), (F.col("at") + F.col("windows")).alias("hi"))
    open_ones = strings.where("string IS NOT NULL")
    hot = small(open_ones.groupBy("least").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select(F.col("least").alias("hot")))

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            done = []
            for least, *rest in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if least != now:
                    done += _compared(held, window) if held else []
                    now, held = least, []
                held.append(tuple(rest))
            yield _triples(done)
        yield _triples(_compared(held, window) if held else [])

    columns = ("least", "string", "key", "at", "many", "within")
    rest = open_ones.join(hot, open_ones["least"] == hot["hot"], "left_anti").select(*columns)
    grouped = rest.repartition("least").sortWithinPartitions("least").mapInArrow(groups, schema)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "string", 1 << 20):
            rows = [(xxhash.xxh3_128_digest(s[k : k + window]), key, at + k, many) for _, s, key, at, many, _ in zip(*(c.to_pylist() for c in batch.columns)) for k in range(len(s) - window + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.binary(), pa.binary(), pa.int32(), pa.bool_()))], ["name", "key", "at", "many"])

    each = open_ones.join(hot, open_ones["least"] == hot["hot"], "left_semi").select(*columns).mapInArrow(windows, "name binary, key binary, at int, many boolean")
    place = F.struct("key", "at")
    again = each.groupBy("name").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.bool_or("many").alias("many")).where("many OR a <> b").select(F.col("name").alias("again"))
    dealt = each.where("NOT many").join(again, F.col("name") == F.col("again"), "left_semi").select("key", F.col("at").alias("lo"), (F.col("at") + 1).alias("hi"))
    return known.unionByName(grouped).unionByName(dealt)


def _triples(rows: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.binary(), pa.int32(), pa.int32()))], ["key", "lo", "hi"])


def _spans(windows: DataFrame, window: int) -> DataFrame:
    """Bytes that windows cover, packed rows of each key (several)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64).reshape(-1, 2)
                pairs = np.stack([batch.column(1).to_numpy().astype(np.int64), batch.column(2).to_numpy().astype(np.int64) + window - 1], axis=1)
                yield from _by_key(keys, pairs)

    return windows.mapInArrow(run, RANGES)


def repeated_spans(df: DataFrame, *, text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """``key, pairs``: the byte ranges to be removed of each distinct text that has any; ``key`` is the text's MD5."""
    bound_batches(df.sparkSession)
    cover = Cover.of(window)
    texts = df.select(F.unhex(F.md5(df[text_column])).alias("key"), df[text_column].alias("text")).where(F.octet_length("text") >= window)
    ranges = small(candidates(texts, cover).withColumnRenamed("key", "of"))
    folder = new_folder(df.sparkSession, "strings")
    _strings(texts.join(ranges, F.col("key") == F.col("of")).select("key", "text", "pairs"), cover).write.parquet(f"{folder}/runs")
    windows = _repeated_windows(df.sparkSession.read.parquet(f"{folder}/runs"), window)
    copies = texts.select("key", F.octet_length("text").alias("n")).groupBy("key").agg(F.max("n").alias("n"), F.count("*").alias("copies")).where("copies > 1")
    windows = windows.unionByName(copies.select("key", F.lit(0).alias("lo"), (F.col("n") - window + 1).alias("hi")))
    return merged(_spans(windows, window))


def remove_repeats(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes, binary) for each row."""
    kind = dict(df.dtypes)[id_column]
    spans = small(repeated_spans(df, text_column=text_column, window=window).withColumnRenamed("key", "of"))
    rows = df.select(df[id_column].alias("id"), F.coalesce(df[text_column], F.lit("")).alias("text"), F.unhex(F.md5(df[text_column])).alias("key"))
    rows = rows.join(spans, F.col("key") == F.col("of"), "left").select("id", "text", "pairs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            out = []
            for text, packed in zip(utf8(batch.column(1)), batch.column(2).to_pylist()):
                pairs = _unpacked(packed).tolist() if packed else []
                kept, at = [], 0
                for lo, hi in pairs:
                    kept.append(text[at:lo])
                    at = hi
                kept.append(text[at:])
                out.append((len(text), sum(hi - lo for lo, hi in pairs), len(pairs), b"".join(kept)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary())))], ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary").withColumnRenamed("id", id_column)


def report(df: DataFrame, *, id_column: str = "doc_id", **how) -> DataFrame:
    """``remove_repeats`` with a digest in place of the remaining bytes."""
    return remove_repeats(df, id_column=id_column, **how).select(id_column, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
