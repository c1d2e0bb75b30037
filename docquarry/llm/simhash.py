"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints have 64 bits over 3-word shingles (``STRICT``), or over 5-word ones
where one text of each group of near copies is kept (``CLOSE``); there an exact join
adds the texts that are similar by 0.8 and have fingerprints further apart.

For radius r the bits are dealt evenly to the nonzero vectors of {0,1}^(r+1),
and table v (each nonzero vector) keeps the bits whose vector has an odd product
with v.  Of any r bits some nonzero v is orthogonal to all of their vectors, so
two fingerprints within the radius agree on all bits that table v keeps: they
collide in some table for certain.  With radius 3 that is 15 tables of about 34
bits.

Only distinct fingerprints are hashed, so exact copies are one row.  A bucket
holds its fingerprints once; up to ``LIGHT`` of them are linked in one call.  A
larger bucket is split again, exactly: the bits the table leaves free are cut
into 10 blocks, two fingerprints within r bits agree on 10 - r of them, and each
choice of so many makes a sub-bucket with fewer free bits.  A sub-bucket of over
``MEMBERS`` is dealt into parts, and each two parts are a call, so no call holds
more.  Within a call only a spanning forest of the true links is emitted, not the
pairs, and components are found by star contraction on Spark tables.

Defined results: null and empty texts have fingerprint zero and are linked like
any other; repeated rows share a component; an empty table gives an empty
table; other columns are ignored, or kept by ``keep_one``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, by_bytes, cut, own, small, utf8
from .components import components
from .shingle_join import linked

BITS, SHINGLE, SEED, RADIUS = 64, 3, 42, 3


@dataclass(frozen=True)
class Likeness:
    """When two texts are linked: fingerprints over shingles of so many words within ``radius`` bits."""

    shingle: int = SHINGLE
    radius: int = RADIUS


STRICT, CLOSE = Likeness(), Likeness(5)
#: Fingerprints of a bucket linked in one call, whole; blocks of free bits in larger ones.
LIGHT, BLOCKS = 4096, 10
#: Fingerprints in one call, about.
MEMBERS = 8192


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text: 64 bits, as an unsigned number."""
    return _simhash((text or b"").lower().split(), shingle)  # bytes: A-Z and ASCII white space alone


def _simhash(words: list[bytes], shingle: int) -> int:
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        hashes = [digest(b" ".join(x), SEED) for x in zip(*(words[k:] for k in range(shingle)))]
    n = len(hashes)
    ones = np.zeros(BITS, np.int64)
    array = np.array(hashes, np.uint64)
    for start in range(0, n, 1 << 16):  # bounded memory for very long texts
        part = array[start : start + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", likeness: Likeness = STRICT) -> DataFrame:
    """``id, th, fp`` for each row: a hash of the text, and its fingerprint as a signed long."""
    bound_batches(df.sparkSession)
    narrow = df.select(df[id_column].alias("id"), F.xxhash64(df[text_column]).alias("th"), df[text_column].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            fps = np.array([fingerprint(text, likeness.shingle) for text in utf8(batch.column(2))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], ["id", "th", "fp"])

    return narrow.mapInArrow(run, f"id {dict(narrow.dtypes)['id']}, th long, fp long")


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The bits that each table keeps."""
    vectors = (1 << radius + 1) - 1
    return [sum(1 << i for i in range(bits) if bin((i % vectors + 1) & v).count("1") % 2) for v in range(1, vectors + 1)]


def block_masks(kept: int, blocks: int = BLOCKS, radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """For a table that keeps ``kept``: what each sub-table keeps besides, ``blocks - radius`` blocks of free bits."""
    free = [i for i in range(bits) if not kept >> i & 1]
    parts = [sum(1 << i for i in free[k::blocks]) for k in range(blocks)]
    return [sum(x) for x in combinations(parts, blocks - radius)]


def _signed(x: int) -> int:
    return x - (x >> 63 << 64)


def forest(members: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the links among members, by their places."""
    values = members.view(np.uint64)
    todo = np.arange(len(values))
    edges: list[tuple[int, int]] = []
    while len(todo):
        front, todo = todo[:1], todo[1:]
        while len(front) and len(todo):  # a search from each member: each is reached once
            near = np.bitwise_count(values[front[0]] ^ values[todo]) <= radius
            reached, todo = todo[near], todo[~near]
            edges += [(int(front[0]), int(x)) for x in reached]
            front = np.concatenate([front[1:], reached])
    return edges


def links(fps: DataFrame, likeness: Likeness = STRICT) -> DataFrame:
    """Edges ``u, v`` between distinct fingerprints (``fp``) that span the link graph."""
    bound_batches(fps.sparkSession)
    masks = covering_masks(likeness.radius)
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks)])
    keyed = fps.select("fp", F.explode(tables).alias("x")).select("fp", "x.t", "x.key")
    sizes = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    sized = keyed.join(sizes, ["t", "key"])
    # What the sub-tables keep: a fixed table of some thousands of masks.
    kept = [(t, s, _signed(x)) for t, m in enumerate(masks) for s, x in enumerate(block_masks(m, radius=likeness.radius))]
    kept = fps.sparkSession.createDataFrame(pa.table({"t": pa.array([x[0] for x in kept], pa.int32()), "s": pa.array([x[1] for x in kept], pa.int32()), "mask": pa.array([x[2] for x in kept], pa.int64())}))
    heavy = sized.where(F.col("n") > LIGHT).join(F.broadcast(kept), "t").select("fp", "t", "key", "s", F.col("fp").bitwiseAND(F.col("mask")).alias("sub"))
    counts = heavy.groupBy("t", "key", "s", "sub").agg(F.count("*").alias("m")).where("m > 1")
    parts = F.ceil(F.col("m") * 2 / MEMBERS).cast("int")
    one, other = F.pmod(F.xxhash64("fp"), parts).cast("int"), F.explode(F.when(F.col("m") > MEMBERS, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.lit(0))))
    heavy = heavy.join(counts, ["t", "key", "s", "sub"]).withColumn("p", F.when(F.col("m") > MEMBERS, one).otherwise(0)).withColumn("q", other)
    heavy = heavy.select("fp", "t", "key", "s", "sub", F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q"))
    light = sized.where(F.col("n") <= LIGHT).select("fp", "t", "key", F.lit(-1).alias("s"), F.lit(0).cast("long").alias("sub"), F.lit(0).alias("p"), F.lit(0).alias("q"))
    members = F.array_sort(F.collect_list("fp"))
    buckets = light.unionByName(heavy).groupBy("t", "key", "s", "sub", "p", "q").agg(members.alias("members")).where(F.size("members") > 1)

    @F.pandas_udf("array<struct<u:int,v:int>>")
    def span(fps: pd.Series) -> pd.Series:
        return pd.Series([forest(np.asarray(x, np.int64), likeness.radius) for x in fps])

    ends = buckets.select("members", F.explode(span("members")).alias("e"))
    return ends.select(F.col("members")[F.col("e.u")].alias("u"), F.col("members")[F.col("e.v")].alias("v")).distinct()


def near_duplicates(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", likeness: Likeness = STRICT) -> DataFrame:
    """``id, fingerprint, component_id`` for each row: the smallest id reachable over links."""
    prints = cut(fingerprints(df, id_column=id_column, text_column=text_column, likeness=likeness))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("first")  # null ids come last
    distinct = cut(prints.groupBy("fp").agg(first))
    roots = components(links(distinct, likeness))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    named = rooted.select("fp", "root").join(firsts, "root").select("fp", F.col("first.id").alias("component_id"))
    return prints.join(named, "fp").select(F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _text_links(prints: DataFrame, likeness: Likeness) -> DataFrame:
    """Links of texts by their fingerprints, ``u, v`` as text hashes: a text with the first of its fingerprint, and those with each other."""
    firsts = cut(prints.groupBy("fp").agg(F.min("th").alias("first")))
    same = prints.select("fp", "th").distinct().join(firsts, "fp").where("th <> first").select(F.col("th").alias("u"), F.col("first").alias("v"))
    named = lambda end: firsts.select(F.col("fp").alias(end), F.col("first").alias(f"{end}_th"))
    ends = links(firsts.select("fp"), likeness).join(named("u"), "u").join(named("v"), "v")
    return same.unionByName(ends.select(F.col("u_th").alias("u"), F.col("v_th").alias("v")))


def keep_one(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", likeness: Likeness = CLOSE) -> DataFrame:
    """``df`` with one row of each group of near copies, that with the smallest id; of equal rows one stays.

    Near copies are texts whose fingerprints are linked, and all texts whose sets of 5-word shingles are
    similar by 0.8 or more (``shingle_join``).
    """
    prints = cut(fingerprints(df, id_column=id_column, text_column=text_column, likeness=likeness))
    texts = df.select(F.xxhash64(df[text_column]).alias("key"), df[text_column].alias("text"))
    roots = linked(texts, _text_links(prints, likeness))
    row = F.struct(F.col("id").isNull().alias("none"), "id", "th")
    distinct = prints.groupBy("th").agg(F.min(row).alias("first"))
    rooted = distinct.join(roots, F.col("th") == F.col("node"), "left").select("first", F.coalesce("root", "th").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    key, hashed, row_hash = own("id", "th", "row_th")
    rows = df.withColumn(row_hash, F.xxhash64(df[text_column]))

    def among(wide: DataFrame, narrow: DataFrame, how: str) -> DataFrame:
        return wide.join(narrow, wide[id_column].eqNullSafe(narrow[key]) & (wide[row_hash] == narrow[hashed]), how)

    # The rows that go, and those that occur again, are found among ids and hashes.  They are few beside the others, so
    # an anti-join hands them to the texts, which stay where they are.
    keep = firsts.select(F.col("first.id").alias(key), F.col("first.th").alias(hashed), F.lit(True).alias("keep"))
    counted = prints.groupBy("id", "th").agg(F.count("*").alias("n"))
    told = counted.join(keep, counted["id"].eqNullSafe(keep[key]) & (counted["th"] == keep[hashed]), "left")
    odd = cut(told.where("keep IS NULL OR n > 1").select(F.col("id").alias(key), F.col("th").alias(hashed), F.col("keep").isNotNull().alias("again")))
    out = among(rows, small(odd.select(key, hashed)), "left_anti")
    again = small(odd.where("again").select(key, hashed))
    if not again.isEmpty():
        out = out.unionByName(among(rows, again, "left_semi").dropDuplicates([id_column, row_hash]))
    return out.drop(row_hash)
