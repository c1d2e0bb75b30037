"""Mixing sources to target weights by a time-varying curriculum, in SQL functions alone.

Targets.  Sources share ``share`` of all words by weight; a source's target
stops at ``most`` times its own words, and what it can't take is shared again by
weight until none is above.  In closed form the targets are
``min(cap, level * weight)``: with sources sorted by cap over weight, the level
follows from running sums.

Positions.  Each source has a schedule of weights over training time 0..1
(knots, straight between them).  Its integral is the source's cumulative demand
for words; a document stands where that demand reaches the words of the
documents before it, so inverting the integral (a quadratic between two knots)
gives its training position.  Passes over a source follow each other.  The
result is range-sorted by position.

The words before a document are a sum over a hash order within its source, in
two levels: within a hash bucket by a window, and over buckets by a window on
the buckets' totals.  Buckets are split by more hash digits as rows grow, so a
source with a third of all rows is many windows, never one.

Defined results: null text has size 0; null sources are one source, the last;
a source without words has target 0; repeated rows are documents of their own;
an empty table gives an empty table; the plan needs no unique ids, but rows that
are equal in id, text and source share one window; other columns, whatever their
names, are ignored by ``mix`` and kept by ``mixed_rows``.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, own, sums_before

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Schedules of the sources in turn, as (time, weight) knots: early, even, late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.25), (0.5, 0.75), (1.0, 2.0)))
#: Rows that a window of one hash bucket should hold, about.
BUCKET_ROWS = 20_000
#: Bytes of text in one range of positions, about.
PART_BYTES = 64 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def narrow_rows(df: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    """``id, size, key, hash`` of each row: its words, its source's key and a hash that orders it."""
    return df.select(df[id_column].alias("id"), *_derived(df, id_column, text_column, source_column, ("size", "key", "hash")))


def _derived(df: DataFrame, id_column: str, text_column: str, source_column: str, names: tuple[str, ...]) -> list[Column]:
    key = F.when(df[source_column].isNull(), "n").otherwise(F.concat(F.lit("s"), df[source_column].cast("string")))
    text = F.coalesce(df[text_column], F.lit(""))
    digest = F.md5(F.concat(F.coalesce(df[id_column].cast("string"), F.lit("")), F.lit(" "), text))
    return [c.alias(name) for name, c in zip(names, (word_count(df[text_column]), key, digest))]


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``key, source_size, rank, target`` from a row of (``key``, ``source_size``) for each source.

    Ranks and running sums come from sorted ranges, so sources may be as many as hosts; the driver sees totals alone.
    """
    name = [F.col("key") == "n", F.col("key")]  # the null source is the last
    ranked = sums_before(sizes, name, {"rank": F.lit(1).cast("long")}).withColumns(
        {
            "weight": F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")),
            "cap": F.col("source_size") * float(most),
        }
    )
    ranked = cut(ranked)
    words, weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    order = [F.col("cap") / F.col("weight"), F.col("rank")]
    filled = sums_before(ranked, order, {"cap_before": F.col("cap"), "weight_before": F.col("weight")})
    level = (F.lit(float(words or 0) * float(share)) - F.col("cap_before")) / (F.lit(float(weight or 0)) - F.col("weight_before"))
    # The first source that its cap doesn't stop sets the level of all that follow.
    free = filled.withColumn("level", level).where("cap / weight > level")
    found = free.agg(F.min_by("level", F.struct(*order))).first()[0]
    target = F.col("cap") if found is None else F.least("cap", F.lit(found) * F.col("weight"))
    return ranked.select("key", "source_size", "rank", target.alias("target"))


def invert(fraction: Column, knots: tuple) -> Column:
    """The time at which the integral of the schedule has reached ``fraction`` of its whole."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
    total, done, out = sum(areas), 0.0, None
    for k, ((t, v), (u, w), area) in enumerate(zip(knots, knots[1:], areas)):
        slope = (w - v) / (u - t)
        rest = fraction * total - done
        root = F.sqrt(F.greatest(F.lit(v * v) + rest * (2 * slope), F.lit(0.0)))
        time = F.least(F.lit(t) + F.when(rest > 0, rest * 2 / (root + v)).otherwise(0.0), F.lit(u))
        last = k == len(areas) - 1
        case = (fraction * total <= done + area) | F.lit(last)
        out = F.when(case, time) if out is None else out.when(case, time)
        done += area
    return out


def scheduled(rank: Column, fraction: Column, schedules: tuple = SCHEDULES) -> Column:
    out = None
    for k, knots in enumerate(schedules):
        case = rank % len(schedules) == k
        out = F.when(case, invert(fraction, knots)) if out is None else out.when(case, invert(fraction, knots))
    return out


def plan(narrow: DataFrame, *, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``narrow`` rows with their place in their source: words before them, the source's words, target and rank, whole passes and the rest."""
    # Totals by the finest bucket serve for the sources as well; their number is bounded by digits.
    rows = narrow.count()
    digits = min(6, max(2, ceil(log(max(rows, 1) / BUCKET_ROWS, 16)) if rows > BUCKET_ROWS else 2))
    narrow = narrow.withColumn("bucket", F.substring("hash", 1, digits))
    totals = cut(narrow.groupBy("key", "bucket").agg(F.sum("size").alias("words")))
    sources = targets(totals.groupBy("key").agg(F.sum("words").alias("source_size")), weights, share, most)
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0).cast("long"))).drop("words").join(sources, "key")
    within = Window.partitionBy("key", "bucket").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    placed = narrow.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0).cast("long")))
    total = F.floor(F.round("target", 6) + 0.5)  # an exact half is one in any order of sums
    return (
        placed.join(offsets, ["key", "bucket"])
        .withColumn("start", F.col("offset") + F.col("within"))
        .withColumn("total", total)
        .withColumn("passes", F.when(F.col("source_size") > 0, F.expr("total div source_size")).otherwise(F.lit(0).cast("long")))
        .withColumn("rest", F.col("total") - F.col("passes") * F.col("source_size"))
        .drop("bucket", "offset", "within")
    )


def _position(start: Column) -> Column:
    return scheduled(F.col("rank"), start / F.greatest(F.col("total"), F.lit(1)))


def mix(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **how) -> DataFrame:
    """``id, size, source_size, target, taken, position`` for each row, sorted by position.

    ``taken`` are the words that the mix takes of the row: whole passes over the
    source, and of the last pass what its target leaves; the row in which the
    target is reached gives its first words alone.  ``position`` is that of the
    row's first word, null if none is taken.
    """
    narrow = cut(narrow_rows(df, id_column, text_column, source_column))
    rest = F.least(F.greatest(F.col("rest") - F.col("start"), F.lit(0)), F.col("size"))
    return (
        plan(narrow, **how)
        .withColumn("taken", F.col("passes") * F.col("size") + rest)
        .withColumn("position", F.when(F.col("taken") > 0, _position(F.col("start"))))
        .orderBy(F.col("position").asc_nulls_last(), "hash")
        .select(F.col("id").alias(id_column), "size", "source_size", "target", "taken", "position")
    )


def mixed_rows(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", most: float = MOST, **how) -> DataFrame:
    """``df``'s rows as often as the mix takes them, whole, in the order of training.

    A row is in the last pass if its middle is within what the target leaves.
    Places are worked out on narrow rows.  Texts meet them once, by hash, and go
    straight to the range of positions they belong to: the ranges' borders are
    known by then, so no text is read for a sample of them.  Rows with equal
    ids, texts and sources share their places, one each.
    """
    size = F.coalesce(F.octet_length(df[text_column]), F.lit(0))
    narrow = cut(df.select(*_derived(df, id_column, text_column, source_column, ("size", "key", "hash")), size.cast("long").alias("bytes")))
    # Equal rows are told apart by a number, on both sides of the join.
    alike = narrow.groupBy("key", "hash").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    copies = F.col("passes") + (2 * F.col("start") + F.col("size") < 2 * F.col("rest")).cast("long")
    turn = F.row_number().over(Window.partitionBy("key", "hash").orderBy("start"))
    placed = (
        plan(narrow, most=most, **how)
        .withColumn("turn", F.lit(1) if alike else turn)
        .withColumn("pass", F.explode(F.when(copies > 0, F.sequence(F.lit(0).cast("long"), copies - 1))))
        .withColumn("position", _position(F.col("start") + F.col("pass") * F.col("source_size")))
        .select("key", "hash", "turn", "position")
    )
    # Ranges of positions with about as many rows each, and about PART_BYTES of text; the narrow rows are sorted for them, the texts aren't.
    held = narrow.agg(F.sum("bytes")).first()[0] or 0
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, ceil(held * most / PART_BYTES))
    ranged = cut(placed.repartitionByRange(wanted, "position", "hash").withColumn("part", F.spark_partition_id()))
    parts = ranged.agg(F.coalesce(F.max("part"), F.lit(0)) + 1).first()[0]
    key, digest, place, part, position, number = own("key", "hash", "place", "part", "position", "turn")
    lists = ranged.groupBy("key", "hash", "turn").agg(F.collect_list(F.struct("part", "position")).alias(place))
    lists = lists.select(F.col("key").alias(key + "p"), F.col("hash").alias(digest + "p"), F.col("turn").alias(number + "p"), place)
    derived = _derived(df, id_column, text_column, source_column, ("", key, digest))[1:]
    rows = df.select("*", *derived)
    rows = rows.withColumn(number, F.lit(1) if alike else F.row_number().over(Window.partitionBy(key, digest).orderBy(digest)))
    met = rows.join(lists, (F.col(key) == F.col(key + "p")) & (F.col(digest) == F.col(digest + "p")) & (F.col(number) == F.col(number + "p")))
    spread = met.withColumn(part, F.explode(place)).withColumns({position: F.col(f"{part}.position"), part: F.col(f"{part}.part")})
    return spread.repartitionById(parts, F.col(part)).sortWithinPartitions(position, digest).select(*df.columns)
