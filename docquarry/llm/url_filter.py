"""URL filters: a sort-merge range join of URLs with host and path rules.

A host's canonical key is its labels reversed, each ended by a dot
(``blog.example.net`` is ``net.example.blog.``), so the host and its subdomains
are one interval of keys.  URLs and rules are dealt to ranges of keys; a rule
goes to every range its interval meets, which adds at most the rules that hold
for a range's first key.  In each range the sorted rows are swept once with a
stack of the active, nested rules.  Ranges are split by a hash after the key,
so a host with a third of the rows spreads over many ranges.

Among the rules that fit, the longest host and path together wins; then the
longer host; then block before allow.

Defined results: a null URL or one without ``://`` has an empty host and path,
and no rule fits it; a rule needs its whole path as a prefix, so an empty path
fits no rule whose path is ``/``; repeated rows give repeated rows; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches

#: The rules of the registered query, as (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

#: Keys sampled for the borders of ranges, about, and the most ranges.
SAMPLE, MOST_RANGES = 10_000, 2048


def _rest(url: Column) -> Column:
    """What follows the first ``://``, or null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), "^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(host: Column) -> Column:
    """Reversed labels, each ended by a dot; an empty host has an empty key."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def borders(keyed: DataFrame, ranges: int) -> list[str]:
    """At most ``ranges - 1`` borders between ranges of about equal size, from about ``SAMPLE`` sort keys, taken by hash."""
    share = min(1.0, SAMPLE / max(keyed.count(), 1))
    drawn = keyed.where(F.shiftrightunsigned(F.xxhash64("sort_key"), 33) < int(share * (1 << 31)))
    sample = sorted(r[0] for r in drawn.select("sort_key").collect())
    return [sample[len(sample) * i // ranges] for i in range(1, ranges)] if sample else []


class Sweep:
    """The stack of rules whose key is a prefix of the current key."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, dict[str, tuple[int, int, str]], list[int]]] = []

    def move(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def rule(self, key: str, host: str, path: str, verdict: str) -> None:
        self.move(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, {}, []))
        _, paths, lengths = self.stack[-1]
        if path not in paths or verdict == "block":
            paths[path] = (len(host) + len(path), len(host), verdict)
        if len(path) not in lengths:
            lengths.append(len(path))

    def best(self, key: str, path: str) -> tuple[str | None, str | None]:
        self.move(key)
        found = None
        for own, paths, lengths in self.stack:
            for n in lengths:
                if n <= len(path) and (hit := paths.get(path[:n])) and (found is None or hit[:2] > found[0][:2]):
                    found = hit, own, path[:n]
        if not found:
            return None, None
        (_, _, verdict), own, path = found
        return ".".join(reversed(own[:-1].split("."))) + path, verdict


def rule_frame(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def judge_urls(df: DataFrame, rules: DataFrame, *, id_column: str = "page_id", url_column: str = "url", default: str = "allow", ranges: int | None = None) -> DataFrame:
    """``id, host, path, rule, verdict`` for each row of ``df``; ``rules`` has host, path, verdict."""
    spark = df.sparkSession
    bound_batches(spark, 4096)
    ranges = min(MOST_RANGES, ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    urls = df.select(df[id_column].alias("id"), host_of(df[url_column]).alias("host"), path_of(df[url_column]).alias("path"))
    urls = urls.withColumn("key", key_of(F.col("host"))).withColumn("sort_key", F.concat("key", F.lit(" "), F.hex(F.xxhash64("path", "id"))))
    edges = borders(urls, ranges)

    @F.pandas_udf("int")
    def range_of(keys):
        return keys.map(lambda k: bisect_right(edges, k))

    # '/' is the first character after '.': a rule's interval ends before its key with that as its last.
    rules = rules.select("host", "path", "verdict").withColumn("key", key_of(F.col("host")))
    last = F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("/"))
    spread = rules.withColumn("part", F.explode(F.sequence(range_of(F.col("key")), range_of(last))))
    null = F.lit(None)
    rows = urls.select(range_of("sort_key").alias("part"), "key", F.lit(1).alias("kind"), "id", "host", "path", null.cast("string").alias("verdict")).unionByName(
        spread.select("part", "key", F.lit(0).alias("kind"), null.cast(dict(urls.dtypes)["id"]).alias("id"), "host", "path", "verdict")
    )
    rows = rows.repartition(ranges, "part").sortWithinPartitions("part", "key", "kind")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, state = None, Sweep()
        for batch in batches:
            parts, keys, kinds, _, hosts, paths, verdicts = (c.to_pylist() for c in batch.columns)
            at, names, said = [], [], []
            for i, key in enumerate(keys):
                if parts[i] != part:
                    part, state = parts[i], Sweep()
                if kinds[i] == 0:
                    state.rule(key, hosts[i], paths[i], verdicts[i])
                else:
                    name, verdict = state.best(key, paths[i])
                    at.append(i)
                    names.append(name)
                    said.append(verdict or default)
            if at:
                own = batch.take(pa.array(at, pa.int32()))
                yield pa.RecordBatch.from_arrays([own.column(3), own.column(4), own.column(5), pa.array(names, pa.string()), pa.array(said, pa.string())], [id_column, "host", "path", "rule", "verdict"])

    return rows.mapInArrow(sweep, f"`{id_column}` {dict(urls.dtypes)['id']}, host string, path string, rule string, verdict string")
