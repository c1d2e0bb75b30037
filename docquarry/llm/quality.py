"""Quality rules with cross-document line frequency.

Each text is measured once (whole, in an Arrow function): word and symbol
counts, repeated lines, words in repeated 8-word windows, and its distinct
normalised lines as 64-bit hashes with the words they hold.  Everything that
crosses documents then runs in the JVM on those narrow rows: the distinct
documents of each host that hold a line are counted, lines above the host's
limit are removed (``judge`` counts their words, ``cleaned`` takes them out of the
texts), and a document that loses most of its words is rejected.

Documents with the same text on the same host are one document to the count,
so a group of exact copies does not turn its own lines into boilerplate.  A
host's limit comes from the distribution of its lines: ``spread`` times the mean
number of documents that hold one of its distinct lines, and ``min_documents``
at least.  The mean grows slowly with what a host repeats, so a limit is not
wholly free of a host's size.  Eleven different texts of a host that hold one line
make it boilerplate, however large the host is: a line that is written anew
seldom comes up twice.

Defined results: null text has no words (base fails); a null host is a host of
its own; repeated rows get equal verdicts; an empty table gives an empty table;
other columns, whatever their names, are ignored, or kept by ``cleaned``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, by_bytes, cut, own, small, utf8

#: The window whose repeats count, in words.
WINDOW = 8
#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
#: A host's limit: so many times the mean of its lines, so many documents at least; and the share of words that a document may lose.
SPREAD, MIN_DOCUMENTS, MAX_REMOVED = 10, 10, 0.5

_POWERS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(WINDOW)], dtype=np.uint64)


def repeat_words(words: list[bytes]) -> int:
    """Words in windows of ``WINDOW`` words that occur twice or more; exact."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        rolled += hashes[k : k + n] * _POWERS[k]
    rolled.sort()
    if not (rolled[1:] == rolled[:-1]).any():  # equal windows have equal sums: none repeats
        return 0
    ids: dict[bytes, int] = {}
    classes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    span = 1
    while span < WINDOW:  # classes of twice the span, exactly: no hashes here
        pairs = classes[:-span] * (int(classes.max()) + 1) + classes[span:]
        classes = np.unique(pairs, return_inverse=True)[1]
        span *= 2
    repeated = np.flatnonzero(np.bincount(classes)[classes] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, repeated, 1)
    np.add.at(edge, repeated + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def line_key(parts: list[bytes]) -> int:
    """Hash of a line's normalised form, as a signed number."""
    key = xxhash.xxh3_64_intdigest(b" ".join(parts).lower())
    return key - (key >> 63 << 64)


def measure_text(text: bytes | None) -> tuple:
    """Base counts of one text, the text's key, and its distinct normalised lines with their words."""
    text = text or b""
    words = text.split()
    lines: dict[int, int] = {}
    raw = []
    for line in text.split(b"\n"):
        if parts := line.split():
            raw.append(line)
            key = line_key(parts)
            lines[key] = lines.get(key, 0) + len(parts)
    return (
        len(words),
        len(b"".join(words).decode("utf-8", "replace")),
        sum(map(text.count, SYMBOLS)),
        len(raw) - len(set(raw)),
        repeat_words(words),
        xxhash.xxh3_128_digest(text),
        list(lines),
        list(lines.values()),
    )


def _host(host: Column) -> Column:
    return F.when(host.isNull(), "null").otherwise(F.concat(F.lit("host "), host.cast("string")))


def measure(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source") -> DataFrame:
    """One narrow row of measures for each row of ``df``."""
    bound_batches(df.sparkSession)
    narrow = df.select(df[id_column].alias("id"), _host(df[host_column]).alias("host"), df[text_column].alias("text"))
    fields = [pa.field(x, pa.int64()) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    fields += [pa.field("text_key", pa.binary()), pa.field("lines", pa.list_(pa.int64())), pa.field("line_words", pa.list_(pa.int64()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            columns = list(zip(*map(measure_text, utf8(batch.column(2)))))
            arrays = [pa.array(x, f.type) for x, f in zip(columns, fields)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["id", "host", *(f.name for f in fields)])

    schema = f"id {dict(narrow.dtypes)['id']}, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, text_key binary, lines array<long>, line_words array<long>"
    return narrow.mapInArrow(run, schema)


def common_lines(measured: DataFrame, *, spread: int = SPREAD, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``host, line`` of lines in more distinct documents of the host than its limit."""
    texts = measured.select("host", "text_key", "lines").dropDuplicates(["host", "text_key"])
    counts = texts.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
    repeated = cut(counts.where("n > 1"))  # few of all lines
    # Of a host's lines, counted once for each document, those that aren't repeated are distinct lines by themselves.
    held = texts.groupBy("host").agg(F.sum(F.size("lines")).alias("held"))
    again = repeated.groupBy("host").agg(F.sum(F.col("n") - 1).alias("again"))
    means = held.join(again, "host").select("host", "held", (F.col("held") - F.col("again")).alias("distinct"))
    # The smallest limit comes first: after it few lines are left to join with their hosts.
    return repeated.where(F.col("n") > min_documents).join(means, "host").where(F.col("n") * F.col("distinct") > F.col("held") * spread).select("host", "line")


def _removals(measured: DataFrame, common: DataFrame) -> DataFrame:
    """``host, text_key, common, removed_words``: the common lines of each distinct text that has some, and the words they hold."""
    held = (
        measured.where("n_words > 0")
        .dropDuplicates(["host", "text_key"])
        .select("host", "text_key", F.explode(F.arrays_zip("lines", "line_words")).alias("x"))
        .select("host", "text_key", F.col("x.lines").alias("line"), F.col("x.line_words").alias("words"))
    )
    return held.join(common, ["host", "line"]).groupBy("host", "text_key").agg(F.collect_list("line").alias("common"), F.sum("words").alias("removed_words"))


def _judged(measured: DataFrame, *, min_words: int = 20, max_repeat_percent: int = 30, spread: int = SPREAD, min_documents: int = MIN_DOCUMENTS, max_removed: float = MAX_REMOVED) -> DataFrame:
    """``measured`` with the common lines of each text, ``removed_words``, ``base_failed`` and ``kept``."""
    removed = _removals(measured, common_lines(measured, spread=spread, min_documents=min_documents))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return (
        measured.join(removed, ["host", "text_key"], "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("removed_words") <= max_removed * F.col("n_words")))
    )


def judge(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source", **how) -> DataFrame:
    """Measures, ``removed_words`` and verdicts for each row of ``df``.

    ``kept`` is false if the base rules fail, or if lines above the limits held
    more than ``max_removed`` of the document's words.
    """
    measured = cut(measure(df, id_column=id_column, text_column=text_column, host_column=host_column))
    return _judged(measured, **how).select(
        F.col("id").alias(id_column), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words",
    )


def strip_lines(text: bytes | None, common: set[int]) -> bytes | None:
    """A text without its lines whose normalised form is common; the other lines stay as they are."""
    if not text or not common:
        return text
    return b"\n".join(x for x in text.split(b"\n") if not (parts := x.split()) or line_key(parts) not in common)


def cleaned(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source", **how) -> DataFrame:
    """``df`` without the rows that ``judge`` rejects, and the texts of the others without the lines above the limits.

    Only rows that lose lines or are rejected are joined by their ids; other columns stay as they are.
    """
    measured = cut(measure(df, id_column=id_column, text_column=text_column, host_column=host_column))
    key, host, digest, stays, lines, row_digest, row_host = own("id", "host", "key", "kept", "common", "row_key", "row_host")
    changed = _judged(measured, **how).where("NOT kept OR removed_words > 0").withColumn("common", F.when(F.col("kept"), F.col("common")))
    changed = changed.groupBy("id", "host", "text_key").agg(F.first("kept").alias(stays), F.first("common").alias(lines))
    changed = small(changed.select(F.col("id").alias(key), F.col("host").alias(host), F.col("text_key").alias(digest), stays, lines))

    @F.pandas_udf("binary")
    def text_key(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: xxhash.xxh3_128_digest((x or "").encode()))

    @F.pandas_udf("string")
    def without(texts: pd.Series, common: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or c is None else strip_lines(t.encode(), set(map(int, c))).decode() for t, c in zip(texts, common)], dtype=object)

    bound_batches(df.sparkSession)
    rows = df.withColumn(row_digest, text_key(df[text_column])).withColumn(row_host, _host(df[host_column]))
    same = rows[id_column].eqNullSafe(changed[key]) & (F.col(row_host) == F.col(host)) & (F.col(row_digest) == F.col(digest))
    kept = rows.join(changed, same, "left").where(F.coalesce(F.col(stays), F.lit(True)))
    return kept.withColumn(text_column, without(F.col(text_column), F.col(lines))).select(*df.columns)
