"""Language ID by Bayesian evidence fusion.

Text likelihoods come from a naive Bayes model over hashed byte trigrams, one
more class, ``und``, gives every trigram the same probability.  They are fused
with what else is known of a document: the declared (markup) language, the
address suffix, and its host.  How far a declaration or a suffix is to be
trusted is counted over all documents: how often it goes with each language that
the text alone suggests.  Host priors are smoothed hierarchically: host, then
the domain above it, then all documents.  The counts are grouped aggregations;
hosts meet documents in joins whose skewed keys Spark can split.

The model is fitted on about ``FIT_ROWS`` rows of each label, drawn by hash: that
is its only bound.  A label is a primary language tag in lower case (``en-US``
is ``en``), and each label is a language of the model, which holds 128 kB for
each.  Neither depends on the order or the partitions of rows.  Counts, priors
and verdicts cover all rows and whole texts.

Defined results: a null or letterless text has no text evidence, and is rejected
as ``und``; a null declaration, address or host is no evidence (a null host has
the prior of all documents); repeated rows get equal verdicts; an empty table gives an
empty table; without labels every text is ``und``; other columns, whatever their names, are
ignored, or kept by ``keep_identified``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, by_bytes, cut, own, small

#: Rows of each label for the fit, about; buckets of trigrams.
FIT_ROWS, BUCKETS = 1000, 1 << 15
#: Trigrams that count as independent evidence, at most; pseudo-counts of the smoothing.
EFFECTIVE, SMOOTH = 200, 20.0

_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the byte trigrams of a text; what is no letter is a space, and runs of spaces are one."""
    data = b" ".join((text or "").lower().encode("utf-8", "replace").translate(_LETTERS).split())
    if not data:
        return np.zeros(0, np.int64)
    codes = np.frombuffer(b" " + data + b" ", np.uint8).astype(np.uint32)
    mixed = (codes[:-2] * np.uint32(0x9E3779B1)) ^ (codes[1:-1] * np.uint32(0x85EBCA77)) ^ (codes[2:] * np.uint32(0xC2B2AE3D))
    return ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(17)).astype(np.int64)


class Model:
    """Log-probabilities of buckets for each language and, last, ``und``."""

    def __init__(self, languages: list[str], counts: np.ndarray, pseudo: float = 0.5):
        self.languages = languages
        seen = np.log((counts + pseudo) / (counts.sum(axis=0) + pseudo * BUCKETS)) if languages else np.zeros((BUCKETS, 0))
        self.table = np.concatenate([seen, np.full((BUCKETS, 1), -np.log(BUCKETS))], axis=1).astype(np.float32)

    def score(self, text: str | None) -> tuple[int, list[float]]:
        """The number of trigrams, and log-likelihoods of at most ``EFFECTIVE`` of them."""
        found = trigrams(text)
        total = np.zeros(self.table.shape[1])
        for start in range(0, len(found), 1 << 16):
            total += self.table[found[start : start + (1 << 16)]].sum(axis=0, dtype=np.float64)
        return len(found), (total * min(1.0, EFFECTIVE / max(len(found), 1))).tolist()


def tag(declared: Column) -> Column:
    """The primary language of a declaration, in lower case; null if there is none."""
    found = F.regexp_extract(F.lower(declared.cast("string")), r"^\s*([^\s_-]+)", 1)
    return F.when(found != "", found)


def sample(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang", rows: int = FIT_ROWS) -> DataFrame:
    """``label, text`` of about ``rows`` rows of each label, drawn by hash."""
    labelled = df.select(tag(df[label_column]).alias("label"), df[text_column].alias("text"), df[id_column].alias("id")).where("label IS NOT NULL AND text IS NOT NULL")
    shares = small(labelled.groupBy("label").agg(F.least(F.lit(1.0), rows / F.count("*")).alias("share")))
    drawn = F.shiftrightunsigned(F.xxhash64("id", "text"), 33) < (F.col("share") * (1 << 31)).cast("long")
    return labelled.join(shares, "label").where(drawn).select("label", "text")


def fit(df: DataFrame, **how) -> Model:
    """A model from a sample of labelled rows; one array of counts for each label reaches the driver."""
    bound_batches(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in by_bytes(batches, "text"):
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.bincount(trigrams(text), minlength=BUCKETS)
                sums[label] = sums[label] + part if label in sums else part
        for label, found in sums.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(at)), pa.array(at.astype(np.int32)), pa.array(found[at])], ["label", "bucket", "n"])

    counts = sample(df, **how).mapInArrow(count, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    found = counts.groupBy("label").agg(F.collect_list("bucket").alias("at"), F.collect_list("n").alias("n"))
    languages, columns = [], []
    for batch in found.orderBy("label").toArrow().to_batches():
        for label, at, n in zip(*batch.columns):
            languages.append(label.as_py())
            columns.append(np.zeros(BUCKETS))
            columns[-1][at.values.to_numpy()] = n.values.to_numpy()
    return Model(languages, np.stack(columns, axis=1) if columns else np.zeros((BUCKETS, 0)))


def score(df: DataFrame, model: Model, *, id_column: str = "doc_id", text_column: str = "text", declared: Column | None = None, host: Column | None = None, suffix: Column | None = None) -> DataFrame:
    """``id, th, declared, suffix, host, domain, n, ll, best``: text evidence beside the other evidence, without the texts."""
    bound_batches(df.sparkSession)
    none = F.lit(None).cast("string")
    host = none if host is None else host.cast("string")
    domain = F.regexp_extract(host, r"[^.]*\.[^.]*$", 0)  # the last two labels
    narrow = df.select(
        df[id_column].alias("id"), F.xxhash64(df[text_column]).alias("th"), (none if declared is None else tag(declared)).alias("declared"),
        (none if suffix is None else F.lower(suffix.cast("string"))).alias("suffix"), host.alias("host"), F.when(domain != "", domain).alias("domain"), df[text_column].alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            scored = [model.score(x) for x in batch.column(6).to_pylist()]
            best = [int(np.argmax(ll)) if n else -1 for n, ll in scored]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:6], pa.array([n for n, _ in scored], pa.int64()), pa.array([ll for _, ll in scored], pa.list_(pa.float64())), pa.array(best, pa.int32())],
                ["id", "th", "declared", "suffix", "host", "domain", "n", "ll", "best"],
            )

    return narrow.mapInArrow(run, f"id {dict(narrow.dtypes)['id']}, th long, declared string, suffix string, host string, domain string, n long, ll array<double>, best int")


def _counts(scored: DataFrame, key: str, classes: int) -> DataFrame:
    """``key, counts``: how many texts of each language a key goes with."""
    found = scored.where(F.col(key).isNotNull() & (F.col("best") >= 0)).groupBy(key, "best").agg(F.count("*").alias("n"))
    found = found.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("found"))
    return found.select(key, F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda k: F.coalesce(F.col("found")[k], F.lit(0).cast("long"))).alias("counts"))


def _shares(counts: Column, above: Column, weight: float = SMOOTH) -> Column:
    """Counts as shares, smoothed towards the shares ``above``."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.zip_with(counts, above, lambda c, p: (c + p * weight) / (total + weight))


def fuse(scored: DataFrame, model: Model, *, id_column: str = "doc_id", min_confidence: float = 0.5, accepted: list[str] | None = None) -> DataFrame:
    """``id, th, lang, confidence, text_lang, kept`` for each scored row."""
    names = [*model.languages, "und"]
    classes = len(names)
    flat = F.array(*[F.lit(1.0 / classes)] * classes)
    every = {r.best: r["count"] for r in scored.where("best >= 0").groupBy("best").count().collect()}  # a row for each language
    seen = [float(every.get(k, 0)) for k in range(classes)]
    overall = [(x + 1.0) / (sum(seen) + classes) for x in seen]
    prior = F.array(*map(F.lit, overall))
    domains = small(_counts(scored, "domain", classes).select("domain", _shares(F.col("counts"), prior).alias("domain_prior")))
    # The hosts' domain goes with them: one row of counts for each host, smoothed by its domain's.
    hosts = _counts(scored, "host", classes).withColumn("domain", F.regexp_extract("host", r"[^.]*\.[^.]*$", 0)).join(domains, "domain", "left")
    hosts = small(hosts.select("host", _shares(F.col("counts"), F.coalesce("domain_prior", prior)).alias("host_prior")))
    out = scored.join(hosts, "host", "left")
    fused = F.zip_with(F.col("ll"), F.coalesce("host_prior", prior), lambda a, p: a + F.log(p))
    for key in ("declared", "suffix"):
        # P(value | language), smoothed towards the value's share of all documents: no evidence then.
        n = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
        total = max(sum(seen), 1.0)
        rates = F.zip_with("counts", F.array(*map(F.lit, seen)), lambda c, s: F.log((c + SMOOTH * n / total) / (s + SMOOTH)))
        rates = small(_counts(scored, key, classes).select(key, rates.alias(f"{key}_rate")))
        out = out.join(rates, key, "left")
        fused = F.zip_with(fused, F.coalesce(f"{key}_rate", F.transform(flat, lambda _: F.lit(0.0))), lambda a, b: a + b)
    out = out.withColumn("fused", fused).withColumn("top", F.array_max("fused"))
    confidence = F.lit(1.0) / F.aggregate("fused", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    best = F.array_position("fused", F.col("top")).cast("int")
    label = F.array(*map(F.lit, names))
    lang = F.when(F.col("n") > 0, F.element_at(label, best)).otherwise("und")
    out = out.select("id", "th", "n", lang.alias("lang"), confidence.alias("confidence"), F.when(F.col("best") >= 0, F.element_at(label, F.col("best") + 1)).alias("text_lang"))
    kept = (F.col("lang") != "und") & (F.col("confidence") >= min_confidence)
    if accepted is not None:
        kept = kept & F.col("lang").isin(accepted)
    return out.select(F.col("id").alias(id_column), "th", "lang", F.round("confidence", 6).alias("confidence"), "text_lang", kept.alias("kept"))


def identify(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", declared_column: str | None = "lang", host_column: str | None = "source", suffix: Column | None = None, model: Model | None = None, **how) -> DataFrame:
    """Languages of ``df``'s rows, fitted on its own declarations unless a model is given."""
    model = model or fit(df, id_column=id_column, text_column=text_column, label_column=declared_column or "lang")
    scored = score(df, model, id_column=id_column, text_column=text_column, declared=df[declared_column] if declared_column else None, host=df[host_column] if host_column else None, suffix=suffix)
    return fuse(cut(scored), model, id_column=id_column, **how)


def identify_pages(df: DataFrame, model: Model, *, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", **how) -> DataFrame:
    """Languages of web pages: declared in the markup's ``lang``, addresses by their last host label."""
    host = F.lower(F.regexp_extract(df[url_column], r"^[^/?#]*://([^/?#:]*)", 1))
    text = F.regexp_replace(F.regexp_replace(df[html_column], r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>", " ")
    markup = F.regexp_extract(df[html_column], r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([A-Za-z]+)", 1)
    rows = df.select(df[id_column].alias("page"), text.alias("words"), F.when(markup != "", markup).alias("markup"), F.when(host != "", host).alias("site"))
    label = F.regexp_extract("site", r"[^.]*$", 0)
    scored = score(rows, model, id_column="page", text_column="words", declared=rows["markup"], host=rows["site"], suffix=label)
    return fuse(cut(scored), model, id_column=id_column, **how)


def keep_identified(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **how) -> DataFrame:
    """``df`` without the rows whose language is rejected."""
    key, hashed = own("id", "th")
    rejected = identify(df, id_column=id_column, text_column=text_column, **how).where("NOT kept")
    rejected = small(rejected.select(F.col(id_column).alias(key), F.col("th").alias(hashed)).distinct())
    same = df[id_column].eqNullSafe(rejected[key]) & (F.xxhash64(df[text_column]) == rejected[hashed])
    return df.join(rejected, same, "left_anti")
