"""The synthetic tables as a corpus, for the registered queries.

Documents become whole documents, conversations become split documents with a
part for each turn, terms and labels become categories and verdicts, lines that
hold a term become quotes, days of events become runs.  One pair in seven is
left out of the verdicts, so that some pairs are pending.  ``SQL`` is the same
mapping for DuckDB, as the tables' common expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import literal_count
from ..sources.tables import read_table

#: Categories: id and term; the two after them are columns of ``labels``.
TERMS = [(1, "our"), (2, "license"), (3, "@"), (4, "all rights reserved"), (5, "teacher")]
LABELS = [(6, "quality"), (7, "toxic")]
#: Ids of split documents start here, above those of whole ones; a parent's parts follow it.
PARENTS = 1_000_000_000_000
#: Documents above this are too large to be processed whole, in the queries.
LARGE = 4000
STAMP = "2024-01-01 00:00:00"


read = read_table


def _stamp() -> Column:
    return F.lit(STAMP).cast("timestamp_ntz")


def result(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    header = F.concat(F.lit("20240101000000/http://"), "source", F.lit(".example/"), F.col("doc_id").cast("string"))
    none = F.lit(None)
    whole = d.select(
        (F.col("doc_id") + 1).alias("result_id"), F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("filepath"),
        F.concat(header, F.lit("\n\n"), "text").alias("content"), none.cast("int").alias("part_number"), none.cast("bigint").alias("parent_result_id"),
    )
    c = read(spark, sf_dir, "conversations").withColumn("parent", F.col("conv_id") * 100 + PARENTS)
    path = F.concat(F.lit("conversations/"), F.col("conv_id").cast("string"), F.lit(".md"))
    turns = F.array_sort(F.collect_list(F.struct("turn", "text")))
    parents = c.groupBy("conv_id", "parent").agg(F.array_join(F.transform(turns, lambda t: t["text"]), "\n\n").alias("content"))
    parents = parents.select(F.col("parent").alias("result_id"), path.alias("filepath"), "content", none.cast("int").alias("part_number"), none.cast("bigint").alias("parent_result_id"))
    parts = c.select(
        (F.col("parent") + F.col("turn") + 1).alias("result_id"), F.concat(path, F.lit("_"), (F.col("turn") + 1).cast("string")).alias("filepath"), F.col("text").alias("content"),
        (F.col("turn") + 1).cast("int").alias("part_number"), F.col("parent").alias("parent_result_id"),
    )
    every = whole.unionByName(parents).unionByName(parts)
    return every.select("result_id", "filepath", "content", F.sha2("content", 256).alias("content_sha256"), "part_number", "parent_result_id", _stamp().alias("created_at"))


def category(spark: SparkSession) -> DataFrame:
    rows = [(i, f"{i:02d}_{n.replace(' ', '_')}.yaml", n, f"about {n}", f"sha-{i}") for i, n in [*TERMS, *LABELS]]
    return spark.createDataFrame(rows, "category_id bigint, category_filename string, category_name string, category_description string, prompt_sha256 string")


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A category for each source of ``documents``, whose prompt tells how many documents and languages it has."""
    found = read(spark, sf_dir, "documents").where("source IS NOT NULL").groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("lang").alias("m"))
    about = F.concat(F.col("n").cast("string"), F.lit(" documents in "), F.col("m").cast("string"), F.lit(" languages"))
    prompt = F.concat(F.lit('Find "'), "source", F.lit('".\n\nThere are '), about, F.lit(".\n"))
    return found.select(F.concat("source", F.lit(".yaml")).alias("category_filename"), F.col("source").alias("category_name"), about.alias("category_description"), prompt.alias("prompt"), F.sha2(prompt, 256).alias("prompt_sha256"))


#: The same for DuckDB.
SOURCES = """sources AS (SELECT *, sha256(prompt) AS prompt_sha256 FROM (
  SELECT source || '.yaml' AS category_filename, source AS category_name, count(*) || ' documents in ' || count(DISTINCT lang) || ' languages' AS category_description,
    'Find "' || source || '".' || chr(10) || chr(10) || 'There are ' || count(*) || ' documents in ' || count(DISTINCT lang) || ' languages.' || chr(10) AS prompt FROM documents WHERE source IS NOT NULL GROUP BY source))"""


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``result_id, text`` of what is processed: whole documents and parts."""
    d = read(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("result_id"), "text")
    c = read(spark, sf_dir, "conversations").select((F.col("conv_id") * 100 + F.lit(PARENTS) + F.col("turn") + 1).alias("result_id"), "text")
    return d.unionByName(c)


def _has_verdict() -> Column:
    return (F.col("result_id") + F.col("category_id")) % 7 != 0


def result_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = F.array(*[F.struct(F.lit(i).cast("bigint").alias("category_id"), literal_count(F.col("low"), t).alias("n")) for i, t in TERMS])
    texts = _texts(spark, sf_dir).select("result_id", F.lower("text").alias("low"))
    terms = texts.select("result_id", F.explode(counts).alias("x")).select("result_id", "x.*")
    match = F.when(F.col("n") > 1, "yes").when(F.col("n") == 1, "maybe").otherwise("no")
    terms = terms.select("result_id", "category_id", match.alias("match"), F.concat(F.col("n").cast("string"), F.lit(" hits")).alias("reasoning_trace"))
    both = F.array(*[F.struct(F.lit(i).cast("bigint").alias("category_id"), F.col(n).cast("string").alias("match")) for i, n in LABELS])
    labels = read(spark, sf_dir, "labels").select((F.col("doc_id") + 1).alias("result_id"), F.explode(both).alias("x")).select("result_id", "x.category_id", "x.match", F.lit("label").alias("reasoning_trace"))
    return terms.unionByName(labels).where(_has_verdict()).withColumn("created_at", _stamp())


def blockquotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _texts(spark, sf_dir).select("result_id", F.explode(F.split("text", "\n")).alias("blockquote"))
    hits = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(i).cast("bigint")) for i, t in TERMS]))
    lines = lines.withColumn("low", F.lower("blockquote"))
    return lines.select("result_id", F.explode(hits).alias("category_id"), "blockquote").where(_has_verdict()).withColumn("created_at", _stamp())


def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("day", F.dayofmonth("ts"))
    seconds = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    return e.groupBy(F.col("day").cast("bigint").alias("run_id")).agg(
        F.min("ts").alias("started_at"),
        F.when(F.first("day") <= 28, F.max("ts")).alias("finished_at"),
        F.lit("rules").alias("model"),
        F.count("*").alias("pairs_processed"),
        F.count_if(F.col("event_type") == "purchase").alias("pairs_saved"),
        F.count_if(F.col("event_type") == "error").alias("pairs_failed"),
        F.lit(0).cast("bigint").alias("pairs_skipped"),
        seconds.alias("processing_seconds"),
        F.lit(0).cast("bigint").alias("janitor_imported"),
        F.lit(None).cast("double").alias("janitor_seconds"),
    )


def corpus(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "result": result(spark, sf_dir),
        "category": category(spark),
        "result_category": result_category(spark, sf_dir),
        "result_category_blockquote": blockquotes(spark, sf_dir),
        "run_stats": run_stats(spark, sf_dir),
    }


_TERM_ROWS = ", ".join(f"({i}::BIGINT, '{t}')" for i, t in TERMS)
_CATEGORY_ROWS = ", ".join(f"({i}::BIGINT, '{i:02d}_{n.replace(' ', '_')}.yaml', '{n}', 'about {n}', 'sha-{i}')" for i, n in [*TERMS, *LABELS])

SQL = f"""WITH texts AS (
  SELECT doc_id + 1 AS result_id, text FROM documents
  UNION ALL SELECT conv_id * 100 + {PARENTS} + turn + 1, text FROM conversations),
rows_ AS (
  SELECT doc_id + 1 AS result_id, source || '/' || doc_id || '.md' AS filepath,
    '20240101000000/http://' || source || '.example/' || doc_id || chr(10) || chr(10) || text AS content, NULL::INT AS part_number, NULL::BIGINT AS parent_result_id FROM documents
  UNION ALL SELECT conv_id * 100 + {PARENTS}, 'conversations/' || conv_id || '.md', string_agg(text, chr(10) || chr(10) ORDER BY turn, text), NULL, NULL FROM conversations GROUP BY conv_id
  UNION ALL SELECT conv_id * 100 + {PARENTS} + turn + 1, 'conversations/' || conv_id || '.md_' || (turn + 1), text, (turn + 1)::INT, conv_id * 100 + {PARENTS} FROM conversations),
result AS (SELECT *, sha256(content) AS content_sha256, TIMESTAMP '{STAMP}' AS created_at FROM rows_),
category(category_id, category_filename, category_name, category_description, prompt_sha256) AS (VALUES {_CATEGORY_ROWS}),
terms(category_id, term) AS (VALUES {_TERM_ROWS}),
counts AS (SELECT result_id, category_id, ((length(lower(text)) - length(replace(lower(text), term, ''))) / length(term))::INT AS n FROM texts, terms),
result_category AS (
  SELECT * FROM (
    SELECT result_id, category_id, CASE WHEN n > 1 THEN 'yes' WHEN n = 1 THEN 'maybe' ELSE 'no' END AS match, n || ' hits' AS reasoning_trace, TIMESTAMP '{STAMP}' AS created_at FROM counts
    UNION ALL SELECT doc_id + 1, 6, quality::VARCHAR, 'label', TIMESTAMP '{STAMP}' FROM labels
    UNION ALL SELECT doc_id + 1, 7, toxic::VARCHAR, 'label', TIMESTAMP '{STAMP}' FROM labels)
  WHERE (result_id + category_id) % 7 <> 0),
lines AS (SELECT result_id, unnest(string_split(text, chr(10))) AS blockquote FROM texts),
result_category_blockquote AS (
  SELECT result_id, category_id, blockquote, TIMESTAMP '{STAMP}' AS created_at FROM lines JOIN terms ON contains(lower(blockquote), term) WHERE (result_id + category_id) % 7 <> 0),
run_stats AS (
  SELECT day(ts)::BIGINT AS run_id, min(ts) AS started_at, CASE WHEN day(ts) <= 28 THEN max(ts) END AS finished_at, 'rules' AS model, count(*) AS pairs_processed,
    count(*) FILTER (event_type = 'purchase') AS pairs_saved, count(*) FILTER (event_type = 'error') AS pairs_failed, 0::BIGINT AS pairs_skipped,
    sum(value::DECIMAL(18,2))::DOUBLE AS processing_seconds, 0::BIGINT AS janitor_imported, NULL::DOUBLE AS janitor_seconds FROM events GROUP BY day(ts)),
parents AS (SELECT DISTINCT parent_result_id AS result_id FROM result WHERE parent_result_id IS NOT NULL),
eligible AS (
  SELECT * FROM result r WHERE part_number IS NOT NULL
    OR (parent_result_id IS NULL AND part_number IS NULL AND length(content) <= {LARGE} AND NOT EXISTS (SELECT 1 FROM parents p WHERE p.result_id = r.result_id))),
pending AS (
  SELECT r.result_id, c.category_id FROM eligible r, category c
  WHERE NOT EXISTS (SELECT 1 FROM result_category v WHERE v.result_id = r.result_id AND v.category_id = c.category_id))
"""
