"""Registered queries that go through files: what they read is written first, by the sinks, into a folder of the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import text
from ..scratch import materialise, new_folder
from ..sources import archive, files, records
from ..store import CorpusStore
from . import corpus
from .corpus import read
from .queries import _NAME, _URL, _archived, query


@query("SELECT page_id || '.md' AS filename, sha256(url || chr(10) || chr(10) || html) AS content_sha256, length(url || chr(10) || chr(10) || html)::INT AS n_code_points FROM pages", with_corpus=False)
def document_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as markdown files, each once, and scanned again."""
    folder = new_folder(spark, "documents")
    pages = read(spark, sf_dir, "pages").select("url", F.concat(F.col("page_id").cast("string"), F.lit(".md")).alias("filename"), F.concat_ws("\n\n", "url", "html").alias("content"), F.lit(None).cast("string").alias("error"))
    materialise(archive.write_markdown(pages, folder))
    found = files.documents(spark, folder).where("valid_utf8")
    return found.select(F.regexp_extract("filepath", "[^/]*$", 0).alias("filename"), "content_sha256", F.length("content").alias("n_code_points"))


@query(f"WITH {corpus.SOURCES} SELECT * FROM sources", with_corpus=False)
def category_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A category for each source of the documents, written as prompt files (twice: the second time changes nothing) and read again."""
    folder = new_folder(spark, "prompts")
    for _ in range(2):
        materialise(files.write_prompts(corpus.sources(spark, sf_dir), folder))
    return files.categories(spark, folder)


_LINE = "'{\"result_id\": ' || doc_id || ', \"category_id\": 1, \"match\": \"no\", \"reasoning_trace\": \"' || lang || '\"}'"


@query(f"SELECT {_LINE} AS value FROM documents", with_corpus=False)
def jsonl_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of JSONL files, without the blanks around them and without blank lines."""
    folder = new_folder(spark, "jsonl")
    line = F.format_string('  {"result_id": %d, "category_id": 1, "match": "no", "reasoning_trace": "%s"}\t\n \n', "doc_id", "lang")
    read(spark, sf_dir, "documents").select(line).write.mode("append").text(folder)
    return files.jsonl_records(spark, folder).select("value")


@query("SELECT page_id AS result_id, 1::BIGINT AS category_id, CASE WHEN page_id % 2 = 0 THEN 'yes' ELSE 'no' END AS match, url AS reasoning_trace, 'r' || page_id || '_c1.json' AS source FROM pages", with_corpus=False)
def reply_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies written as one file for each pair, twice (the second time changes nothing), and read again."""
    from ..functions.strict_json import parse_records

    folder = new_folder(spark, "replies")
    match = F.when(F.col("page_id") % 2 == 0, "yes").otherwise("no")
    record = lambda trace: F.to_json(F.struct(F.col("page_id").alias("result_id"), F.lit(1).alias("category_id"), match.alias("match"), trace.alias("reasoning_trace")))
    pages = read(spark, sf_dir, "pages")
    for trace in (F.col("url"), F.lit("later")):
        materialise(files.write_replies(pages.select(text.custom_id(F.col("page_id"), F.lit(1)).alias("custom_id"), record(trace).alias("record")), folder))
    return parse_records(files.json_files(spark, folder)).select("record.result_id", "record.category_id", "record.match", "record.reasoning_trace", "source")


@query("SELECT page_id AS result_id, 1::BIGINT AS category_id FROM pages UNION SELECT doc_id AS result_id, 2::BIGINT AS category_id FROM documents", with_corpus=False)
def completed_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completed pairs of a folder of replies: by files' names (whatever they hold) and by saved records."""
    folder = new_folder(spark, "completed")
    named = read(spark, sf_dir, "pages").select(text.custom_id(F.col("page_id"), F.lit(1)).alias("custom_id"), F.lit("{}").alias("record"))
    materialise(files.write_replies(named, folder))
    saved = read(spark, sf_dir, "documents").select(text.custom_id(F.col("doc_id"), F.lit(2)).alias("custom_id"), F.format_string('{"result_id": %d, "category_id": 2}', "doc_id").alias("record"))
    saved.write.parquet(f"{folder}/replies")
    return files.completed_pairs(files.reply_records(spark, folder))


_TABLES = ("result", "category", "result_category", "result_category_blockquote", "excluded_file", "run_stats")


@query(f"SELECT t AS name, CASE t WHEN 'result' THEN (SELECT count(*) FROM documents) ELSE 0 END AS n, true AS created FROM (SELECT unnest({list(_TABLES)}) AS t)", with_corpus=False)
def store_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new store's tables, after one append of documents; making it a second time does nothing."""
    store = CorpusStore(spark, f"{new_folder(spark, 'store')}/corpus")
    created = store.create() and not store.create()
    docs = corpus.result(spark, sf_dir).where("part_number IS NULL AND result_id < 1000000000000")
    store.append("result", docs)
    counts = [store.read(t).agg(F.lit(t).alias("name"), F.count("*").alias("n")) for t in schema.tables()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out.withColumn("created", F.lit(created))


@query("SELECT page_id, coalesce(page_id % 4 = 0, false) AS there FROM pages", with_corpus=False)
def snapshot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index replies (a header and a row, a header alone, nothing, no reply) as answers."""
    k = F.col("page_id") % 4
    reply = F.when(k == 0, F.to_json(F.array(F.array(F.lit("urlkey")), F.array("url")))).when(k == 1, '[["urlkey"]]').when(k == 2, "[]")
    return read(spark, sf_dir, "pages").select("page_id", archive.snapshot_exists(reply).alias("there"))


@query(f"""SELECT min({_URL}) AS url, {_NAME.format('url')} AS filename, '20040701000000/' || replace(min({_URL}), 'https://web.archive.org/web/20040701000000/', '') AS header, false AS failed
    FROM pages WHERE page_id % 5 <> 0 GROUP BY 2
    UNION ALL SELECT {_URL}, {_NAME.format(f"nullif(regexp_extract({_URL}, '^https?://web\\.archive\\.org/web/(\\d{{14}})/(.+)$', 2), '')")}, NULL, true FROM pages WHERE page_id % 5 = 0""", with_corpus=False)
def fetch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a fetch of stored pages makes of each URL: a document with its header, or a failure."""
    found = archive.fetch_stored(_archived(spark, sf_dir))
    return found.select("url", "filename", F.when(F.col("error").isNull(), text.url_header(F.col("content"))).alias("header"), F.col("error").isNotNull().alias("failed"))


# Archive records.

_TIME = "'20' || lpad(page_id::VARCHAR, 12, '0')"


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = F.concat(F.lit("20"), F.lpad(F.col("page_id").cast("string"), 12, "0"))
    return read(spark, sf_dir, "pages").select("url", time.alias("time"), "html")


@query(f"""SELECT url, time, 'response' AS type, 'text/html; charset=utf-8' AS media_type, 200::INT AS status, sha256(html) AS payload_sha256, NULL::VARCHAR AS error
    FROM (SELECT url, coalesce(html, '') AS html, {_TIME} AS time, row_number() OVER (PARTITION BY url ORDER BY page_id) AS k FROM pages) WHERE k = 1""", with_corpus=False)
def archive_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as packed WARC records; of each URL the first is chosen in the index, and read by its byte range."""
    folder = new_folder(spark, "archives")
    index = materialise(records.write_archives(_snapshots(spark, sf_dir), folder))
    first = index.groupBy("url").agg(F.min(F.struct("time", "archive", "offset", "length")).alias("x")).select("url", "x.*")
    first.write.parquet(f"{folder}/index")
    return records.read_archives(spark, folder, f"{folder}/index").select("url", "time", "type", "media_type", "status", "payload_sha256", "error")


@query(f"""WITH asked AS (SELECT min({_URL}) AS url, min(url) AS target, {_NAME.format('url')} AS filename FROM pages WHERE page_id % 5 <> 0 GROUP BY 3)
    SELECT url, filename, CASE WHEN there THEN '20040701000000/' || target END AS header, CASE WHEN NOT there THEN 'no snapshot of ' || target || ' at 20040701000000' END AS error
    FROM (SELECT *, EXISTS (SELECT 1 FROM pages p WHERE p.url = target AND p.page_id % 3 <> 0) AS there FROM asked)
    UNION ALL SELECT {_URL}, {_NAME.format(f"nullif(regexp_extract({_URL}, '^https?://web\\.archive\\.org/web/(\\d{{14}})/(.+)$', 2), '')")}, NULL, 'not an archive URL: ' || {_URL} FROM pages WHERE page_id % 5 = 0""", with_corpus=False)
def record_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of archive URLs from the archives' records; a third of the pages was never archived."""
    folder = new_folder(spark, "snapshots")
    pages = read(spark, sf_dir, "pages").where("page_id % 3 <> 0").select("url", F.lit("20040701000000").alias("time"), "html")
    index = materialise(records.write_archives(pages, folder))
    found = records.fetch_records(_archived(spark, sf_dir), index, folder)
    return found.select("url", "filename", F.when(F.col("error").isNull(), text.url_header(F.col("content"))).alias("header"), "error")
