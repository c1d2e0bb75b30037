"""Registered queries over the synthetic corpus, and their SQL for DuckDB.

A query without SQL is one that SQL can't express (the text that the splitter
and the markdown converter make); tests hold those against plain Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import split, strict_json, text
from ..functions.markdown import html_to_markdown
from ..operators import importer, infer, ledger, pairs, preflight, prep, views
from ..sources import archive, files
from ..scratch import new_folder
from ..store import CorpusStore
from . import corpus
from .corpus import LARGE, SQL, read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, *, with_corpus: bool = True) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = f"{SQL if with_corpus else ''} {sql}"
        return f

    return add


# Reports.

_SUM = "sum(CASE WHEN match IN ({}) THEN 1 ELSE 0 END)::BIGINT"
_YES, _MAYBE, _NO = _SUM.format("'yes', '1'"), _SUM.format("'maybe'"), _SUM.format("'no', '0'")


@query(f"""SELECT r.result_id, r.filepath, r.content_sha256, r.created_at, count(DISTINCT v.category_id) AS categories_processed,
      {_YES} AS yes_count, {_MAYBE} AS maybe_count, {_NO} AS no_count,
      (SELECT count(*) FROM result_category_blockquote q WHERE q.result_id = r.result_id) AS total_blockquotes
    FROM result r LEFT JOIN result_category v ON r.result_id = v.result_id GROUP BY r.result_id, r.filepath, r.content_sha256, r.created_at""")
def result_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.result_summary(corpus.corpus(spark, sf_dir))


@query("""SELECT r.result_id, r.filepath, c.category_name, v.match, v.reasoning_trace, v.created_at
    FROM result_category v JOIN result r ON v.result_id = r.result_id JOIN category c ON v.category_id = c.category_id""")
def category_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.category_matches(corpus.corpus(spark, sf_dir))


@query("""SELECT q.result_id, r.filepath, c.category_id, c.category_name, c.category_description, v.match, q.blockquote, q.created_at
    FROM result_category_blockquote q JOIN result r ON q.result_id = r.result_id JOIN category c ON q.category_id = c.category_id
    JOIN result_category v ON q.result_id = v.result_id AND q.category_id = v.category_id""")
def blockquotes_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.blockquotes_by_category(corpus.corpus(spark, sf_dir))


@query(f"""SELECT coalesce(r.parent_result_id, r.result_id) AS document_id, max(p.filepath) AS original_filepath, c.category_id, max(c.category_name) AS category_name,
      max(c.category_description) AS category_description,
      CASE WHEN {_YES} > 0 THEN 'yes' WHEN {_MAYBE} > 0 THEN 'maybe' ELSE 'no' END AS aggregate_match,
      count(DISTINCT r.result_id) AS parts_processed, {_YES} AS yes_parts, {_MAYBE} AS maybe_parts,
      array_to_string(list_sort(list_distinct(list(r.part_number))), ',') AS matching_parts
    FROM result r JOIN result_category v ON r.result_id = v.result_id JOIN category c ON v.category_id = c.category_id
    LEFT JOIN result p ON r.parent_result_id = p.result_id WHERE r.part_number IS NOT NULL
    GROUP BY coalesce(r.parent_result_id, r.result_id), c.category_id""")
def document_category_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.document_category_aggregate(corpus.corpus(spark, sf_dir))


@query("""SELECT DISTINCT coalesce(r.parent_result_id, r.result_id) AS document_id, coalesce(p.filepath, r.filepath) AS original_filepath, c.category_id, c.category_name, q.blockquote
    FROM result_category_blockquote q JOIN result r ON q.result_id = r.result_id JOIN category c ON q.category_id = c.category_id
    LEFT JOIN result p ON r.parent_result_id = p.result_id""")
def document_blockquotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.document_blockquotes(corpus.corpus(spark, sf_dir))


@query("""SELECT count(*) AS total_runs, sum(pairs_processed)::BIGINT AS total_pairs_processed, sum(pairs_saved)::BIGINT AS total_pairs_saved,
      sum(pairs_failed)::BIGINT AS total_pairs_failed, sum(processing_seconds::DECIMAL(18,2))::DOUBLE AS total_processing_seconds,
      sum(janitor_imported)::BIGINT AS total_janitor_imported, sum(janitor_seconds) AS total_janitor_seconds,
      round(sum(processing_seconds::DECIMAL(18,2))::DOUBLE / 3600.0, 2) AS total_processing_hours, min(started_at) AS first_run, max(finished_at) AS last_run
    FROM run_stats WHERE finished_at IS NOT NULL""")
def processing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A sum of doubles depends on their order in the last digit; cents don't.
    return views.processing_summary(corpus.corpus(spark, sf_dir)).withColumn("total_processing_seconds", F.col("total_processing_seconds").cast("decimal(18,2)").cast("double"))


@query("SELECT match, count(*) AS verdicts FROM result_category GROUP BY match")
def match_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.match_distribution(corpus.corpus(spark, sf_dir))


@query("SELECT count(DISTINCT result_id) AS documents, count(DISTINCT category_id) AS categories, count(*) AS verdicts FROM result_category")
def category_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.category_coverage(corpus.corpus(spark, sf_dir))


# Pending work.


def _pending(t: dict[str, DataFrame], **how) -> DataFrame:
    return pairs.pending_pairs(t["result"], t["category"], t["result_category"], limit_chars=LARGE, **how)


@query("SELECT result_id, category_id FROM pending")
def pending_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pending(corpus.corpus(spark, sf_dir))


@query("SELECT count(*) AS pending FROM pending")
def pending_pair_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = corpus.corpus(spark, sf_dir)
    return pairs.count_pending(t["result"], t["category"], t["result_category"], LARGE)


@query("SELECT result_id, category_id FROM pending WHERE result_id % 2 <> 0 ORDER BY result_id, category_id LIMIT 100")
def pending_pairs_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit is the feature: it counts what is left after completed pairs (those of even documents here)."""
    t = corpus.corpus(spark, sf_dir)
    done = t["result"].where("result_id % 2 = 0").select("result_id").crossJoin(F.broadcast(t["category"].select("category_id")))
    return _pending(t, completed=done, limit=100)


@query("SELECT result_id, filepath, length(content)::INT AS n_chars FROM eligible")
def eligible_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.eligible(corpus.result(spark, sf_dir), LARGE).select("result_id", "filepath", F.length("content").alias("n_chars"))


@query("""SELECT *, eligible_documents * total_categories AS total_possible_pairs, eligible_documents * total_categories - processed_pairs AS pending_pairs FROM (
      SELECT (SELECT count(*) FROM result) AS total_rows, (SELECT count(*) FROM result WHERE parent_result_id IS NULL) AS original_documents,
        (SELECT count(DISTINCT parent_result_id) FROM result) AS split_documents, (SELECT count(*) FROM result WHERE part_number IS NOT NULL) AS split_parts,
        (SELECT count(*) FROM eligible) AS eligible_documents, (SELECT count(*) FROM category) AS total_categories, (SELECT count(*) FROM result_category) AS processed_pairs)""")
def corpus_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = corpus.corpus(spark, sf_dir)
    return pairs.corpus_status(t["result"], t["category"], t["result_category"], LARGE)


_PROMPTS = "(SELECT category_id, CASE WHEN category_id % 2 = 1 THEN 'Find \"' || category_name || '\".' ELSE '' END AS prompt FROM category)"


@query(f"""SELECT 'r' || p.result_id || '_c' || p.category_id AS custom_id, 'rules' AS model, 0.0::DOUBLE AS temperature, 32000 AS max_tokens, sha256('You find terms.') AS system_sha256,
      sha256('{pairs.PROMPT_HEAD}' || m.prompt || '{pairs.PROMPT_DOCUMENT}' || r.content || '{pairs.PROMPT_TAIL}') AS user_sha256
    FROM pending p JOIN result r ON p.result_id = r.result_id JOIN {_PROMPTS} m ON p.category_id = m.category_id""")
def build_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _requests(spark, sf_dir)
    body = F.from_json("body", "model string, messages array<struct<role:string,content:string>>, temperature double, max_tokens int")
    digest = lambda k: F.sha2(F.col("b.messages")[k]["content"], 256)
    return asked.select("custom_id", body.alias("b")).select("custom_id", "b.model", "b.temperature", "b.max_tokens", digest(0).alias("system_sha256"), digest(1).alias("user_sha256"))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = corpus.corpus(spark, sf_dir)
    named = F.concat(F.lit('Find "'), "category_name", F.lit('".'))
    prompts = t["category"].where("category_id % 2 = 1").select("category_filename", named.alias("prompt"))
    return pairs.requests(_pending(t), t["result"], t["category"], prompts, "You find terms.", "rules")


# Text functions and validation.

_BODY = "CASE WHEN strpos(content, chr(10) || chr(10)) > 0 THEN substr(content, strpos(content, chr(10) || chr(10)) + 2) ELSE content END"


@query(f"SELECT result_id, {_BODY} AS body, CASE WHEN strpos(content, chr(10) || chr(10)) > 0 THEN substr(content, 1, strpos(content, chr(10) || chr(10)) - 1) ELSE '' END AS header FROM result")
def content_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.result(spark, sf_dir).select("result_id", text.content_body(F.col("content")).alias("body"), text.url_header(F.col("content")).alias("header"))


@query("SELECT doc_id, sha256(text) AS content_sha256, length(text)::INT AS n_code_points FROM documents", with_corpus=False)
def content_sha256(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("content_sha256"), F.length("text").alias("n_code_points"))


# Whole documents as they are, with every fifth cut short, every seventh like a program file, and every eleventh full of control characters.
_MADE = """made AS (SELECT result_id, filepath, content_sha256, CASE WHEN result_id % 5 = 0 THEN substr(content, 1, 110) WHEN result_id % 7 = 0 THEN replace(content, chr(10) || chr(10), chr(10) || chr(10) || 'MZ')
      WHEN result_id % 11 = 0 THEN replace(content, 'e', chr(1)) ELSE content END AS content FROM result),
    bodies AS (SELECT *, """ + _BODY + """ AS body FROM made),
    judged AS (SELECT *, (length(regexp_replace(body, '[\\p{C}\\p{Z}]', '', 'g')) + length(body) - length(translate(body, ' ' || chr(10) || chr(13) || chr(9), '')))::DOUBLE / nullif(length(body), 0) AS ratio FROM bodies)"""


def _made(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = (
        F.when(F.col("result_id") % 5 == 0, F.substring("content", 1, 110))
        .when(F.col("result_id") % 7 == 0, F.replace("content", F.lit("\n\n"), F.lit("\n\nMZ")))
        .when(F.col("result_id") % 11 == 0, F.replace("content", F.lit("e"), F.lit("\x01")))
        .otherwise(F.col("content"))
    )
    return corpus.result(spark, sf_dir).withColumn("content", content)


def _with(more: str, sql: str) -> str:
    return f"{SQL}, {more} {sql}"


def made(sql: str) -> Callable[[Query], Query]:
    return query(_with(_MADE, sql), with_corpus=False)


_SYNC = """CASE WHEN content = '' THEN 'empty content' WHEN length(body) < 100 THEN 'content too short (' || length(body) || ' chars)' WHEN starts_with(body, 'MZ') THEN 'binary content detected (DOS/Windows EXE)'
    WHEN ratio < 0.85 THEN 'low printable ratio (' || printf('%.1f', ratio * 100) || '%)' END"""
_FLIGHT = """CASE WHEN content = '' THEN 'empty content' WHEN body = '' THEN 'no body after header' WHEN length(body) < 100 THEN 'body too short (' || length(body) || ' chars, need 100)'
    WHEN starts_with(body, 'MZ') THEN 'binary content (DOS/Windows EXE)' WHEN ratio < 0.85 THEN 'low printable ratio (' || printf('%.1f', ratio * 100) || '%, need 85%)' END"""


@made(f"SELECT result_id, {_SYNC} IS NULL AS valid, {_SYNC} AS reason FROM judged")
def validate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.with_reason(_made(spark, sf_dir)).select("result_id", F.col("reason").isNull().alias("valid"), "reason")


_STRICT = _SYNC.replace("< 100", "< 700").replace("< 0.85", "< 0.9")


@made(f"SELECT result_id, {_STRICT} AS reason FROM judged")
def validate_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation by thresholds that a session's settings give."""
    own = spark.newSession()
    own.conf.set(text.SETTINGS["min_length"][0], "700")
    own.conf.set(text.SETTINGS["min_printable"][0], "0.9")
    return text.with_reason(_made(spark, sf_dir), **text.thresholds(own)).select("result_id", "reason")


@made(f"SELECT {_FLIGHT} AS reason, count(*) AS documents FROM judged GROUP BY 1 HAVING reason IS NOT NULL")
def preflight_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preflight.reasons(preflight.scan(_made(spark, sf_dir)))


@made(f"SELECT count(*) AS total, count(*) FILTER ({_FLIGHT} IS NULL) AS valid, count(*) FILTER ({_FLIGHT} IS NOT NULL) AS problematic FROM judged")
def preflight_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preflight.tallies(preflight.scan(_made(spark, sf_dir)))


@made(f"SELECT v.result_id, v.category_id, v.match FROM result_category v JOIN judged j ON v.result_id = j.result_id WHERE {_FLIGHT} IS NULL")
def preflight_delete_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preflight.without(corpus.result_category(spark, sf_dir), preflight.scan(_made(spark, sf_dir))).select("result_id", "category_id", "match")


@made(f"""SELECT filepath, {_FLIGHT} AS reason, content_sha256 FROM judged WHERE {_FLIGHT} IS NOT NULL
    UNION ALL SELECT filepath, 'old' AS reason, 'old' AS content_sha256 FROM judged WHERE result_id % 3 = 0 AND {_FLIGHT} IS NULL""")
def excluded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    made_rows = _made(spark, sf_dir)
    stamp = F.lit(corpus.STAMP).cast("timestamp")
    before = made_rows.where("result_id % 3 = 0").select("filepath", F.lit("old").alias("reason"), F.lit("old").alias("content_sha256"), stamp.alias("excluded_at"))
    return preflight.excluded(before, preflight.scan(made_rows), stamp).select("filepath", "reason", "content_sha256")


_URL = "CASE WHEN page_id % 5 = 0 THEN url ELSE 'https://web.archive.org/web/20040701000000/' || url END"


def _archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.when(F.col("page_id") % 5 == 0, F.col("url")).otherwise(F.concat(F.lit("https://web.archive.org/web/20040701000000/"), "url"))
    return read(spark, sf_dir, "pages").select("page_id", url.alias("url"), "html")


@query(f"SELECT page_id, nullif(regexp_extract({_URL}, '^https?://web\\.archive\\.org/web/(\\d{{14}})/(.+)$', 1), '') AS archived_at, nullif(regexp_extract({_URL}, '^https?://web\\.archive\\.org/web/(\\d{{14}})/(.+)$', 2), '') AS original_url FROM pages", with_corpus=False)
def parse_archive_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return _archived(spark, sf_dir).select("page_id", text.archive_time(url).alias("archived_at"), text.archive_target(url).alias("original_url"))


_NAME = "substr(regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '^https?://', ''), '[/:?&=\\\\]', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g'), 1, 200) || '.md'"


@query(f"SELECT page_id, {_NAME.format('url')} AS filename FROM pages", with_corpus=False)
def make_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", text.file_name(F.col("url")).alias("filename"))


@query(f"SELECT {_NAME.format('url')} AS filename, min({_URL}) AS url FROM pages WHERE page_id % 5 <> 0 GROUP BY 1 HAVING min(page_id) % 3 <> 0", with_corpus=False)
def fetch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive URLs still to be fetched: files whose first page's number is divisible by three are there."""
    rows = _archived(spark, sf_dir)
    own = rows.where("page_id % 5 <> 0").groupBy(text.file_name(text.archive_target(F.col("url"))).alias("filename")).agg(F.min("page_id").alias("first"))
    return archive.planned(rows, own.where("first % 3 = 0")).where("error IS NULL").select("filename", "url")


@query("SELECT result_id, category_id, 'r' || result_id || '_c' || category_id AS custom_id, result_id AS parsed_result_id, category_id AS parsed_category_id FROM result_category")
def custom_id_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = corpus.result_category(spark, sf_dir).select("result_id", "category_id", text.custom_id(F.col("result_id"), F.col("category_id")).alias("custom_id"))
    rid, cid = text.custom_id_parts(F.col("custom_id"))
    return rows.select("*", rid.alias("parsed_result_id"), cid.alias("parsed_category_id"))


# Replies.  Documents' texts are the reasoning of made-up replies.

_OBJECTS = [
    '{"match": "yes", "n": {"x": 1}, "blockquotes": ["a}"]} rest', '{"match": 1, "blockquotes": ["q\\"{"]}{"match": 2}', '{"blockquotes": []}', "{'match': 1}{\"match\": 2}", '{"match": "no", "x": {"y": 1}', "",
]
#: What each of them holds: the object as a message shows it, the verdict and the quotes as JSON.
_SHOWN = ["{'match': 'yes', 'n': {'x': 1}, 'blockquotes': ['a}']}", "{'match': 1, 'blockquotes': ['q\"{']}", "{'blockquotes': []}"]
_HELD = [('"yes"', '["a}"]'), ("1", '["q\\"{"]')]


def _case(key: str, values: list[str]) -> str:
    quoted = (v.replace("'", "''") for v in values)
    return f"CASE {key} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(quoted)) + " END"


_REPLY = f"CASE WHEN doc_id % 6 = 5 THEN text ELSE '  ' || text || chr(10) || {_case('doc_id % 6', _OBJECTS)} END"


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    made_up = F.concat(F.lit("  "), "text", F.lit("\n"), F.element_at(F.array(*map(F.lit, _OBJECTS)), (F.col("doc_id") % 6 + 1).cast("int")))
    return read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 6 == 5, F.col("text")).otherwise(made_up).alias("reply"))


@query(f"""SELECT doc_id, CASE WHEN strpos(reply, '{{') = 0 THEN '' ELSE regexp_replace(substr(reply, 1, length(reply) - strpos(reverse(reply), '{{')), '^\\s+|\\s+$', '', 'g') END AS reasoning
    FROM (SELECT doc_id, {_REPLY} AS reply FROM documents)""", with_corpus=False)
def extract_reasoning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replies(spark, sf_dir).select("doc_id", text.reasoning_before_json(F.col("reply")).alias("reasoning"))


_MATCH, _QUOTES = (_case("doc_id % 6", [x[k] for x in _HELD]) for k in (0, 1))


@query(f"SELECT doc_id, doc_id % 6 < 3 AS found, doc_id % 6 < 2 AS has_match, {_MATCH} AS match, {_QUOTES} AS blockquotes, {_case('doc_id % 6', _SHOWN)} AS shown FROM documents", with_corpus=False)
def extract_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replies(spark, sf_dir).select("doc_id", strict_json.reply_object(F.col("reply")).alias("x")).select("doc_id", "x.*")


@query(f"""WITH r AS (SELECT doc_id, CASE WHEN doc_id % 5 = 1 THEN '' ELSE {_REPLY} END AS content, {_MATCH} AS match, {_QUOTES} AS quotes, {_case('doc_id % 6', _SHOWN)} AS shown FROM documents),
    f AS (SELECT *, CASE WHEN doc_id % 5 = 3 THEN 'HTTP error: HTTPError 500: no' WHEN doc_id % 5 = 4 THEN 'No choices in response' WHEN content = '' THEN 'Empty content in response'
        WHEN doc_id % 6 > 2 THEN 'No JSON found. Preview: ' || replace(substr(content, 1, 200), chr(10), ' ') || '...' WHEN doc_id % 6 = 2 THEN 'Missing ''match'' field: ' || shown END AS failure,
      CASE WHEN doc_id % 5 = 2 THEN 'thought' ELSE regexp_replace(substr(content, 1, length(content) - strpos(reverse(content), '{{')), '^\\s+|\\s+$', '', 'g') END AS trace FROM r)
    SELECT 'r' || doc_id || '_c1' AS custom_id, failure, CASE WHEN failure IS NULL THEN '{{"result_id": ' || doc_id || ', "category_id": 1, "match": ' || match || ', "reasoning_trace": ' || to_json(trace)::VARCHAR || ', "blockquotes": ' || quotes || '}}' END AS record FROM f""", with_corpus=False)
def parse_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of all kinds through the ladder of failures."""
    k = F.col("doc_id") % 5
    rows = _replies(spark, sf_dir).select(
        text.custom_id(F.col("doc_id"), F.lit(1)).alias("custom_id"), F.when(k == 1, "").otherwise(F.col("reply")).alias("content"),
        F.when(k == 2, "thought").alias("reasoning_content"), F.when(k == 3, "HTTPError 500: no").alias("error"), (k != 3).alias("has_response"), (k != 4).alias("has_choices"),
    )
    return strict_json.parse_replies(rows).select("custom_id", "record", "failure")


# Import.  The variant of a document's record is the last digit of its number; a second file says "no" of every fourth.


def _import_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id")
    head = F.concat(F.lit('{"result_id": '), F.col("doc_id").cast("string"), F.lit(', "category_id": 1'))
    tails = [
        ', "match": "yes", "reasoning_trace": "first", "blockquotes": ["a}", "b"]}', ', "match": 1, "reasoning_trace": null}', ', "match": "YES"}', ', "match": null}', "}", "not json {{{", ', "match": "yes"} x',
        ', "match": "no", "blockquotes": "xyz"}', ', "match": "maybe", "blockquotes": ["p", null, "q"]}', ', "match": ["yes"]}',
    ]
    tail = F.element_at(F.array(*map(F.lit, tails)), (F.col("doc_id") % 10 + 1).cast("int"))
    value = F.when(F.col("doc_id") % 10 == 5, tail).otherwise(F.concat(head, tail))
    first = d.select(F.lit(0).alias("source_rank"), F.lit("results.jsonl").alias("source"), F.col("doc_id").alias("line"), value.alias("value"))
    name = F.concat(text.custom_id(F.col("doc_id"), F.lit(1)), F.lit(".json"))
    second = F.concat(head, F.lit(', "match": "no", "reasoning_trace": "second", "blockquotes": [7]}'))
    return first.unionByName(d.where("doc_id % 4 = 0").select(F.lit(1).alias("source_rank"), name.alias("source"), F.lit(0).cast("bigint").alias("line"), second.alias("value")))


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = read(spark, sf_dir, "documents").where("doc_id % 50 = 0").select(F.col("doc_id").alias("result_id"), F.lit(1).cast("bigint").alias("category_id"))
    return importer.classify(_import_records(spark, sf_dir), known)


_KNOWN = "WHEN doc_id % 50 = 0 THEN 'skipped'"
_IMPORT = """WITH r AS (
      SELECT doc_id, 0 AS rank, CASE doc_id % 10 WHEN 0 THEN 'yes' WHEN 1 THEN '1' WHEN 7 THEN 'no' WHEN 8 THEN 'maybe' END AS match,
        CASE WHEN doc_id % 10 = 0 THEN 'first' WHEN doc_id % 10 = 1 THEN NULL ELSE '' END AS trace, doc_id % 10 IN (2, 3) AS ignored, doc_id % 10 = 8 AS bad,
        CASE doc_id % 10 WHEN 0 THEN ['a}', 'b'] WHEN 7 THEN ['x', 'y', 'z'] WHEN 8 THEN ['p'] ELSE [] END AS quotes FROM documents
      UNION ALL SELECT doc_id, 1, 'no', 'second', false, false, ['7'] FROM documents WHERE doc_id % 4 = 0),
    o AS (SELECT *, CASE WHEN ignored THEN 'skipped' WHEN match IS NULL THEN 'error' """ + _KNOWN + """
      WHEN row_number() OVER (PARTITION BY doc_id, match IS NULL ORDER BY rank) = 1 THEN 'imported' ELSE 'skipped' END AS outcome FROM r)"""


@query(f"{_IMPORT} SELECT doc_id AS result_id, 1::BIGINT AS category_id, match, trace AS reasoning_trace FROM o WHERE outcome = 'imported'", with_corpus=False)
def import_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importer.new_verdicts(_classified(spark, sf_dir))


@query(f"""{_IMPORT} SELECT count(*) AS total, count(*) FILTER (outcome = 'imported') AS imported, count(*) FILTER (outcome = 'skipped') AS skipped,
    count(*) FILTER (outcome = 'error') + count(*) FILTER (outcome = 'imported' AND bad) AS errors, coalesce(sum(len(quotes)) FILTER (outcome = 'imported'), 0)::BIGINT AS blockquotes FROM o""", with_corpus=False)
def import_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importer.tallies(_classified(spark, sf_dir))


@query(f"{_IMPORT} SELECT doc_id AS result_id, 1::BIGINT AS category_id, (k - 1)::INT AS position, quotes[k] AS blockquote FROM o, unnest(range(1, len(quotes) + 1)) x(k) WHERE outcome = 'imported'", with_corpus=False)
def blockquote_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importer.new_quotes(_classified(spark, sf_dir)).select("result_id", "category_id", "position", "blockquote")


@query("SELECT DISTINCT doc_id AS result_id, 1::BIGINT AS category_id FROM documents WHERE doc_id % 10 NOT IN (5, 6) OR doc_id % 4 = 0", with_corpus=False)
def completed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.completed_pairs(_import_records(spark, sf_dir))


@query("SELECT result_id, category_id FROM pending WHERE NOT (category_id = 1 AND result_id IN (SELECT doc_id FROM documents WHERE doc_id % 10 NOT IN (5, 6) OR doc_id % 4 = 0))")
def completed_pairs_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pending(corpus.corpus(spark, sf_dir), completed=files.completed_pairs(_import_records(spark, sf_dir)))


# Sync.


_DIGIT = "ascii(right(category_name, 1))"


@query(f"""WITH {corpus.SOURCES} SELECT category_filename, CASE WHEN {_DIGIT} % 3 = 0 THEN 'edited' ELSE prompt_sha256 END AS prompt_sha256, category_name FROM sources
    WHERE {_DIGIT} % 2 = 0 OR {_DIGIT} % 3 = 0""", with_corpus=False)
def category_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories of the documents' sources that aren't in the table as they are: half are known, a third has been edited."""
    rows = corpus.sources(spark, sf_dir)
    digit = F.ascii(F.right("category_name", F.lit(1)))
    seen = rows.withColumn("prompt_sha256", F.when(digit % 3 == 0, "edited").otherwise(F.col("prompt_sha256")))
    return prep.new_categories(seen, rows.where(digit % 2 == 1)).select("category_filename", "prompt_sha256", "category_name")


@query(_with(_MADE, f"SELECT filepath, content_sha256, {_SYNC} AS reason FROM judged WHERE result_id % 3 <> 0"), with_corpus=False)
def document_sync_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files not in the table: a third is there as it is, a third with another hash."""
    rows = _made(spark, sf_dir)
    digest = F.when(F.col("result_id") % 3 == 1, "old").otherwise(F.col("content_sha256"))
    known = rows.where("result_id % 3 <> 2").select("filepath", digest.alias("content_sha256"))
    return prep.new_documents(rows.select("filepath", "content", "content_sha256"), known).select("filepath", "content_sha256", "reason")


@query(f"SELECT filepath, (row_number() OVER (ORDER BY filepath) + 10)::BIGINT AS result_id FROM result WHERE part_number IS NULL")
def document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive ids in path order, from 11."""
    rows = corpus.result(spark, sf_dir).where("part_number IS NULL").select("filepath", "content", "content_sha256")
    return prep.with_ids(prep.document_rows(rows, limit=1 << 30), 11).select("filepath", "result_id")


# Paragraphs of 60 characters, each of which fills a part: a document has as many parts as paragraphs.
_SIZES = "doc_id % 5 + 1"
_PARTED = f"""p AS (SELECT doc_id, source || '/' || doc_id || '.md' AS path, k, substr(sha256(doc_id || '-' || k), 1, 60) AS body FROM documents, unnest(range(1, {_SIZES} + 1)) u(k)),
    w AS (SELECT path, 0 AS k, NULL::INT AS part_number, 'head' || chr(10) || chr(10) || string_agg(body, chr(10) || chr(10) ORDER BY k) AS content FROM p GROUP BY path),
    every AS (SELECT path, k, part_number, content, path AS filepath FROM w UNION ALL SELECT path, k, k::INT, 'head' || chr(10) || chr(10) || body, path || '_' || k FROM p WHERE doc_id % 5 > 0),
    numbered AS (SELECT *, (row_number() OVER (ORDER BY path, k) + 10)::BIGINT AS result_id FROM every)"""


@query(f"""WITH {_PARTED} SELECT result_id, filepath, part_number, sha256(content) AS content_sha256,
    CASE WHEN part_number IS NOT NULL THEN first_value(result_id) OVER (PARTITION BY path ORDER BY k) END AS parent_result_id FROM numbered""", with_corpus=False)
def part_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of split documents: consecutive ids from 11 in path order, a document before its parts."""
    k = F.sequence(F.lit(1), (F.col("doc_id") % 5 + 1).cast("int"))
    body = F.array_join(F.transform(k, lambda n: F.substring(F.sha2(F.concat_ws("-", F.col("doc_id").cast("string"), n.cast("string")), 256), 1, 60)), "\n\n")
    rows = read(spark, sf_dir, "documents").select(F.format_string("%s/%d.md", "source", "doc_id").alias("filepath"), F.concat(F.lit("head\n\n"), body).alias("content"))
    rows = prep.document_rows(rows.withColumn("content_sha256", F.sha2("content", 256)), limit=66, size=70, overlap=0)
    return prep.with_ids(rows, 11).select("result_id", "filepath", "part_number", "content_sha256", "parent_result_id")


@query(f"SELECT result_id, true AS fits, sha256(regexp_replace({_BODY}, '\\s+', '', 'g')) AS text_sha256 FROM result WHERE part_number IS NULL AND length(content) > {LARGE}")
def split_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without overlaps the parts of a document hold its text, in order and once, but for white space at their ends."""
    rows = corpus.result(spark, sf_dir).where("part_number IS NULL").select("result_id", "content")
    parts = split.split_documents(rows, limit=LARGE, size=3000, overlap=0).select("result_id", "part_number", text.content_body(F.col("part_content")).alias("body"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part_number", "body"))), lambda p: p["body"]), "")
    return parts.groupBy("result_id").agg((F.max(F.length("body")) <= 3000).alias("fits"), F.sha2(F.regexp_replace(whole, r"\s+", ""), 256).alias("text_sha256"))


@query()
def split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of documents above 4000 characters, so that small scales split too."""
    rows = corpus.result(spark, sf_dir).where("part_number IS NULL").select("result_id", "content")
    return split.split_documents(rows, limit=LARGE, size=3000, overlap=100).select("result_id", "part_number", F.length("part_content").alias("n_chars"), F.sha2("part_content", 256).alias("part_sha256"))


@query()
def fetch_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pages as markdown documents, and the rows that are no archive URLs."""
    return archive.fetch_stored(_archived(spark, sf_dir)).select("url", "filename", F.sha2("content", 256).alias("content_sha256"), "error")


@query()
def html_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", html_to_markdown(F.col("html")).alias("markdown"))


# Inference and runs.


@query(f"""SELECT custom_id, result_id, category_id, 'saved' AS outcome, 1 AS attempts, '{{"result_id": ' || result_id || ', "category_id": ' || category_id || ', "match": "' || CASE WHEN len(hits) > 1 THEN 'yes' WHEN len(hits) = 1 THEN 'maybe' ELSE 'no' END
      || '", "reasoning_trace": "' || len(hits) || ' lines hold a term.", "blockquotes": [' || array_to_string(list_transform(hits, lambda x: to_json(x)::VARCHAR), ', ') || ']}}' AS record
    FROM (SELECT 'r' || p.result_id || '_c' || p.category_id AS custom_id, p.result_id, p.category_id,
        list_filter(list_transform(string_split(r.content, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: p.category_id % 2 = 1 AND contains(lower(x), lower(c.category_name))) AS hits
      FROM pending p JOIN result r ON p.result_id = r.result_id JOIN category c ON p.category_id = c.category_id)""")
def infer_rule_backend(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = infer.infer(_requests(spark, sf_dir), infer.Rules(), concurrency=2)
    none = spark.createDataFrame([], "result_id bigint, category_id bigint")
    return infer.outcomes(replies, none).select("custom_id", "result_id", "category_id", "outcome", "record", "attempts")


@query("""SELECT run_id, started_at, finished_at, pairs_processed FROM run_stats""")
def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest state of runs from begin and end events."""
    ended = corpus.run_stats(spark, sf_dir)
    begun = ended.withColumn("finished_at", F.lit(None).cast("timestamp_ntz"))
    return ledger.latest(begun.unionByName(ended.where("finished_at IS NOT NULL"))).select("run_id", "started_at", "finished_at", "pairs_processed")


@query("SELECT printf('%.2fs', avg(value)) AS request_time_avg, printf('%.2fs', min(value)) AS request_time_min, printf('%.2fs', max(value)) AS request_time_max FROM events", with_corpus=False)
def request_time_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infer.request_times(read(spark, sf_dir, "events").select(F.col("value").alias("elapsed_sec")))


@query("""SELECT count(*) AS processed, count(*) FILTER (event_type = 'click') AS saved, count(*) FILTER (event_type = 'view') AS skipped, count(*) FILTER (event_type NOT IN ('click', 'view')) AS failed,
    sum(value::DECIMAL(18,2))::DOUBLE AS processing_seconds FROM events""", with_corpus=False)
def run_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "click", "saved").when(F.col("event_type") == "view", "skipped").otherwise("failed")
    rows = read(spark, sf_dir, "events").select(kind.alias("outcome"), F.col("value").cast("decimal(18,2)").alias("elapsed_sec"))
    return infer.run_tallies(rows).withColumn("processing_seconds", F.col("processing_seconds").cast("double"))


@query(f"{_IMPORT.replace(_KNOWN, '')} SELECT doc_id AS result_id, 1::BIGINT AS category_id, match, trace AS reasoning_trace FROM o WHERE outcome = 'imported'", with_corpus=False)
def stream_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies that arrive as files, imported by a stream into a store of the shared checkpoint folder.

    Files of a second source come after the first run; the stream goes on where it was, and the first record of a pair stays.
    """
    from ..streaming.imports import stream_import as start

    folder = new_folder(spark, "stream")
    store = CorpusStore(spark, f"{folder}/store")
    store.create()
    records = _import_records(spark, sf_dir)
    for rank in (0, 1):
        records.where(F.col("source_rank") == rank).select("value").write.mode("append").text(f"{folder}/replies")
        start(store, f"{folder}/replies", f"{folder}/checkpoint", glob="part-*", by_line=True).awaitTermination()
    return store.read("result_category").select("result_id", "category_id", "match", "reasoning_trace")


@query("""SELECT doc_id AS result_id, k AS category_id, CASE WHEN k = 1 THEN 'yes' ELSE 'maybe' END AS match, 'first of ' || length(coalesce(text, '')) AS reasoning_trace
    FROM documents, (VALUES (1::BIGINT), (2::BIGINT)) c(k)""", with_corpus=False)
def stream_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of large files, read in many splits, that say two things of each pair: the first in its file is imported."""
    from ..streaming.imports import stream_import as start

    folder = new_folder(spark, "splits")
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    store = CorpusStore(own, f"{folder}/store")
    store.create()
    n = F.length(F.coalesce("text", F.lit(""))).cast("string")
    line = lambda k, match, trace: F.concat(F.lit('{"result_id": '), F.col("doc_id").cast("string"), F.lit(f', "category_id": {k}, "match": "{match}", "reasoning_trace": "'), trace, F.lit('"}'))
    first, later = F.concat(F.lit("first of "), n), F.lit("later")
    lines = F.array(line(1, "yes", first), line(2, "maybe", first), line(2, "no", later), line(1, "no", later))
    read(spark, sf_dir, "documents").select(F.explode(lines).alias("value")).write.text(f"{folder}/replies")
    start(store, f"{folder}/replies", f"{folder}/checkpoint", glob="part-*", by_line=True).awaitTermination()
    return store.read("result_category").select("result_id", "category_id", "match", "reasoning_trace")


from . import file_queries  # noqa: E402, F401  they register themselves here
