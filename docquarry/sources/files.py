"""Files as sources: documents, category prompts, replies."""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text

#: Names of reply files, one pair each.
REPLY_FILE = r"^r(\d+)_c(\d+)\.json$"


#: Pieces of a scan that a task reads, at most: Spark counts 4 MB to open a file, so a piece is some 30 small files.
PIECES = 32


def together(files: DataFrame) -> DataFrame:
    """A scan of many files in fewer tasks: each reads several of Spark's pieces, one after another, and nothing is shuffled.

    Small files make a task of few of them cost more than their reading does.  All cores get some tasks each.
    """
    pieces, cores = files.rdd.getNumPartitions(), files.sparkSession.sparkContext.defaultParallelism
    return files.coalesce(max(4 * cores, -(-pieces // PIECES)))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """``filepath, content, content_sha256, valid_utf8`` of a folder's ``*.md`` files, in no order.

    The hash is that of the bytes; line ends of the content are ``\\n``.  Bytes
    that are no UTF-8 give a null content, and the row is for the caller to reject.
    """
    files = together(spark.read.format("binaryFile").option("pathGlobFilter", "*.md").load(folder))
    good = F.is_valid_utf8(F.col("content").cast("string"))
    decoded = F.when(good, text.universal_newlines(F.col("content").cast("string")))
    path = F.regexp_replace("path", "^file:", "")
    return files.select(path.alias("filepath"), decoded.alias("content"), F.sha2("content", 256).alias("content_sha256"), good.alias("valid_utf8"))


def parse_prompt(source: str) -> dict[str, str]:
    """The keys of a category file; without a YAML library, flat keys and block texts."""
    try:
        import yaml

        return {str(k): v for k, v in (yaml.safe_load(source) or {}).items()}
    except ImportError:
        pass
    out: dict[str, str] = {}
    key, block = None, None
    for line in source.splitlines():
        if block is not None and (not line.strip() or line.startswith("  ")):
            out[key] = f"{out[key]}{line[2:]}\n"
            continue
        block = None
        if m := re.match(r"([A-Za-z_]\w*):\s*(.*)$", line):
            key, value = m[1], m[2].strip()
            if value in ("|", "|-", ">"):
                out[key], block = "", value
            else:
                out[key] = value.strip("\"'")
    return {k: v.strip("\n") + "\n" if "\n" in v else v for k, v in out.items()}


def categories(spark: SparkSession, folder: str) -> DataFrame:
    """``category_filename, category_name, category_description, prompt, prompt_sha256`` of ``*.yaml`` files.

    The files are a hand-written dimension of a few rows, so they are read by
    the driver, through Spark's reader.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.yaml").load(folder).select(F.regexp_extract("path", "[^/]*$", 0).alias("name"), "content")
    rows = []
    for f in sorted(files.collect()):
        data = parse_prompt(bytes(f.content).decode())
        prompt = data.get("prompt", "")
        rows.append((f.name, data.get("name", f.name.rsplit(".", 1)[0]), data.get("description", ""), prompt, hashlib.sha256((prompt or "").encode()).hexdigest()))
    return spark.createDataFrame(rows, "category_filename string, category_name string, category_description string, prompt string, prompt_sha256 string")


def write_prompts(categories: DataFrame, folder: str) -> DataFrame:
    """Write categories (``category_filename, category_name, category_description, prompt``) as prompt files, each once; ``category_filename, saved``."""
    from ..arrow import ready

    ready(categories.sparkSession)
    folder = whole_path(folder)
    quoted = lambda x: "'" + str(x or "").replace("'", "''") + "'"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            saved = []
            for name, title, about, prompt in zip(*(batch[c] for c in ("category_filename", "category_name", "category_description", "prompt"))):
                block = "".join(f"  {x}\n" if x else "\n" for x in (prompt or "").rstrip("\n").split("\n"))
                saved.append(write_once(folder, name, f"name: {quoted(title)}\ndescription: {quoted(about)}\nprompt: |\n{block}".encode()))
            yield pd.DataFrame({"category_filename": batch["category_filename"], "saved": saved})

    return categories.select("category_filename", "category_name", "category_description", "prompt").mapInPandas(run, "category_filename string, saved boolean")


def system_prompt(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def placed(lines: DataFrame, rank: int) -> DataFrame:
    """``source_rank, source, line, value`` of lines with their file and the byte where their split of it begins.

    Lines keep their order, as the first record of a pair wins: ``source`` is the
    file's name and that byte, ``line`` grows within a split.  So a large file is many tasks.
    """
    source = F.format_string("%s@%020d", "file_name", "file_block_start")
    # The lower bits count rows of a task, which reads its splits one after another.
    line = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    lines = lines.select(F.lit(rank).alias("source_rank"), source.alias("source"), line.alias("line"), "value")
    return lines.withColumn("value", text.strip(F.col("value"))).where("value <> ''")


def jsonl_records(spark: SparkSession, path: str, rank: int = 0) -> DataFrame:
    """The records of a JSONL file's lines in their order, blank lines left out."""
    return placed(spark.read.text(path).select("value", "_metadata.file_name", "_metadata.file_block_start"), rank)


def json_files(spark: SparkSession, folder: str, rank: int = 1) -> DataFrame:
    """The same of a folder's reply files, one record each."""
    files = spark.read.option("pathGlobFilter", "r*_c*.json").text(folder, wholetext=True)
    return together(files.select(F.lit(rank).alias("source_rank"), F.col("_metadata.file_name").alias("source"), F.lit(0).cast("long").alias("line"), "value"))


def exists(spark: SparkSession, path: str, glob: str | None = None) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path if glob is None else f"{path}/{glob}")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return bool(found) and len(found) > 0


def reply_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records of a folder: ``results.jsonl`` first, then reply files, then replies written by ``process``."""
    out = spark.createDataFrame([], "source_rank int, source string, line long, value string")
    if exists(spark, folder, "results.jsonl"):
        out = out.union(jsonl_records(spark, f"{folder}/results.jsonl"))
    if exists(spark, folder, "r*_c*.json"):
        out = out.union(json_files(spark, folder))
    if exists(spark, folder, "replies"):  # some folders deep; a pair that failed has no record
        saved = spark.read.schema("custom_id string, record string").option("recursiveFileLookup", True).parquet(f"{folder}/replies").where("record IS NOT NULL")
        out = out.union(saved.select(F.lit(2).alias("source_rank"), "custom_id", F.lit(0).cast("long"), "record"))
    return out


def whole_path(folder: str) -> str:
    """A folder's path as executors need it: a URI stays, a local path becomes absolute."""
    return folder if re.match(r"\w+:/", folder) else os.path.abspath(folder)


def write_once(folder: str, name: str, data: bytes) -> bool:
    """Put a file into a folder (a path or URI of any file system that Arrow knows); False if it is there already.

    The bytes go into a hidden file, which a move makes the file: it appears whole or not at all.
    """
    system, root = pafs.FileSystem.from_uri(folder)
    final, hidden = f"{root}/{name}", f"{root}/.{uuid.uuid4().hex}"
    if system.get_file_info(final).type != pafs.FileType.NotFound:
        return False
    system.create_dir(root)
    with system.open_output_stream(hidden) as out:
        out.write(data)
    system.move(hidden, final)
    return True


def write_replies(replies: DataFrame, folder: str) -> DataFrame:
    """Write replies (``custom_id, record``) as files of a folder that all executors share; ``custom_id, saved``.

    ``saved`` is false where a file is there already.
    """
    from ..arrow import ready

    ready(replies.sparkSession)
    folder = whole_path(folder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            saved = [write_once(folder, f"{name}.json", json.dumps(json.loads(record), indent=2).encode()) for name, record in zip(batch["custom_id"], batch["record"])]
            yield pd.DataFrame({"custom_id": batch["custom_id"], "saved": saved})

    return replies.select("custom_id", "record").mapInPandas(run, "custom_id string, saved boolean")


def completed_pairs(records: DataFrame) -> DataFrame:
    """Distinct pairs that have a reply: by a reply file's name, else by a record's ids; bad lines don't count."""
    from ..functions.strict_json import parse_records

    named = records.where("source_rank = 1").select(F.regexp_extract("source", REPLY_FILE, 1).try_cast("long").alias("result_id"), F.regexp_extract("source", REPLY_FILE, 2).try_cast("long").alias("category_id"))
    # A pair is completed even if its verdict is missing: only the ids count.
    told = parse_records(records.where("source_rank <> 1")).select("record.result_id", "record.category_id")
    return named.union(told).where("result_id IS NOT NULL AND category_id IS NOT NULL").distinct()
