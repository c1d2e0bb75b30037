"""A web archive as a source: archived pages to markdown documents.

The network is behind a fetcher, so the same plan runs over stored pages.
Failures are rows, not exceptions: a bad URL costs its own row alone.
"""

from __future__ import annotations

import json
import re
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..arrow import in_slices, ready
from ..functions.markdown import html_to_markdown
from . import files

#: The archive's endpoints, and the demonstration's pages.
INDEX = "http://web.archive.org/cdx/search/cdx"
PAGE = "https://web.archive.org/web/{time}id_/{url}"
DEMO_URLS = [
    "https://web.archive.org/web/20040701020553/http://www.kidlink.org:80/KIDFORUM/",
    "https://web.archive.org/web/20040701022600/http://www.kidlink.org:80/KIDPROJ/Capitals97/introductions.html",
    "https://web.archive.org/web/20040701031153/http://www.kidlink.org:80/KIDPROJ/MCC/mcc0539.html",
    "https://web.archive.org/web/20040630084635/http://www.kidlink.org:80/spanish/",
    "https://web.archive.org/web/19970404181846/http://www.kidpub.org:80/kidpub/kidpub-newest.html",
]
TIMEOUT = 30
#: Pages fetched into one batch.
PAGES = 64


class Fetcher(Protocol):
    def fetch(self, time: str, url: str) -> str:
        """The page's HTML; raises if there is none."""
        ...


@dataclass(frozen=True)
class Web:
    """The archive itself: the snapshot is looked up in the index, then downloaded."""

    timeout: float = TIMEOUT

    def exists(self, time: str, url: str) -> bool:
        query = urllib.parse.urlencode({"url": url, "output": "json", "from": time, "to": time, "limit": "1"})
        with urllib.request.urlopen(f"{INDEX}?{query}", timeout=self.timeout) as reply:
            return len(json.loads(reply.read() or b"[]")) > 1

    def fetch(self, time: str, url: str) -> str:
        if not self.exists(time, url):
            raise LookupError(f"no snapshot of {url} at {time}")
        with urllib.request.urlopen(PAGE.format(time=time, url=url), timeout=self.timeout) as reply:
            if not is_page(reply.headers.get_content_type()):
                raise ValueError(f"no page but {reply.headers.get_content_type()}")
            return reply.read().decode(reply.headers.get_content_charset() or "utf-8", "replace")


def is_page(media_type: str) -> bool:
    """Whether a media type is text or any form of HTML."""
    return re.search(r"^text/|html", media_type) is not None


def snapshot_exists(index_reply: Column) -> Column:
    """Whether an index reply (JSON rows, the first a header) lists a snapshot."""
    return F.coalesce(F.size(F.from_json(index_reply, "array<array<string>>")) > 1, F.lit(False))


def planned(urls: DataFrame, known_files: DataFrame | None = None) -> DataFrame:
    """``url, time, target, filename, error`` of archive URLs (column ``url``); URLs whose file is there are left out.

    Of several URLs with one file name the first in order of URLs is fetched: they are the same page to the store.
    """
    url = F.col("url")
    rows = urls.select("url", text.archive_time(url).alias("time"), text.archive_target(url).alias("target"))
    rows = rows.withColumn("filename", text.file_name(F.col("target")))
    rows = rows.withColumn("error", F.when(F.col("time").isNull(), F.concat(F.lit("not an archive URL: "), F.coalesce("url", F.lit("null")))))
    good = rows.where("error IS NULL").groupBy("filename").agg(F.min(F.struct("url", "time", "target")).alias("x")).select("x.url", "x.time", "x.target", "filename", F.lit(None).cast("string").alias("error"))
    if known_files is not None:
        good = good.join(known_files.select("filename"), "filename", "left_anti").select("url", "time", "target", "filename", "error")
    return good.unionByName(rows.where("error IS NOT NULL"))


def documents_of(rows: DataFrame) -> DataFrame:
    """``url, filename, content, error`` of fetched rows (``time, target, filename, html, error``): a header, a blank line, markdown."""
    header = F.concat("time", F.lit("/"), "target", F.lit("\n\n"))
    return rows.select("url", "filename", F.when(F.col("error").isNull(), F.concat(header, html_to_markdown(F.col("html")))).alias("content"), "error")


def fetch(urls: DataFrame, fetcher: Fetcher, known_files: DataFrame | None = None) -> DataFrame:
    """Documents of archive URLs, or the reasons why there are none."""
    ready(urls.sparkSession)
    plan = planned(urls, known_files)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_slices(batches, PAGES):
            html, errors = [], []
            for time, target, error in zip(batch["time"], batch["target"], batch["error"]):
                page = None
                if error is None:
                    try:
                        page = fetcher.fetch(time, target)
                    except Exception as e:  # noqa: BLE001  one page's failure is that page's row
                        error = f"{type(e).__name__}: {e}"
                html.append(page)
                errors.append(error)
            yield batch.assign(html=html, error=errors)[["url", "time", "target", "filename", "html", "error"]]

    return documents_of(plan.mapInPandas(run, "url string, time string, target string, filename string, html string, error string"))


def fetch_stored(pages: DataFrame, known_files: DataFrame | None = None) -> DataFrame:
    """The same over stored pages (``url, html``), without a network."""
    plan = planned(pages.select("url"), known_files)
    first = pages.groupBy("url").agg(F.min("html").alias("html"))
    return documents_of(plan.join(first, "url", "left"))


def write_markdown(documents: DataFrame, folder: str) -> DataFrame:
    """Write documents as files of a folder that all executors share; ``filename, status`` (written, exists or failed).

    Files are written as ``files.write_once`` does, so a task may run twice.
    """
    ready(documents.sparkSession)
    folder = files.whole_path(folder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = batch["error"].isna()
            new = [files.write_once(folder, n, c.encode()) if ok else None for n, c, ok in zip(batch["filename"], batch["content"], good)]
            status = [{True: "written", False: "exists", None: "failed"}[x] for x in new]
            yield pd.DataFrame({"url": batch["url"], "filename": batch["filename"], "status": status, "error": batch["error"]})

    return documents.select("url", "filename", "content", "error").mapInPandas(run, "url string, filename string, status string, error string")


def demo_urls(spark: SparkSession, urls: list[str] | None = None) -> DataFrame:
    return spark.createDataFrame([(u,) for u in (DEMO_URLS if urls is None else urls)], "url string")
