"""Archive records as a source: WARC files, an index of their records, and reads by byte ranges.

``write_archives`` puts pages into WARC files, each record a gzip member of its
own, and gives the index: a record's file, offset and length.  The data source
``archive_records`` reads the records that an index names and nothing else of
the archives: its partitions are pieces of the index (files or row groups of
Parquet), so the plan holds no list of records, and a task reads its ranges in
the order of the files, neighbours together.  ``fetch_records`` asks for the
archived pages of URLs: the index is joined and filtered by Spark, the ranges
are read where the index rows are.

A location is a path or URI of any file system that Arrow knows, or an ``http``
URL, which is asked for the range alone.  What can't be read is a row with
``error``: a range outside its file, bytes that are no record, a digest that
isn't the block's.  Writing is once: a task that runs again leaves the same file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.request
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from ..arrow import ready
from . import archive, files

#: Bytes of an archive, about; bytes read at once at most; a gap between ranges that is read over.
ARCHIVE_BYTES, READ_BYTES, GAP = 16 << 20, 8 << 20, 16 << 10
#: A record's bytes when it is unpacked, at most: beyond that it is an error, not a task without memory.
MOST_BYTES = 256 << 20
#: An index file above this is read by its row groups.
INDEX_BYTES = 8 << 20
TIMEOUT = 60
#: Spark's setting that hands filters to Python sources.
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

INDEX = "url string, time string, archive string, offset long, length long"
RECORDS = f"{INDEX}, type string, media_type string, status int, payload string, payload_sha256 string, error string"
_SCHEMA = pa.schema([(x.split(" ")[0], {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[x.split(" ")[1]]) for x in RECORDS.split(", ")])


# Writing.


def record(url: str, time: str, page: str) -> bytes:
    """A page as a WARC response record, packed."""
    payload = page.encode("utf-8", "replace")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    day, clock = (time or "").ljust(14, "0")[:8], (time or "").ljust(14, "0")[8:14]
    head = {
        "WARC-Type": "response",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{time} {url}')}>",
        "WARC-Target-URI": re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or ""),
        "WARC-Date": f"{day[:4]}-{day[4:6]}-{day[6:]}T{clock[:2]}:{clock[2:4]}:{clock[4:]}Z",
        "WARC-Block-Digest": f"sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    packer = zlib.compressobj(wbits=31)
    return packer.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n") + packer.flush()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write pages (``url, time, html``) as archives of a folder that all executors share; their index."""
    ready(pages.sparkSession)
    folder = files.whole_path(folder)
    names = [x.split(" ")[0] for x in INDEX.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, parts, size = [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal size
            data = b"".join(parts)
            name = f"{hashlib.sha256(data).hexdigest()[:32]}.warc.gz"
            files.write_once(folder, name, data)
            out = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([name] * len(rows)), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())], names)
            rows.clear()
            parts.clear()
            size = 0
            return out

        for batch in batches:
            for url, time, page in zip(*(c.to_pylist() for c in batch.columns)):
                parts.append(record(url, time, page or ""))
                rows.append((url, time, size, len(parts[-1])))
                size += len(parts[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
        if rows:
            yield close()

    return pages.select("url", "time", "html").mapInArrow(run, INDEX)


# Reading.


def _range(location: str, offset: int, length: int) -> bytes:
    if location.startswith(("http://", "https://")):
        request = urllib.request.Request(location, headers={"Range": f"bytes={offset}-{offset + length - 1}"})
        with urllib.request.urlopen(request, timeout=TIMEOUT) as reply:
            data = reply.read(offset + length if reply.status == 200 else length)
            return data[offset:] if reply.status == 200 else data  # a server that knows no ranges sends all
    system, path = pafs.FileSystem.from_uri(location)
    with system.open_input_file(path) as stream:
        return stream.read_at(length, offset)


def unpacked(data: bytes) -> bytes:
    if not data.startswith(b"\x1f\x8b"):
        return data
    member = zlib.decompressobj(31)
    out = member.decompress(data, MOST_BYTES)
    if not member.eof:
        raise ValueError("a member that is cut short" if len(out) < MOST_BYTES else f"a record above {MOST_BYTES} bytes")
    return out


def read_record(data: bytes) -> dict:
    """``type, media_type, status, payload`` of a record's bytes, plain or packed; raises for what is none."""
    data = unpacked(data)
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/"):
        raise ValueError("no record")
    named = _headers(head)
    size = named.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", size) or len(rest) < int(size):
        raise ValueError("a record without its declared length")
    block = rest[: int(size)]
    kind, _, digest = named.get("warc-block-digest", "").partition(":")
    if kind.lower() == "sha1" and digest.upper() != base64.b32encode(hashlib.sha1(block).digest()).decode():
        raise ValueError("a block with another digest than declared")
    out = {"type": named.get("warc-type"), "media_type": named.get("content-type"), "status": None, "payload": block}
    if block.startswith(b"HTTP/"):
        head, _, out["payload"] = block.partition(b"\r\n\r\n")
        status = re.match(rb"HTTP/[0-9.]+ +([0-9]{3})\b", head)
        out |= {"status": int(status[1]) if status else None, "media_type": _headers(head).get("content-type")}
    charset = re.search(r"charset=[\"']?([\w.:-]+)", out["media_type"] or "", re.I)
    try:
        out["payload"] = out["payload"].decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        out["payload"] = out["payload"].decode("utf-8", "replace")
    return out


def _headers(head: bytes) -> dict[str, str]:
    lines = (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, colon, value in lines if colon}


def _stretches(rows: list[tuple]) -> Iterator[list[tuple]]:
    """Rows of the index in the order of their places, those of near ranges together."""
    held: list[tuple] = []
    for row in sorted(rows, key=lambda r: (r[2] or "", r[3] or 0, r[4] or 0)):
        good = row[2] is not None and row[3] is not None and row[4] is not None and row[3] >= 0 and row[4] > 0
        near = held and good and row[2] == held[0][2] and row[3] <= max(r[3] + r[4] for r in held[-1:]) + GAP and row[3] + row[4] - held[0][3] <= READ_BYTES
        if held and not near:
            yield held
            held = []
        if not good:
            yield [row]
            continue
        held.append(row)
    if held:
        yield held


def read_ranges(folder: str, rows: list[tuple]) -> Iterator[tuple]:
    """Rows of ``RECORDS`` for rows of ``INDEX``; archives are in ``folder`` unless they are URIs."""
    for stretch in _stretches(rows):
        start, data, error = stretch[0][3], b"", None
        if stretch[0][2] is None or start is None or start < 0 or not (stretch[0][4] or 0) > 0:
            error = "no place in an archive"
        else:
            location = stretch[0][2] if re.match(r"\w+:/", stretch[0][2]) else f"{folder}/{stretch[0][2]}"
            try:
                data = _range(location, start, max(r[3] + r[4] for r in stretch) - start)
            except Exception as e:  # noqa: BLE001  one place's failure is its rows'
                error = f"{type(e).__name__}: {e}"
        for row in stretch:
            told = dict.fromkeys(("type", "media_type", "status", "payload"))
            why = error
            if why is None:
                piece = data[row[3] - start : row[3] - start + row[4]]
                try:
                    if len(piece) < row[4]:
                        raise ValueError("a range beyond the archive's end")
                    told = read_record(piece)
                except (ValueError, zlib.error) as e:
                    why = str(e)
            digest = None if told["payload"] is None else hashlib.sha256(told["payload"].encode()).hexdigest()
            yield *row, told["type"], told["media_type"], told["status"], told["payload"], digest, why


def _batches(rows: Iterable[tuple], schema: pa.Schema = _SCHEMA) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a bounded number and a bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[8] or "")
        if len(held) >= 512 or size >= READ_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def records(index: DataFrame, folder: str) -> DataFrame:
    """The records that rows of ``INDEX`` name, read where those rows are."""
    ready(index.sparkSession)
    folder = files.whole_path(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _batches(read_ranges(folder, list(zip(*(c.to_pylist() for c in batch.columns)))))

    return index.select(*(x.split(" ")[0] for x in INDEX.split(", "))).mapInArrow(run, RECORDS)


# The data source.


@dataclass
class Piece(InputPartition):
    """A file of the index, or one of its row groups."""

    path: str
    group: int | None

    def __init__(self, path: str, group: int | None = None):
        self.path, self.group = path, group


class RecordReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.index = options.get("path"), options.get("index")
        if not self.folder or not self.index:
            raise ValueError("archive_records needs a path (of archives) and an index")
        self.chosen: list[tuple] = []

    def partitions(self) -> list[InputPartition]:
        """Pieces of the index: its files' names and sizes are all that is asked for, and the footers of large ones."""
        system, root = pafs.FileSystem.from_uri(files.whole_path(self.index))
        listed = [x for x in system.get_file_info(pafs.FileSelector(root, recursive=True)) if x.is_file and re.match(r"[^._].*\.parquet$", x.base_name)]
        out: list[InputPartition] = []
        for x in sorted(listed, key=lambda x: x.path):
            groups = pq.read_metadata(x.path, filesystem=system).num_row_groups if x.size > INDEX_BYTES else 1
            out += [Piece(x.path, k) for k in range(groups)] if groups > 1 else [Piece(x.path)]
        return out or [Piece("")]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        import pyarrow.dataset as ds

        system, _ = pafs.FileSystem.from_uri(files.whole_path(self.index))
        fragment = ds.ParquetFileFormat().make_fragment(partition.path, filesystem=system, row_groups=None if partition.group is None else [partition.group])
        columns = [x.split(" ")[0] for x in INDEX.split(", ")]
        wanted = None
        for column, _, values in self.chosen:
            one = ds.field(column).isin([v for v in values if v is not None])
            wanted = one if wanted is None else wanted & one
        for batch in fragment.to_batches(columns=columns, filter=wanted, batch_size=4096):
            if batch.num_rows:
                yield from _batches(read_ranges(files.whole_path(self.folder), list(zip(*(c.to_pylist() for c in batch.columns)))))


class ChoosingReader(RecordReader):
    """The same for sessions that hand filters to Python sources: records are chosen before anything is read of them."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Values of index columns choose records; other filters stay with Spark."""
        own = {x.split(" ")[0] for x in INDEX.split(", ")}
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in own:
                values = [f.value] if isinstance(f, EqualTo) else list(f.value)
                self.chosen.append((f.attribute[0], "in", values))
            else:
                yield f


class ArchiveRecords(DataSource):
    """``spark.read.format("archive_records").option("index", ...).load(archives)``: the records that a Parquet index names.

    ``option("choose", "true")`` takes filters on index columns, where the session's ``PUSHDOWN`` allows it.
    """

    @classmethod
    def name(cls) -> str:
        return "archive_records"

    def schema(self) -> str:
        return RECORDS

    def reader(self, schema) -> RecordReader:
        options = dict(self.options)
        return (ChoosingReader if options.get("choose") == "true" else RecordReader)(options)


def _registered(spark: SparkSession) -> str:
    """The source's name in a session: sessions of one context can't share a name, so all but the first have their own."""
    name = getattr(spark, "_docquarry_records", None)
    if name is None:
        name, source = ArchiveRecords.name(), ArchiveRecords
        try:
            spark.dataSource.register(source)
        except AnalysisException as e:
            if e.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
                raise
            name = f"{name}_{uuid.uuid4().hex}"
            spark.dataSource.register(type("ArchiveRecords", (ArchiveRecords,), {"name": classmethod(lambda _, name=name: name)}))
        spark._docquarry_records = name
    return name


def read_archives(spark: SparkSession, folder: str, index: str) -> DataFrame:
    """All records that the index under ``index`` names."""
    ready(spark)
    return spark.read.format(_registered(spark)).options(index=index, choose=spark.conf.get(PUSHDOWN, "false")).load(folder)


# Pages of URLs.


def snapshots(urls: DataFrame, index: DataFrame) -> DataFrame:
    """``url, time, archive, offset, length`` of archive URLs (``time`` and target as in the index), of several records the first of a file."""
    asked = urls.select("url", "time", "target")
    found = index.groupBy(F.col("url").alias("target"), "time").agg(F.min(F.struct("archive", "offset", "length")).alias("x"))
    return asked.join(found, ["target", "time"], "left").select("url", "time", "target", "x.archive", "x.offset", "x.length")


def fetch_records(urls: DataFrame, index: DataFrame, folder: str, known_files: DataFrame | None = None) -> DataFrame:
    """Documents of archive URLs (``url``) from the archives' own records, or the reasons why there are none.

    A record's address in the index is the page's; its row comes back by the archive URL.
    """
    plan = archive.planned(urls, known_files)
    good = plan.where("error IS NULL")
    places = snapshots(good, index)
    there = records(places.where("archive IS NOT NULL").select("url", "time", "archive", "offset", "length"), folder)
    wrong = F.when(F.col("error").isNotNull(), F.col("error")).when(~text_or_html(F.col("media_type")), F.concat(F.lit("no page but "), F.coalesce("media_type", F.lit("nothing"))))
    pages = there.select(F.col("url").alias("asked"), F.col("payload").alias("html"), wrong.alias("why"))
    joined = good.drop("error").join(pages, F.col("url") == F.col("asked"), "left")
    error = F.when(F.col("asked").isNull(), F.concat(F.lit("no snapshot of "), "target", F.lit(" at "), "time")).otherwise(F.col("why"))
    rows = joined.withColumn("error", error).select("url", "time", "target", "filename", "html", "error")
    bad = plan.where("error IS NOT NULL").select("url", "time", "target", "filename", F.lit(None).cast("string").alias("html"), "error")
    return archive.documents_of(rows.unionByName(bad))


def text_or_html(media_type):
    """Whether a media type is text or any form of HTML, as ``archive.is_page`` says."""
    return F.coalesce(media_type.rlike("^text/|html"), F.lit(False))
