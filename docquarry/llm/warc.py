"""WARC from legacy archives: ARC records converted, deduplicated, written and read back.

``convert_arc`` reads any ARC files (versions 1 and 2, plain or as gzip members,
one after another too): the version block, the version's header fields and the
declared lengths.  It synthesises what WARC needs: record types (an HTTP reply
is a response, anything else, such as a ``dns:`` record, a resource, a version block
a warcinfo record), identifiers, dates, payload digests.  ``deduplicate`` marks all but
the first of equal payloads as revisits, ``pack_warc`` writes archives and
``read_warc`` reads any: fields of any case, records as gzip members, digests of
several kinds or none.  ``pack_arc`` writes rows as ARC files; a row's key
travels in the HTTP header that it writes.  An archive is one row
``(archive, content)`` of a table, written by Spark's own committer, so a lost
executor's files are written again.

Bad input is rows, not exceptions: a record that can't be read is a row with
``error`` set, and reading goes on at the next header line.

Payloads never move between tasks to meet their copies: digests that occur twice
or more are counted on narrow rows, and handed to the records by a join that is
a broadcast while they are few.

Defined results: a null payload is empty; a null URL is ``urn:none``; rows with
the payload and the key of the response are responses too (repeated rows); null
keys come last; a date that is none is ``NO_DATE``; an empty table gives no
archives; other columns are ignored.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, by_bytes, new_folder, small, utf8

#: The header fields of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Bytes of payload in one archive, about; the most that a gzip member may hold; the date of records without one.
ARCHIVE_BYTES, MOST_BYTES, NO_DATE = 4 << 20, 1 << 30, "19960101000000"
#: Where a reader takes up again after a bad record: a line that looks like a header.
_HEADER = re.compile(rb"^[A-Za-z][A-Za-z0-9+.-]{0,20}:[^\r\n]{0,4096} [0-9A-Fa-f.:]{2,45} [0-9]{4,14} [^\r\n]{1,2048} [0-9]{1,18}\r?$", re.M)
_KEY, _LENGTH, _REFERS = "X-Source-Key", "X-Payload-Length", "X-Refers-To-Key"

RECORD = "archive string, at long, type string, key string, uri string, date string, ip string, mime string, block binary, payload_bytes long, payload_digest string, error string"
_RECORD = pa.schema(
    [("archive", pa.string()), ("at", pa.int64()), *((x, pa.string()) for x in ("type", "key", "uri", "date", "ip", "mime")), ("block", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("error", pa.string())]
)
FOUND = "archive string, key string, payload_bytes long, payload_digest string, record_type string, refers_to string, record_id string, uri string, date string, error string"
_FOUND = pa.schema([(x.split(" ")[0], pa.int64() if x.endswith("long") else pa.string()) for x in FOUND.split(", ")])


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(uri: str | None) -> str:
    """A URI without white space or control characters, as both formats need."""
    return quote(uri, safe="".join(map(chr, range(0x21, 0x7F)))) if uri else "urn:none"


def arc_file(name: str, version: int, records: Iterable[tuple], date: str = NO_DATE, gzip: bool = False) -> bytes:
    """An ARC file of (URL, payload) or (URL, payload, key) records; version 2 when asked for, and records as gzip members."""
    fields = ARC_FIELDS[version].encode()
    about = f"{version} 0 docquarry\n".encode() + fields + b"\n"
    rest = f"200 - - 0 {name} " if version == 2 else ""
    out = [f"filedesc://{name} 0.0.0.0 {date} text/plain {rest}{len(about)}\n".encode() + about]
    at = len(out[0])
    for uri, payload, *key in records:
        named = f"{_KEY}: {quote(str(key[0]))}\r\n".encode() if key and key[0] is not None else b""
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + named + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
        extra = f"200 {sha1_base32(block)} - {at} {name} " if version == 2 else ""
        out.append(f"\n{_clean(uri)} 0.0.0.0 {date} text/html {extra}{len(block)}\n".encode() + block)
        at += len(out[-1])
    if gzip:
        out = [zlib.compress(x, wbits=31) for x in out]
    return b"".join(out)


def members(data: bytes) -> Iterator[tuple[bytes, str | None]]:
    """An archive's gzip members one after another, unpacked (a plain archive is one); an empty one with what is wrong with it if it can't be read.

    Only one member is held at a time, so an archive may be of any size; a member is bounded by ``MOST_BYTES``.
    """
    if not data.startswith(b"\x1f\x8b"):
        yield data, None
        return
    at, view = 0, memoryview(data)
    while 0 <= at < len(data):
        member, start, parts, held = zlib.decompressobj(31), at, [], 0
        try:
            while not member.eof and (at < len(data) or member.unconsumed_tail) and held <= MOST_BYTES:  # small steps: what is left over is copied
                tail = member.unconsumed_tail
                parts.append(member.decompress(tail or view[at : at + 65536], MOST_BYTES + 1 - held))
                at += 0 if tail else 65536
                held += len(parts[-1])
            if held > MOST_BYTES:
                raise zlib.error("too large")
            if not member.eof:
                raise zlib.error("cut short")
            at = min(at, len(data)) - len(member.unused_data)
        except zlib.error as e:
            yield b"", f"gzip member at {start}: {e}"
            at = data.find(b"\x1f\x8b\x08", start + 1)
            continue
        yield b"".join(parts), None


def parse_arc(data: bytes, fields: list[str] | None = None) -> Iterator[dict]:
    """Records of an ARC file: dictionaries of the version's fields with ``at`` and ``block``, or of ``at`` and ``error``.

    Version blocks have ``version``.  ``fields`` are those of the members before, and are left as they are now.
    """
    fields = [] if fields is None else fields
    at = 0
    while at < len(data):
        if data[at] in b"\r\n":  # between records
            at += 1
            continue
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        line = data[at:end].rstrip(b"\r").decode("utf-8", "replace")
        try:
            size = line.rpartition(" ")[2]
            if not re.fullmatch("[0-9]{1,18}", size):
                raise ValueError("header line without a length")
            block = data[end + 1 : end + 1 + int(size)]
            if len(block) < int(size):
                raise ValueError("record shorter than its declared length")
            about = line.startswith("filedesc:")
            if about:
                fields[:] = _fields(block)
            elif not fields:
                fields[:] = ARC_FIELDS[1].split()  # the commoner version; the record counts as well
                yield {"at": at, "error": "no version block"}
            values = line.rsplit(" ", len(fields) - 1)  # old URLs may hold spaces
            if len(values) < len(fields):
                raise ValueError(f"header line with {len(values)} fields")
            yield dict(zip(fields, values)) | {"at": at, "block": block} | ({"version": block[:1].decode()} if about else {})
            at = end + 1 + int(size)
        except ValueError as e:
            yield {"at": at, "error": str(e)}
            found = _HEADER.search(data, end)
            at = found.start() if found else len(data)


def _fields(block: bytes) -> list[str]:
    """The header fields that a version block declares."""
    lines = block.split(b"\n")
    version = lines[0].split(b" ")[0]
    fields = lines[1].decode("utf-8", "replace").split() if len(lines) > 1 else []
    if version not in (b"1", b"2") or fields != ARC_FIELDS[int(version)].split():
        raise ValueError("unknown ARC version")
    return fields


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP header of a block; the block itself if it has none."""
    if not block.startswith(b"HTTP/"):
        return block
    head, found, payload = block.partition(b"\r\n\r\n")
    return payload if found else block.partition(b"\n\n")[2]


def source_key(block: bytes) -> str | None:
    """The key that ``pack_arc`` put into a block's HTTP header."""
    head = block.partition(b"\r\n\r\n")[0] if block.startswith(b"HTTP/") else b""
    found = re.search(rb"\r\n" + _KEY.encode() + rb": ([^\r\n]*)", head)
    return unquote(found[1].decode("utf-8", "replace")) if found else None


def warc_date(date: str) -> str:
    """An ARC date as a WARC date; months and days that are missing are the first ones."""
    digits = date[:14] if re.fullmatch("[0-9]{4,}", date) else NO_DATE
    digits += "00000101000000"[len(digits) :]
    try:
        return datetime.datetime.strptime(digits, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ").rjust(20, "0")
    except ValueError:
        return warc_date(NO_DATE)


def record_id(uri: str, date: str, key: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{uri} {date} {key}')}>"


def pack_arc(df: DataFrame, *, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", version: int | None = None, gzip: bool = False) -> DataFrame:
    """``archive string, content binary``: ARC files of the rows, which keep their ids as keys; versions alternate unless one is given."""
    bound_batches(df.sparkSession)
    narrow = df.select(df[id_column].cast("string").alias("key"), df[url_column].alias("url"), df[payload_column].alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, batch in enumerate(by_bytes(batches, "payload", ARCHIVE_BYTES)):
            rows = zip(batch.column(1).to_pylist(), (x or b"" for x in utf8(batch.column(2))), batch.column(0).to_pylist())
            content = arc_file("part.arc", version or 1 + n % 2, rows, gzip=gzip)
            yield pa.RecordBatch.from_arrays([pa.array([f"{hashlib.sha1(content).hexdigest()[:16]}.arc"]), pa.array([content], pa.binary())], ["archive", "content"])

    return narrow.mapInArrow(run, "archive string, content binary")


def _rows_of(rows: Iterable[tuple], schema: pa.Schema, block: int | None = None) -> Iterator[pa.RecordBatch]:
    """Batches of rows, each of about ``ARCHIVE_BYTES`` of blocks at most."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[block] or b"") if block is not None else 0
        if size > ARCHIVE_BYTES or len(held) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def converted(name: str | None, content: bytes | None) -> Iterator[tuple]:
    """Rows of ``RECORD`` for one ARC file; ``at`` counts unpacked bytes."""
    fields: list[str] = []
    before = 0
    for data, error in members(content or b""):
        if error is not None:
            yield (name, None, *[None] * 9, error)
            continue
        for r in parse_arc(data, fields):
            at = before + r["at"]
            if "error" in r:
                yield (name, at, *[None] * 9, r["error"])
                continue
            block = r["block"]
            payload = payload_of(block)
            kind = "warcinfo" if "version" in r else "response" if block.startswith(b"HTTP/") else "resource"
            yield name, at, kind, source_key(block), r["URL"], warc_date(r["Archive-date"]), r["IP-address"], r["Content-type"], block, len(payload), sha1_base32(payload), None
        before += len(data)


def convert_arc(archives: DataFrame) -> DataFrame:
    """One row of ``RECORD`` for each record of ARC files (``archive, content``), and for each thing that is wrong with them."""
    bound_batches(archives.sparkSession, 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                yield from _rows_of(converted(name.as_py(), content.as_py()), _RECORD, block=8)

    return archives.select("archive", "content").mapInArrow(run, RECORD)


def deduplicate(records: DataFrame, *, key: str = "bigint", min_bytes: int = 0) -> DataFrame:
    """``records`` (readable ones) with ``first``, the record of equal payload that a revisit refers to; null for all others.

    The first has the smallest key, compared as ``key``'s type.  Only digests that occur twice meet the records again.
    """
    records = records.where("error IS NULL")
    able = (F.col("type") != "warcinfo") & (F.col("payload_bytes") >= min_bytes)
    order = F.struct(F.col("key").isNull(), F.col("key").try_cast(key), "key", "uri", "date", "archive", "at")
    firsts = records.where(able).groupBy("payload_digest").agg(F.min_by(F.struct("key", "uri", "date", "archive", "at"), order).alias("first"), F.count("*").alias("n"))
    firsts = small(firsts.where("n > 1").select(F.col("payload_digest").alias("digest"), "first"))
    same = F.when(F.col("key").isNotNull(), F.col("key").eqNullSafe(F.col("first.key"))).otherwise(F.col("first.key").isNull() & (F.col("archive") == F.col("first.archive")) & (F.col("at") == F.col("first.at")))
    return records.join(firsts, able & (F.col("payload_digest") == F.col("digest")), "left").withColumn("first", F.when(~same, F.col("first"))).drop("digest")


def _identity(r: dict) -> str:
    return record_id(r["uri"], r["date"], r["key"] if r["key"] is not None else f"{r['archive']}:{r['at']}")


def warc_record(r: dict) -> bytes:
    """One WARC record of a row of ``RECORD`` with ``first``; a revisit keeps the HTTP header of its block alone."""
    first, block, kind = r.get("first"), r["block"], r["type"]
    head = {
        "WARC-Type": "revisit" if first else kind,
        "WARC-Record-ID": _identity(r),
        "WARC-Target-URI": None if kind == "warcinfo" else r["uri"],
        "WARC-Date": r["date"],
        "WARC-IP-Address": r["ip"] if re.fullmatch(r"[0-9A-Fa-f.:]+", r["ip"] or "") and r["ip"] != "0.0.0.0" else None,
        "WARC-Filename": r["uri"].removeprefix("filedesc://") if kind == "warcinfo" else None,
        "WARC-Payload-Digest": None if kind == "warcinfo" else f"sha1:{r['payload_digest']}",
        "Content-Type": "application/http; msgtype=response" if kind == "response" else r["mime"],
        _KEY: None if r["key"] is None else quote(r["key"]),
        _LENGTH: r["payload_bytes"],
    }
    if first:
        block = block[: len(block) - r["payload_bytes"]]
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": _identity(first), "WARC-Refers-To-Target-URI": first["uri"], "WARC-Refers-To-Date": first["date"]}
        head[_REFERS] = None if first["key"] is None else quote(first["key"])
    head |= {"WARC-Block-Digest": f"sha1:{sha1_base32(block)}", "Content-Length": len(block)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Headers (names in lower case) and block of each record of a WARC file, plain or gzip members of any version; a record that
    can't be read is ``{"error": ...}`` without a block."""
    for member, error in members(data):
        if error is not None:
            yield {"error": error}, None
        else:
            yield from _records(member)


def _records(data: bytes) -> Iterator[tuple[dict[str, str], bytes | None]]:
    at = 0
    while at < len(data):
        if data[at] in b"\r\n":  # between records; some writers leave more than two ends of line
            at += 1
            continue
        try:
            if not data.startswith(b"WARC/", at):
                raise ValueError("record without a header")
            end = re.compile(rb"\r?\n\r?\n").search(data, at)
            if end is None:
                raise ValueError("header without an end")
            head = _head(data[at : end.start()])
            size = head.get("content-length", "")
            if not re.fullmatch("[0-9]{1,18}", size):
                raise ValueError("record without a length")
            after = end.end() + int(size)
            if after > len(data) or data[after : after + 1] not in (b"", b"\r", b"\n") and not data.startswith(b"WARC/", after):
                raise ValueError("record shorter or longer than its declared length")
            yield head, data[end.end() : after]
            at = after
        except ValueError as e:
            yield {"error": str(e)}, None
            at = data.find(b"WARC/", at + 1)
            if at < 0:
                return


def _head(lines: bytes) -> dict[str, str]:
    """Named fields of a record's header; a line that begins with white space goes on with the one before."""
    text = re.sub(r"\r?\n[ \t]+", " ", lines.decode("utf-8", "replace"))
    named = (x.partition(":") for x in re.split(r"\r?\n", text)[1:])
    return {name.strip().lower(): value.strip() for name, colon, value in named if colon and name.strip().lower() != "error"}


#: Digests that are checked, by the names that records give them; others are taken as they are.
_HASHES = {"md5": hashlib.md5, "sha1": hashlib.sha1, "sha-1": hashlib.sha1, "sha256": hashlib.sha256, "sha-256": hashlib.sha256}


def agrees(declared: str | None, data: bytes) -> bool:
    """Whether bytes have the digest that a header declares, in base 32 or hexadecimal; one that isn't declared is no reason for doubt."""
    name, colon, value = (declared or "").partition(":")
    hashed = _HASHES.get(name.strip().lower())
    if not colon or hashed is None:
        return True
    digest = hashed(data).digest()
    return value.strip().rstrip("=").upper() in (base64.b32encode(digest).decode().rstrip("="), digest.hex().upper())


def pack_warc(records: DataFrame) -> DataFrame:
    """Rows of ``RECORD`` with ``first`` as WARC archives, rows of ``archive, content``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "block", ARCHIVE_BYTES):
            content = b"".join(map(warc_record, batch.to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array([f"{hashlib.sha1(content).hexdigest()[:16]}.warc"]), pa.array([content], pa.binary())], ["archive", "content"])

    return records.mapInArrow(run, "archive string, content binary")


def found_in(name: str | None, content: bytes) -> Iterator[tuple]:
    """Rows of ``FOUND`` for one WARC file, anybody's.

    Declared digests are checked against the blocks; responses and resources without one get the SHA-1 of their payload.  What a
    revisit's payload held is told by our own header alone, and null without it.
    """
    for head, block in parse_warc(content):
        error, kind = head.get("error"), head.get("warc-type")
        whole = error is None and kind in ("response", "resource") and "warc-truncated" not in head
        if error is None and kind is None:
            error = "record without a type"
        if error is None and not agrees(head.get("warc-block-digest"), block):
            error = "block with another digest than declared"
        if error is None and whole and not agrees(head.get("warc-payload-digest"), payload_of(block)):
            error = "payload with another digest than declared"
        size, declared = head.get(_LENGTH.lower()), head.get("warc-payload-digest")
        if error is None and kind == "revisit" and size is not None and not re.fullmatch("[0-9]{1,18}", size):
            error = "revisit with a length that is none"
        if error is not None:
            yield (name, *[None] * 8, error)
            continue
        key, refers = ((None if x is None else unquote(x)) for x in (head.get(_KEY.lower()), head.get(_REFERS.lower())))
        length = len(payload_of(block)) if kind != "revisit" else None if size is None else int(size)
        if whole:
            digest = sha1_base32(payload_of(block))
        else:
            digest = None if declared is None else declared.partition(":")[2].strip() if declared.lower().startswith("sha1:") else declared
        yield name, key, length, digest, kind, refers, head.get("warc-record-id"), head.get("warc-target-uri"), head.get("warc-date"), None


def read_warc(archives: DataFrame) -> DataFrame:
    """One row of ``FOUND`` for each WARC record of archives (``archive, content``), and for each that can't be read."""
    bound_batches(archives.sparkSession, 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                yield from _rows_of(found_in(name.as_py(), content.as_py() or b""), _FOUND)

    return archives.select("archive", "content").mapInArrow(run, FOUND)


def to_warc(arcs: DataFrame, folder: str, *, key: str = "bigint", min_bytes: int = 0) -> DataFrame:
    """Convert ARC files into WARC archives under ``folder/warc``; rows of what could not be read.

    Records are written once on the way, compressed: each archive is parsed once, and the count of digests reads
    no payloads.
    """
    spark = arcs.sparkSession
    convert_arc(arcs).write.option("compression", "zstd").parquet(f"{folder}/records")
    records = spark.read.schema(RECORD).parquet(f"{folder}/records")
    pack_warc(deduplicate(records, key=key, min_bytes=min_bytes)).write.option("compression", "zstd").parquet(f"{folder}/warc")
    return records.where("error IS NOT NULL").select("archive", "at", "error")


def archive_pages(df: DataFrame, folder: str | None = None, *, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write a WARC record for each row, by way of ARC files, and read the archives back.

    ``folder`` must be shared by all executors; the default is a new one beside the
    checkpoints, which goes when the session ends.
    """
    spark, kind = df.sparkSession, dict(df.dtypes)[id_column]
    folder = folder or new_folder(spark, "warc")
    to_warc(pack_arc(df, id_column=id_column, url_column=url_column, payload_column=payload_column), folder, key=kind, min_bytes=min_bytes)
    found = read_warc(spark.read.schema("archive string, content binary").parquet(f"{folder}/warc")).where("record_type <> 'warcinfo' OR error IS NOT NULL")
    return found.select(F.col("key").cast(kind).alias(id_column), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "record_id", "uri", "date", "error")
