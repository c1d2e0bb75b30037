import base64
import hashlib
import random

import pytest

from docquarry.llm import warc


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


RECORDS = [("http://a.example/x y", b"<p>1</p>"), (None, b""), ("http://b.example/", b"\n\nfiledesc://no\n" * 3), ("http://é.example/", "é".encode())]


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("gzip", [False, True])
def test_arc_versions_are_parsed(version, gzip):
    parts = list(warc.members(warc.arc_file("a.arc", version, RECORDS, "19990102030405", gzip)))
    assert len(parts) == (1 + len(RECORDS) if gzip else 1) and not any(e for _, e in parts)
    about, *got = warc.parse_arc(b"".join(d for d, _ in parts))
    assert about["version"] == str(version)
    assert [warc.payload_of(r["block"]) for r in got] == [p for _, p in RECORDS]
    assert [r["URL"] for r in got] == ["http://a.example/x%20y", "urn:none", "http://b.example/", "http://%C3%A9.example/"]
    assert {r["Archive-date"] for r in got} == {"19990102030405"} and got[0].keys() >= set(warc.ARC_FIELDS[version].split())


@pytest.mark.parametrize("date, want", [("19990102030405", "1999-01-02T03:04:05Z"), ("1999", "1999-01-01T00:00:00Z"), ("199912", "1999-12-01T00:00:00Z"), ("19991301000000", "1996-01-01T00:00:00Z"), ("no", "1996-01-01T00:00:00Z"), ("20000230", "1996-01-01T00:00:00Z")])
def test_dates_are_dates(date, want):
    assert warc.warc_date(date) == want


def test_archives_that_others_wrote(spark):
    """No keys, records that are no HTTP, URLs with spaces, several files in one, addresses."""
    about = b"1 0 someone\nURL IP-address Archive-date Content-type Archive-length\n"
    dns = b"20000101000000\na.example. 60 IN A 10.0.0.1\n"
    page = b"HTTP/1.0 200 OK\nContent-Type: text/html\n\nhello"
    one = b"filedesc://x.arc 0.0.0.0 20000101000000 text/plain %d\n" % len(about) + about
    data = one + b"\ndns:a.example 10.0.0.53 20000101000000 text/dns %d\n" % len(dns) + dns + b"\nhttp://a.example/b c 10.0.0.1 20000101000001 text/html %d\n" % len(page) + page
    again = b"\n" + one + b"\nhttp://c.example/ 10.0.0.2 20000101000002 text/html %d\n" % len(page) + page
    rows = spark.createDataFrame([("x.arc", data + again)], "archive string, content binary")
    records = warc.convert_arc(rows)
    got = {r.uri: r for r in records.collect() if r.type != "warcinfo"}
    assert {u: (r.type, r.ip, r.mime, r.key, r.error) for u, r in got.items()} == {
        "dns:a.example": ("resource", "10.0.0.53", "text/dns", None, None), "http://a.example/b c": ("response", "10.0.0.1", "text/html", None, None), "http://c.example/": ("response", "10.0.0.2", "text/html", None, None),
    }
    assert records.where("type = 'warcinfo'").count() == 2 and got["http://a.example/b c"].payload_digest == digest(b"hello")
    archives = warc.pack_warc(warc.deduplicate(records)).collect()
    heads = [h for a in archives for h, _ in warc.parse_warc(bytes(a.content))]
    assert sorted(h["warc-type"] for h in heads) == ["resource", "response", "revisit", "warcinfo", "warcinfo"]
    revisit = next(h for h in heads if h["warc-type"] == "revisit")
    response = next(h for h in heads if h["warc-type"] == "response")
    assert revisit["warc-refers-to"] == response["warc-record-id"] and revisit["warc-refers-to-target-uri"] == response["warc-target-uri"]
    assert response["warc-ip-address"] in ("10.0.0.1", "10.0.0.2") and next(h for h in heads if h["warc-type"] == "resource")["content-type"] == "text/dns"


def test_bad_records_are_rows_and_reading_goes_on(spark):
    good = warc.arc_file("a.arc", 1, [(f"http://a.example/{k}", b"<p>%d</p>" % k, k) for k in range(5)])
    cases = {
        "cut": good[:-3],
        "length": good.replace(b"text/html 123", b"text/html 9", 1) if b"text/html 123" in good else good,
        "version": good.replace(b"1 0 docquarry", b"3 0 docquarry"),
        "no version": good[good.index(b"\nhttp") + 1 :],
        "header": good.replace(b"http://a.example/2 0.0.0.0", b"http://a.example/2", 1),
        "gzip": warc.arc_file("a.arc", 1, [("http://a.example/0", b"x" * 9, 0), ("http://a.example/1", b"y" * 9, 1)], gzip=True)[:-9],
        "none": None,
        "noise": bytes(range(256)) * 9,
    }
    got = warc.convert_arc(spark.createDataFrame(list(cases.items()), "archive string, content binary")).collect()
    keys = {n: sorted(r.key for r in got if r.archive == n and r.type == "response") for n in cases}
    errors = {n: [r.error for r in got if r.archive == n and r.error] for n in cases}
    assert keys["cut"] == ["0", "1", "2", "3"] and errors["cut"] == ["record shorter than its declared length"]
    assert keys["version"] == list("01234") and errors["version"] == ["unknown ARC version", "no version block"]
    assert keys["no version"] == list("01234") and errors["no version"] == ["no version block"]
    assert keys["header"] == list("0134") and len(errors["header"]) == 1
    assert keys["gzip"] == ["0"] and len(errors["gzip"]) == 1
    assert not keys["none"] and not errors["none"] and errors["noise"] and not keys["noise"]


def test_altered_files_end_nothing():
    rng = random.Random(31)
    arcs = [warc.arc_file("a.arc", v, [(f"http://a.example/{k}", bytes(rng.randrange(256) for _ in range(rng.randrange(60))), k) for k in range(6)], gzip=g) for v in (1, 2) for g in (False, True)]
    fields = dict(zip(("archive", "at", "type", "key", "uri", "date", "ip", "mime", "block", "payload_bytes", "payload_digest", "error"), next(r for r in warc.converted("a", arcs[0]) if r[2] == "response")))
    warcs = [b"".join(warc.warc_record(fields | {"key": str(k)}) for k in range(6))]
    assert len(list(warc.found_in("w", warcs[0]))) == 6
    for n in range(20_000):
        data = bytearray(rng.choice(arcs if n % 4 else warcs))
        for _ in range(rng.randint(1, 6)):
            at, kind = rng.randrange(len(data)), rng.randrange(4)
            if kind == 0:
                data[at] = rng.randrange(256)
            elif kind == 1:
                del data[at : at + rng.randrange(40)]
            elif kind == 2:
                data[at:at] = bytes(rng.choice(b"0123456789 \r\n") for _ in range(rng.randrange(9)))
            else:
                data = data[: max(at, 1)]
            if not data:
                data = bytearray(b"x")
        rows = list(warc.converted("a", bytes(data)) if n % 4 else warc.found_in("a", bytes(data)))
        assert all(r[-1] is None or isinstance(r[-1], str) for r in rows)


def test_members_have_a_bound_and_archives_have_none(monkeypatch):
    """A member beyond the bound is an error; those before and after it are read, however much they hold together."""
    monkeypatch.setattr(warc, "MOST_BYTES", 10_000)
    import zlib

    pack = lambda data: zlib.compress(data, wbits=31)
    data, error = next(warc.members(pack(b"a" * 10**7)))
    assert not data and "too large" in error
    sizes = [10_000, 9_999, 10_001, 5, 10_000]
    got = list(warc.members(b"".join(pack(b"a" * n) for n in sizes)))
    assert [len(d) for d, e in got if e is None] == [10_000, 9_999, 5, 10_000] and sum(e is not None for _, e in got) == 1
    records = [(f"http://a.example/{k}", b"x" * 3000, k) for k in range(20)]
    rows = list(warc.converted("a", warc.arc_file("a.arc", 2, records, gzip=True)))
    assert [r[3] for r in rows if r[2] == "response"] == [str(k) for k in range(20)] and not any(r[-1] for r in rows)
    assert len({r[1] for r in rows}) == len(rows)


def _foreign(block, end=b"\r\n", version=b"WARC/1.0", tail=b"\r\n\r\n", **head):
    head = {"WARC-Type": "response", "WARC-Target-URI": "http://f.example/", "Content-Length": str(len(block))} | {k.replace("_", "-"): v for k, v in head.items()}
    return version + end + b"".join(f"{k}: {v}".encode() + end for k, v in head.items() if v is not None) + end + block + tail


def test_foreign_archives():
    """Names of any case, no digests, other digests, folded lines, gzip members, any version, bare line ends, missing tails."""
    import zlib

    http = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\npage"
    cases = [
        _foreign(http), _foreign(http, version=b"WARC/0.18"), _foreign(http, end=b"\n"), _foreign(http, tail=b""), _foreign(http, tail=b"\n" * 5),
        _foreign(http).replace(b"WARC-Type", b"warc-type").replace(b"Content-Length: ", b"CONTENT-LENGTH:"), _foreign(http, X_Folded="a\r\n b: c"), zlib.compress(_foreign(http), wbits=31),
        _foreign(http, WARC_Block_Digest="sha1:" + hashlib.sha1(http).hexdigest()), _foreign(http, WARC_Block_Digest="sha256:" + hashlib.sha256(http).hexdigest(), WARC_Payload_Digest="md5:" + hashlib.md5(b"page").hexdigest()),
        _foreign(http, WARC_Block_Digest="blake3:whatever"), _foreign(http, WARC_Truncated="length", WARC_Payload_Digest="sha1:" + digest(b"the whole page")).replace(b"x", b"x"),
    ]
    for data in cases:
        (row,) = warc.found_in("f", data)
        assert row[-1] is None and (row[2], row[4]) == (4, "response"), data
    assert [r[3] for data in cases[:11] for r in warc.found_in("f", data)] == [digest(b"page")] * 11
    assert [r[4] for r in warc.found_in("f", b"".join(cases[:4][::-1]) + _foreign(b"", WARC_Type="metadata"))] == ["response"] * 4 + ["metadata"]
    many = b"".join(zlib.compress(_foreign(http, X_Source_Key=str(k)), wbits=31) for k in range(5))
    assert [r[1] for r in warc.found_in("f", many)] == list("01234")
    (revisit,) = warc.found_in("f", _foreign(b"HTTP/1.1 200 OK\r\n\r\n", WARC_Type="revisit", WARC_Payload_Digest="sha1:ABC"))
    assert revisit[2:5] == (None, "ABC", "revisit") and revisit[-1] is None


def test_any_header_is_a_row():
    """Every field of our own and others' records with every kind of value, or missing: rows, and never more than an error."""
    block = b"HTTP/1.1 200 OK\r\n\r\nx"
    values = [None, "", " ", "-1", "+1", "1.5", "1e3", "NaN", "none", "\u0661", "9" * 30, "0x1", "sha1:", "sha1", ":", "sha1:\xff", "%", "%zz", "\x00", "a" * 10_000, "response", "<urn:uuid:x>", "0", str(len(block))]
    names = ["WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "WARC-Block-Digest", "WARC-Payload-Digest", "WARC-Target-URI", "WARC-Truncated", "WARC-IP-Address", "X-Payload-Length", "X-Source-Key", "X-Refers-To-Key", "Error", "error", ""]
    good = _foreign(block, X_Source_Key="good")
    for kind in ("response", "revisit", "resource", "warcinfo", "odd"):
        for name in names:
            for value in values:
                data = _foreign(block, **{"WARC_Type": kind, name.replace("-", "_"): value})
                rows = list(warc.found_in("f", data + good))
                assert any(r[1] == "good" and r[-1] is None for r in rows) or name == "Content-Length", (kind, name, value)
                assert all(r[-1] is None or r[1:9] == (None,) * 8 for r in rows)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_pages_round_trip(spark, tmp_path, min_bytes):
    pages = [(7, "http://a/", "same"), (3, "http://b/", "same"), (9, None, "same text"), (10, "http://c/", "same text"), (5, "http://d/", None), (2, "http://e/", ""), (8, "u v", "é\r\n\r\n" * 20000), (3, "http://b/", "same"), (None, "http://n/", "same"), (None, "x", "alone")]
    df = spark.createDataFrame([(*p, "k", "a") for p in pages], "page_id long, url string, html string, key string, archive string").repartition(3)
    got = warc.archive_pages(df, str(tmp_path / "warc"), min_bytes=min_bytes).collect()
    payload = [(i, (h or "").encode()) for i, _, h in pages]
    first = {}
    for i, p in payload:
        if len(p) >= min_bytes and i is not None:
            first[p] = min(first.get(p, i), i)
    want = [(i, len(p), digest(p), "response" if first.get(p, i) == i else "revisit", None if first.get(p, i) == i else first[p]) for i, p in payload]
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    assert all(r.record_id.startswith("<urn:uuid:") and r.error is None for r in got) and {r.date for r in got} == {"1996-01-01T00:00:00Z"}
    assert warc.archive_pages(df.limit(0), str(tmp_path / "none")).count() == 0


def test_payloads_are_not_shuffled(spark, tmp_path):
    df = spark.createDataFrame([(i, f"http://a/{i}", f"page {i % 7}") for i in range(50)], "page_id long, url string, html string")
    warc.convert_arc(warc.pack_arc(df)).write.parquet(str(tmp_path / "records"))
    plan = warc.deduplicate(spark.read.parquet(str(tmp_path / "records")))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
