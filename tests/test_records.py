import http.server
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docquarry.plans import queries
from docquarry.sources import records
from tests.compare import connect, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def archived(spark, tmp_path_factory):
    """Forty pages in archives of some records, with the index as Parquet."""
    folder = tmp_path_factory.mktemp("archives")
    pages = spark.createDataFrame([(f"http://e.org/{k} ä", f"2004010100{k:04d}", f"<p>page {k} é</p>" * (k + 1)) for k in range(40)] + [(None, None, None)], "url string, time string, html string")
    index = records.write_archives(pages.repartition(3), str(folder / "warc"))
    index.write.parquet(str(folder / "index"))
    return folder


def test_every_page_comes_back(spark, archived):
    got = records.read_archives(spark, str(archived / "warc"), str(archived / "index")).collect()
    assert {(r.url, r.payload, r.status, r.error) for r in got if r.url} == {(f"http://e.org/{k} ä", f"<p>page {k} é</p>" * (k + 1), 200, None) for k in range(40)}
    assert [(r.payload, r.error) for r in got if r.url is None] == [("", None)]


def test_writing_twice_leaves_one_file(spark, archived):
    index = spark.read.parquet(str(archived / "index"))
    names = {p.name for p in (archived / "warc").iterdir()}
    assert names == {r.archive for r in index.select("archive").distinct().collect()}
    page = spark.createDataFrame([("u", "2004", "x")], "url string, time string, html string")
    again = [records.write_archives(page, str(archived / "again")).collect() for _ in range(2)]
    assert again[0] == again[1] and len(list((archived / "again").iterdir())) == 1


def test_only_the_named_ranges_are_read(spark, archived, monkeypatch):
    """Chosen records are read by their ranges: neighbours in one read, others not at all."""
    asked = []
    real = records._range
    monkeypatch.setattr(records, "_range", lambda *a: asked.append(a) or real(*a))
    monkeypatch.setattr(records, "GAP", 0)
    rows = sorted(tuple(r) for r in spark.read.parquet(str(archived / "index")).where("url IS NOT NULL").collect())
    one = [r for r in sorted(rows, key=lambda r: (r[2], r[3])) if r[2] == rows[0][2]]
    chosen = [one[0], one[1], one[3]]
    got = list(records.read_ranges(str(archived / "warc"), chosen))
    assert [a[1:] for a in asked] == [(one[0][3], one[0][4] + one[1][4]), (one[3][3], one[3][4])]
    assert [g[0] for g in got] == [r[0] for r in chosen] and all(g[10] is None for g in got)


def test_pieces_of_the_index(spark, archived, monkeypatch):
    """Large index files are read by row groups, small ones whole; values of index columns choose records."""
    whole = pq.read_table(str(archived / "index"))
    (archived / "groups").mkdir(exist_ok=True)
    pq.write_table(whole, archived / "groups/a.parquet", row_group_size=10)
    (archived / "groups/_SUCCESS").touch()
    options = {"path": str(archived / "warc"), "index": str(archived / "groups")}
    assert [(p.group) for p in records.RecordReader(options).partitions()] == [None]
    monkeypatch.setattr(records, "INDEX_BYTES", 1)
    reader = records.ChoosingReader(options)
    left = list(reader.pushFilters([records.EqualTo(("url",), "http://e.org/7 ä"), records.EqualTo(("status",), 200)]))
    assert [f.attribute for f in left] == [("status",)]
    pieces = reader.partitions()
    assert [p.group for p in pieces] == [0, 1, 2, 3, 4]
    assert [r["url"] for p in pieces for b in reader.read(p) for r in b.to_pylist()] == ["http://e.org/7 ä"]


def test_filters_of_a_session_reach_the_index(spark, archived):
    own = spark.newSession()
    own.conf.set(records.PUSHDOWN, "true")
    got = records.read_archives(own, str(archived / "warc"), str(archived / "index")).where("url = 'http://e.org/7 ä' AND status = 200")
    assert [r.payload[:10] for r in got.collect()] == ["<p>page 7 "]


def test_bad_places_are_rows(spark, archived):
    good = spark.read.parquet(str(archived / "index")).where("url = 'http://e.org/3 ä'").first()
    bad = [
        ("shifted", None, good.archive, good.offset + 1, good.length), ("short", None, good.archive, good.offset, good.length - 9), ("beyond", None, good.archive, 1 << 40, 10),
        ("nowhere", None, "no.warc.gz", 0, 10), ("null", None, None, None, None), ("negative", None, good.archive, -4, 10), ("empty", None, good.archive, 0, 0),
    ]
    index = spark.createDataFrame([*bad, tuple(good)], records.INDEX)
    got = {r.url: r for r in records.records(index, str(archived / "warc")).collect()}
    assert len(got) == len(bad) + 1 and got[good.url].error is None
    assert all(got[b[0]].error and got[b[0]].payload is None for b in bad)


@pytest.mark.parametrize("change", [
    (b"WARC/1.1", b"HTTP/1.1"), (b"Content-Length: ", b"Content-Length: x"), (b"Content-Length: ", b"Content-Length: 9"), (b"<p>", b"<q>"),
])
def test_damaged_records_are_errors(change):
    data = records.unpacked(records.record("u", "20040101000000", "<p>x</p>"))
    assert records.read_record(data)["payload"] == "<p>x</p>"
    with pytest.raises(ValueError):
        records.read_record(data.replace(*change))


def test_foreign_records():
    """Headers of any case, no digest, no HTTP header, another charset, a record that isn't packed."""
    block = "é".encode("latin-1")
    plain = b"WARC/0.18\r\nwarc-type: resource\r\ncontent-type: text/plain; charset=ISO-8859-1\r\nCONTENT-LENGTH:1\r\n\r\n" + block + b"\r\n\r\n"
    assert records.read_record(plain) == {"type": "resource", "media_type": "text/plain; charset=ISO-8859-1", "status": None, "payload": "é"}


@pytest.mark.parametrize("ranges", [True, False])
def test_ranges_over_http(archived, spark, ranges):
    rows = [tuple(r) for r in spark.read.parquet(str(archived / "index")).where("url IS NOT NULL").limit(3).collect()]

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            data = (archived / "warc" / self.path.lstrip("/")).read_bytes()
            first, last = map(int, self.headers["Range"].removeprefix("bytes=").split("-"))
            self.send_response(206 if ranges else 200)
            self.end_headers()
            self.wfile.write(data[first : last + 1] if ranges else data)

        def log_message(self, *_):
            pass

    with http.server.HTTPServer(("127.0.0.1", 0), Handler) as server:
        threading.Thread(target=server.serve_forever, daemon=True).start()
        remote = [(*r[:2], f"http://127.0.0.1:{server.server_port}/{r[2]}", *r[3:]) for r in rows]
        got = list(records.read_ranges("", remote))
        server.shutdown()
    assert {g[0] for g in got} == {r[0] for r in rows} and all(g[10] is None for g in got)


def test_documents_of_records(spark, archived):
    url = "https://web.archive.org/web/2004010100{:04d}/http://e.org/{} ä"
    urls = spark.createDataFrame([(url.format(4, 4),), (url.format(5, 4),), ("http://e.org/4",)], "url string")
    got = {r.url: r for r in records.fetch_records(urls, spark.read.parquet(str(archived / "index")), str(archived / "warc")).collect()}
    # Two URLs with one file name are one page: the first is asked for.
    assert set(got) == {url.format(4, 4), "http://e.org/4"}
    assert got[url.format(4, 4)].content.startswith("20040101000004/http://e.org/4 ä\n\npage 4 é")
    assert got["http://e.org/4"].error == "not an archive URL: http://e.org/4"
    missing = records.fetch_records(spark.createDataFrame([(url.format(99, 4),)], "url string"), spark.read.parquet(str(archived / "index")), str(archived / "warc")).first()
    assert missing.content is None and missing.error == "no snapshot of http://e.org/4 ä at 20040101000099"


@pytest.mark.parametrize("name", ["archive_records", "record_documents"])
def test_queries(spark, name):
    assert same(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLE_SQL[name]) > 0


def test_an_empty_index(spark, archived):
    spark.createDataFrame([], records.INDEX).write.mode("overwrite").parquet(str(archived / "none"))
    assert records.read_archives(spark, str(archived / "warc"), str(archived / "none")).select(F.count("*")).first()[0] == 0
