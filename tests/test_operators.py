import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from docquarry import cli
from docquarry.operators import importer, infer, ledger, pairs, preflight, prep, units, views
from docquarry.plans import run as verbs
from docquarry.sources import archive, files
from docquarry.store import CorpusStore, dense_ids

GOOD = "The quick brown fox jumps over the lazy dog again. " * 6
PROMPT = 'id: 2\nname: foxes\ndescription: about foxes\nprompt: |\n  Extract "fox" or "wolf".\n\n  Nothing else.\n'


@pytest.fixture
def folders(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "prompts").mkdir()
    for i in (1, 2, 3):
        (tmp_path / f"in/doc{i}.md").write_text(f"20040101000000/http://e.org/{i}\n\n# {i}\n{GOOD}")
    (tmp_path / "in/short.md").write_text("h\n\nshort")
    (tmp_path / "in/latin.md").write_bytes(b"h\n\n\xff\xfe" * 100)
    (tmp_path / "in/large.md").write_text("20040101000000/http://e.org/l\n\n" + ("A wolf. " + GOOD + "\n\n") * 12)
    (tmp_path / "prompts/02_foxes.yaml").write_text(PROMPT)
    (tmp_path / "prompts/03_dogs.yaml").write_text('id: 3\nname: dogs\ndescription: about dogs\nprompt: |\n  Extract "badger".\n')
    return tmp_path


@pytest.fixture
def store(spark, tmp_path):
    return CorpusStore(spark, str(tmp_path / "store"))


def test_store_versions(spark, store):
    assert store.create() is True and store.create() is False
    row = spark.createDataFrame([("a", "r", "s", None)], "filepath string, reason string, content_sha256 string, excluded_at timestamp")
    store.append("excluded_file", row)
    store.append("excluded_file", row.withColumn("filepath", F.lit("b")))
    assert store.read("excluded_file").count() == 2 and len(store.versions("excluded_file")) == 3
    store.replace("excluded_file", store.read("excluded_file").where("filepath = 'b'"))
    assert [r.filepath for r in store.read("excluded_file").collect()] == ["b"]
    store.views()
    assert spark.sql("SELECT total_runs, total_pairs_saved FROM processing_summary").collect() == [(0, None)]


def test_dense_ids(spark):
    df = spark.createDataFrame([(f"p{(i * 37) % 100:03d}", i) for i in range(100)], "path string, x int").repartition(7)
    got = sorted((r.path, r.id) for r in dense_ids(df, ["path"], "id", 5).collect())
    assert got == [(f"p{i:03d}", i + 5) for i in range(100)]
    assert dense_ids(df.limit(0), ["path"], "id").count() == 0


def test_whole_pipeline(spark, store, folders):
    done = verbs.prep_db(store, str(folders / "in"), str(folders / "prompts"), limit=2000, size=1500, overlap=50)
    assert {k: done[k] for k in ("created", "categories", "rejected", "synced", "skipped", "split")} == {"created": True, "categories": 2, "rejected": 1, "synced": 4, "skipped": 1, "split": 1}
    status = done["status"]
    parts = status["split_parts"]
    assert status["original_documents"] == 4 and parts > 1 and status["eligible_documents"] == 3 + parts and status["pending_pairs"] == 2 * (3 + parts)
    rows = sorted(store.read("result").collect())
    assert [r.result_id for r in rows] == list(range(1, 5 + parts))
    parent = next(r for r in rows if r.filepath.endswith("large.md"))
    assert [(r.part_number, r.parent_result_id) for r in rows if r.part_number] == [(n, parent.result_id) for n in range(1, parts + 1)]
    again = verbs.prep_db(store, str(folders / "in"), str(folders / "prompts"), limit=2000, size=1500, overlap=50)
    assert again["created"] is False and again["status"]["total_rows"] == status["total_rows"] and store.read("category").count() == 2

    out = verbs.process(store, str(folders / "prompts"), "system", str(folders / "out"), infer.Rules(), limit=3, limit_chars=2000)
    assert (out["processed"], out["saved"], out["failed"]) == (3, 3, 0) and out["request_time_avg"].endswith("s")
    out = verbs.process(store, str(folders / "prompts"), "system", str(folders / "out"), infer.Rules(), limit_chars=2000)
    assert out["saved"] == 2 * (3 + parts) - 3
    out = verbs.process(store, str(folders / "prompts"), "system", str(folders / "out"), infer.Rules(), limit_chars=2000)
    assert out["processed"] == 0 and ledger.latest(store.read("run_stats")).orderBy("run_id").collect()[-1].notes == "No pairs to process"

    tally = verbs.import_results(store, str(folders / "out"))
    assert tally["imported"] == 2 * (3 + parts) == tally["total"] and tally["errors"] == 0
    assert verbs.import_results(store, str(folders / "out"))["skipped"] == tally["total"]
    tables = {n: store.read(n) for n in ("result", "category", "result_category", "result_category_blockquote", "run_stats")}
    summary = {r.filepath.rsplit("/", 1)[1]: r for r in views.result_summary(tables).collect()}
    assert summary["doc1.md"].categories_processed == 2 and summary["doc1.md"].maybe_count == 1 and summary["doc1.md"].no_count == 1 and summary["doc1.md"].total_blockquotes == 1
    assert summary["large.md"].categories_processed == 0
    (fox,) = views.document_category_aggregate(tables).where("category_name = 'foxes'").collect()
    assert fox.aggregate_match == "yes" and fox.matching_parts == ",".join(map(str, range(1, parts + 1)))
    assert views.processing_summary(tables).first().total_pairs_saved == 2 * (3 + parts)
    assert [r.blockquote_id for r in sorted(tables["result_category_blockquote"].collect())] == list(range(1, tally["blockquotes"] + 1))


def test_changed_documents_and_prompts(spark, store, folders):
    verbs.prep_db(store, str(folders / "in"), str(folders / "prompts"))
    (folders / "in/doc1.md").write_text("h\n\nnew " + GOOD)
    (folders / "prompts/02_foxes.yaml").write_text(PROMPT + "  Edited.\n")
    before = store.read("result").count()
    with pytest.raises(ValueError, match="changed"):
        verbs.prep_db(store, str(folders / "in"), str(folders / "prompts"))
    assert store.read("result").count() == before and store.read("category").count() == 3
    verbs.prep_db(store, str(folders / "in"), str(folders / "prompts"), on_change="replace")
    assert store.read("result").count() == before and store.read("result").where("content LIKE '%new%'").count() == 1


def test_preflight_deletes_with_all_that_hangs_on(spark, store):
    store.create()
    rows = [(1, "a.md", "h\n\n" + GOOD, "s1"), (2, "b.md", "h\n\nGIF89a" + GOOD, "s2"), (3, "c.md", "h\n\n", "s3")]
    store.append("result", spark.createDataFrame(rows, "result_id long, filepath string, content string, content_sha256 string").selectExpr("*", "cast(null as int) part_number", "cast(null as long) parent_result_id", "cast(null as timestamp) created_at"))
    store.append("result_category", spark.createDataFrame([(i, 1, "yes", "", None) for i in (1, 2)], "result_id long, category_id long, match string, reasoning_trace string, created_at timestamp"))
    store.append("result_category_blockquote", spark.createDataFrame([(i, i, 1, "q", None) for i in (1, 2)], "blockquote_id long, result_id long, category_id long, blockquote string, created_at timestamp"))
    seen = preflight.run(store)
    assert seen["problematic"] == 2 and seen["deleted"] == 0 and seen["by_reason"] == {"binary content (GIF image)": 1, "no body after header": 1}
    assert store.read("excluded_file").count() == 0
    assert preflight.run(store, delete=True)["deleted"] == 2
    assert [store.read(t).count() for t in ("result", "result_category", "result_category_blockquote", "excluded_file")] == [1, 1, 1, 2]
    assert preflight.run(store)["problematic"] == 0


def test_first_record_wins_across_sources(spark, folders, store):
    out = folders / "out"
    out.mkdir()
    record = lambda m, t: json.dumps({"result_id": 1, "category_id": 2, "match": m, "reasoning_trace": t}, indent=2)
    (out / "r1_c2.json").write_text(record("no", "file"))
    (out / "r7_c8.json").write_text("broken {")
    (out / "results.jsonl").write_text("\n".join(["", json.dumps(json.loads(record("yes", "line"))), "  ", "broken", json.dumps({"result_id": 3, "category_id": 4})]) + "\n")
    store.create()
    records = files.reply_records(spark, str(out))
    assert importer.run(store, records) == {"total": 5, "imported": 1, "skipped": 1, "errors": 3, "blockquotes": 0}
    assert [(r.match, r.reasoning_trace) for r in store.read("result_category").collect()] == [("yes", "line")]
    assert sorted(map(tuple, files.completed_pairs(records).collect())) == [(1, 2), (3, 4), (7, 8)]


def test_reply_files_are_written_once(spark, tmp_path):
    df = spark.createDataFrame([("r1_c2", '{"result_id": 1, "category_id": 2, "match": "yes"}')], "custom_id string, record string")
    folder = str(tmp_path / "replies")
    assert [r.saved for r in files.write_replies(df, folder).collect()] == [True]
    assert [r.saved for r in files.write_replies(df, folder).collect()] == [False]
    assert [p.name for p in (tmp_path / "replies").iterdir()] == ["r1_c2.json"]
    assert list(map(tuple, files.completed_pairs(files.reply_records(spark, folder)).collect())) == [(1, 2)]


def test_pending_limit_is_exact(spark):
    result = spark.createDataFrame([(i, None, None, "x" * (10 if i < 9 else 99)) for i in range(10)] + [(20, 1, 3, "p" * 200)], "result_id long, part_number int, parent_result_id long, content string")
    category = spark.createDataFrame([(1,), (2,)], "category_id long")
    done = spark.createDataFrame([(i, 1) for i in range(5)], "result_id long, category_id long")
    got = pairs.pending_pairs(result, category, done, limit_chars=50, completed=spark.createDataFrame([(0, 2), (1, 2)], done.schema), limit=4).collect()
    assert list(map(tuple, got)) == [(2, 2), (4, 2), (5, 1), (5, 2)]  # 3 has a part, 9 is too large
    assert pairs.count_pending(result, category, done, 50).first().pending == 8 * 2 + 2 - 4


class _Server(BaseHTTPRequestHandler):
    calls: dict = {}

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        user = body["messages"][1]["content"]
        n = _Server.calls[user] = _Server.calls.get(user, 0) + 1
        if "flaky" in user and n < 3 or "dead" in user:
            self.send_error(503, "busy")
            return
        text = "no json" if "mute" in user else 'ok {"match": "yes", "blockquotes": []}'
        data = json.dumps({"choices": [{"message": {"content": text}}]}).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    def log_message(self, *_):
        pass


def test_http_backend_retries(spark):
    server = HTTPServer(("127.0.0.1", 0), _Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        rows = [(f"r{i}_c1", json.dumps({"messages": [{}, {"content": f"{t} {i}"}]})) for i, t in enumerate(["good", "flaky", "dead", "mute"] + ["good"] * 20)]
        df = spark.createDataFrame(rows, "custom_id string, body string")
        replies = infer.infer(df, infer.Http(f"http://127.0.0.1:{server.server_port}/"), concurrency=2)
        none = spark.createDataFrame([(5, 1)], "result_id long, category_id long")
        got = {r.custom_id: r for r in infer.outcomes(replies, none).cache().collect()}
        assert [(got[f"r{i}_c1"].outcome, got[f"r{i}_c1"].attempts) for i in range(6)] == [("saved", 1), ("saved", 3), ("failed", 4), ("failed", 4), ("saved", 1), ("skipped", 1)]
        assert got["r2_c1"].failure == "HTTP error: HTTPError 503: busy"
    finally:
        server.shutdown()


class _Pages:
    def fetch(self, time, url):
        if "missing" in url:
            raise LookupError("no snapshot")
        return f"<h1>{url}</h1><p>{time}</p>"


def test_fetching_goes_on_past_failures(spark, tmp_path):
    base = "https://web.archive.org/web/20040701020553/http://e.org/"
    urls = [base + "a", base + "b/", base + "missing", "http://no.archive/", base + "a"]
    out = verbs.fetch(spark, str(tmp_path / "md"), urls, _Pages())
    assert (out["written"], out["skipped"], out["failed"]) == (2, 0, 2) and sorted(e for _, e in out["errors"]) == ["LookupError: no snapshot", "not an archive URL: http://no.archive/"]
    assert sorted(p.name for p in (tmp_path / "md").iterdir()) == ["e.org_a.md", "e.org_b.md"]
    assert (tmp_path / "md/e.org_a.md").read_text() == "20040701020553/http://e.org/a\n\n# http://e.org/a\n\n20040701020553"
    assert verbs.fetch(spark, str(tmp_path / "md"), urls[:2], _Pages())["skipped"] == 2
    known = spark.createDataFrame([("e.org_a.md",)], "filename string")
    assert [r.filename for r in archive.planned(archive.demo_urls(spark, urls[:2]), known).collect()] == ["e.org_b.md"]
    replies = spark.createDataFrame([('[["urlkey"],["x"]]',), ("[]",), (None,)], "x string")
    assert [r[0] for r in replies.select(archive.snapshot_exists(F.col("x"))).collect()] == [True, False, False]


def test_prompt_files_without_a_library(monkeypatch):
    import builtins

    real = builtins.__import__
    with_library = files.parse_prompt(PROMPT)
    monkeypatch.setattr(builtins, "__import__", lambda name, *a, **k: (_ for _ in ()).throw(ImportError(name)) if name == "yaml" else real(name, *a, **k))
    own = files.parse_prompt(PROMPT)
    assert {k: str(v) for k, v in with_library.items()} == own


def test_new_categories_accumulate_versions(spark):
    known = spark.createDataFrame([("a", "1"), ("b", "1")], "category_filename string, prompt_sha256 string")
    seen = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "1")], known.schema)
    assert sorted(map(tuple, prep.new_categories(seen, known).collect())) == [("b", "2"), ("c", "1")]


def test_command_line(spark, folders, capsys):
    common = ["--store", str(folders / "s")]
    (folders / "sys.txt").write_text("You find terms.")
    assert cli.main(["prep-db", *common, "--input-dir", str(folders / "in"), "--prompts-dir", str(folders / "prompts")], spark) == 0
    assert cli.main(["preflight", *common], spark) == 0
    process = ["process", *common, "--prompts-dir", str(folders / "prompts"), "--system-prompt", str(folders / "sys.txt"), "--output-dir", str(folders / "out")]
    assert cli.main([*process, "--concurrency", "2", "--limit", "2"], spark) == 0
    assert cli.main(["import-results", *common, "--output-dir", str(folders / "out")], spark) == 0
    assert json.loads(capsys.readouterr().out.strip().rsplit("\n}\n", 1)[-1])["imported"] == 2
    with pytest.raises(SystemExit):
        cli.main(process, spark)


def test_small_tables_are_spread_and_large_ones_left_alone(spark, tmp_path):
    from docquarry.sources.tables import read_table, spread

    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one.parquet"))
    df = read_table(spark, str(tmp_path), "one")
    assert df.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and df.count() == 100
    many = spark.range(100).repartition(50)
    assert spread(many) is many


def test_rules_quote_all_lines_that_hold_a_term():
    user = pairs.PROMPT_HEAD + 'Look for "fox".' + pairs.PROMPT_DOCUMENT + "\n".join(f"a fox {k}" for k in range(30)) + pairs.PROMPT_TAIL
    reply = infer.Rules().ask(json.dumps({"messages": [{}, {"content": user}]}))
    text = reply["choices"][0]["message"]["content"]
    assert json.loads(text[text.index("{") :])["blockquotes"] == [f"a fox {k}" for k in range(30)]


class _Dies(Exception):
    pass


def _dying(store, monkeypatch, at):
    """Let the store's ``at``-th write or publication fail."""
    calls = {"n": 0}
    for name in ("_write", "_publish"):
        real = getattr(CorpusStore, name)

        def step(self, *a, real=real):
            calls["n"] += 1
            if calls["n"] == at:
                raise _Dies
            return real(self, *a)

        monkeypatch.setattr(CorpusStore, name, step)
    return calls


def test_an_import_that_dies_anywhere_leaves_nothing_half_done(spark, tmp_path, monkeypatch):
    value = '{"result_id": %d, "category_id": 1, "match": "yes", "blockquotes": ["a", "b"]}'
    records = spark.createDataFrame([(0, "f", k, value % k) for k in range(5)], "source_rank int, source string, line long, value string")
    for at in (1, 2, 3):
        store = CorpusStore(spark, str(tmp_path / f"s{at}"))
        store.create()
        with monkeypatch.context() as m:
            _dying(store, m, at)
            with pytest.raises(_Dies):
                importer.run(store, records)
        assert store.read("result_category").count() == store.read("result_category_blockquote").count() == 0
        assert importer.run(store, records)["imported"] == 5 and importer.run(store, records)["skipped"] == 5
        assert store.read("result_category").count() == 5 and sorted(r.blockquote_id for r in store.read("result_category_blockquote").collect()) == list(range(1, 11))


def test_a_replacement_that_dies_keeps_the_old_documents(spark, tmp_path, monkeypatch):
    row = lambda text: spark.createDataFrame([("a.md", f"h\n\n{text}" + GOOD, text)], "filepath string, content string, content_sha256 string")
    for at in (1, 2, 3, 4, 5):
        store = CorpusStore(spark, str(tmp_path / f"r{at}"))
        store.create()
        prep.sync_documents(store, row("old"))
        store.append("result_category", spark.createDataFrame([(1, 1, "yes")], "result_id long, category_id long, match string").selectExpr("*", "'' reasoning_trace", "cast(null as timestamp) created_at"))
        with monkeypatch.context() as m:
            _dying(store, m, at)
            with pytest.raises(_Dies):
                prep.sync_documents(store, row("new"), on_change="replace")
        assert [r.content_sha256 for r in store.read("result").collect()] == ["old"] and store.read("result_category").count() == 1
        prep.sync_documents(store, row("new"), on_change="replace")
        assert [r.content_sha256 for r in store.read("result").collect()] == ["new"] and store.read("result_category").count() == 0


def test_folders_are_compacted_and_vacuumed(spark, store):
    row = spark.createDataFrame([("a", "r", "s", None)], "filepath string, reason string, content_sha256 string, excluded_at timestamp")
    for _ in range(4):
        store.append("excluded_file", row)
    assert store.compact(3) == ["excluded_file"] and store.compact(3) == []
    assert len(store.versions("excluded_file")) == 1 and store.read("excluded_file").count() == 4
    assert store.vacuum() == 4 and store.read("excluded_file").count() == 4


class _DiesAfter:
    """A backend that a run loses after some replies."""

    def __init__(self, folder, most):
        self.folder, self.most = folder, most

    def ask(self, body):
        import os
        import uuid

        if self.most is not None and len(os.listdir(self.folder)) >= self.most:
            raise SystemExit("gone")
        open(os.path.join(self.folder, uuid.uuid4().hex), "w").close()
        return infer.Rules().ask(body)


def test_a_run_that_dies_keeps_the_waves_before(spark, store, folders):
    verbs.prep_db(store, str(folders / "in"), str(folders / "prompts"))
    (folders / "calls").mkdir()
    total = pairs.count_pending(store.read("result"), store.read("category"), store.read("result_category")).first().pending
    config = verbs.InferenceConfig(concurrency=1, attempts=1, wave=2, partitions=2)
    ask = lambda most: verbs.process(store, str(folders / "prompts"), "system", str(folders / "out"), _DiesAfter(str(folders / "calls"), most), config)
    with pytest.raises(Exception):
        ask(4)
    kept = files.completed_pairs(files.reply_records(spark, str(folders / "out"))).count()
    assert kept == 4
    out = ask(None)
    assert out["saved"] == total - kept and len(list((folders / "calls").iterdir())) == total
    assert verbs.import_results(store, str(folders / "out"))["imported"] == total


@pytest.mark.parametrize("reply", [["x"], "x", 5, {"choices": ["x"]}, {"choices": {"a": 1}}, {"choices": [{"message": ["x"]}]}, {"choices": [{"message": {"content": ["x"]}}]}, {"choices": [{"message": {"content": "{}", "reasoning_content": 5}}]}])
def test_replies_of_odd_forms_are_failures(reply):
    class Odd:
        def ask(self, body):
            return reply

    row = infer.attempt(Odd(), "r1_c1", "{}")
    assert row[3].startswith("Exception: TypeError") and not row[4]


def test_replies_without_content_are_told_apart():
    assert infer.read_reply(None)[3:] == (False, False) and infer.read_reply({})[3:] == (True, False) and infer.read_reply({"choices": [{}]}) == (None, None, None, True, True)


def test_a_large_reply_file_is_many_splits_in_order(spark, tmp_path):
    lines = [json.dumps({"result_id": k % 50, "category_id": 1, "match": "yes", "reasoning_trace": str(k)}) for k in range(5000)]
    (tmp_path / "results.jsonl").write_text("\r\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        records = files.jsonl_records(spark, str(tmp_path / "results.jsonl"))
        assert records.rdd.getNumPartitions() > 5
        assert [r.value for r in records.orderBy("source_rank", "source", "line").collect()] == lines
        none = spark.createDataFrame([], "result_id long, category_id long")
        assert sorted(int(r.reasoning_trace) for r in importer.new_verdicts(importer.classify(records, none)).collect()) == list(range(50))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_pages_that_are_there_are_not_downloaded_again(spark, tmp_path):
    class Counting(_Pages):
        def fetch(self, time, url):
            open(tmp_path / f"asked-{url[-1]}", "x").close()
            return super().fetch(time, url)

    base = "https://web.archive.org/web/20040701020553/http://e.org/"
    verbs.fetch(spark, str(tmp_path / "md"), [base + "a"], Counting())
    out = verbs.fetch(spark, str(tmp_path / "md"), [base + "a", base + "b"], Counting())  # a second request for the first page would raise
    assert (out["written"], out["skipped"], out["failed"]) == (1, 1, 0)


def test_reports_come_in_order(spark):
    from docquarry.plans import corpus

    t = corpus.corpus(spark, "/root/testdata/sf0.001")
    for view, keys in ((views.document_blockquotes, ("document_id", "category_id")), (views.blockquotes_by_category, ("result_id", "category_id"))):
        rows = [tuple(r[k] for k in keys) for r in view(t).collect()]
        assert len(rows) > 5 and rows == sorted(rows)
    done = spark.createDataFrame([], "result_id long, category_id long")
    rows = list(map(tuple, pairs.pending_pairs(t["result"], t["category"], done).collect()))
    assert rows == sorted(rows)
    reasons = [(r.documents, r.reason) for r in preflight.reasons(preflight.scan(t["result"], min_length=3000)).collect()]
    assert len(reasons) > 5 and reasons == sorted(reasons, key=lambda x: (-x[0], x[1]))


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    from docquarry import scratch

    class Context:
        master = "spark://host:7077"
        _jsc = SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isEmpty=lambda: True)))

    session = SimpleNamespace(sparkContext=Context(), conf=SimpleNamespace(get=lambda key, default: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.checkpoint_folder(session)


def test_thresholds_from_the_command_line(spark, folders, capsys):
    try:
        cli.main(["prep-db", "--store", str(folders / "t"), "--input-dir", str(folders / "in"), "--prompts-dir", str(folders / "prompts"), "--min-length", "1000"], spark)
        assert json.loads(capsys.readouterr().out)["skipped"] == 4
    finally:
        from docquarry.functions import text

        for setting, _ in text.SETTINGS.values():
            spark.conf.unset(setting)


class _TakesTheCorpusAway:
    """A backend that moves the corpus's texts elsewhere as soon as it is asked."""

    def __init__(self, folder):
        self.folder = folder

    def ask(self, body):
        import contextlib
        import os

        with contextlib.suppress(OSError):
            os.rename(self.folder, self.folder + "-gone")
        return infer.Rules().ask(body)


def test_the_corpus_is_read_once_whatever_the_number_of_units(spark, store, folders, monkeypatch):
    """Ten units and more are asked after the corpus has gone: nothing of it is read again."""
    verbs.prep_db(store, str(folders / "in"), str(folders / "prompts"), limit=2000, size=300, overlap=20)
    total = pairs.count_pending(store.read("result"), store.read("category"), store.read("result_category")).first().pending
    reads = []
    real = CorpusStore.read
    monkeypatch.setattr(CorpusStore, "read", lambda self, table: reads.append(table) or real(self, table))
    config = verbs.InferenceConfig(concurrency=1, wave=2, partitions=1)
    out = verbs.process(store, str(folders / "prompts"), "system", str(folders / "out"), _TakesTheCorpusAway(str(folders / "store/result")), config)
    assert out["saved"] == out["processed"] == total and total >= 20
    assert reads.count("result") == 2  # for the pairs, and for the texts
    assert len(list((folders / "out/replies").glob("layout=*/unit=*"))) == total / 2
    assert not (folders / "out/work").exists()


def test_a_run_goes_on_with_the_units_that_are_left(spark, store, folders, monkeypatch):
    """A run dies; the next one asks the units that are left, from the same layout; other prompts make a new one."""
    verbs.prep_db(store, str(folders / "in"), str(folders / "prompts"), limit=2000, size=300, overlap=20)
    (folders / "calls").mkdir()
    total = pairs.count_pending(store.read("result"), store.read("category"), store.read("result_category")).first().pending
    config = verbs.InferenceConfig(concurrency=1, attempts=1, wave=4, partitions=1)
    ask = lambda most, system="system": verbs.process(store, str(folders / "prompts"), system, str(folders / "out"), _DiesAfter(str(folders / "calls"), most), config)
    with pytest.raises(Exception):
        ask(9)
    layout = units.found(spark, str(folders / "out"))
    assert layout.pairs == total and len(list((folders / "out/work/done").glob("[0-9]*"))) == 2
    layouts = []
    real = units.lay_out
    monkeypatch.setattr(units, "lay_out", lambda *a: layouts.append(a) or real(*a))
    with pytest.raises(Exception):
        ask(14)
    assert not layouts and len(list((folders / "out/work/done").glob("[0-9]*"))) == 3  # 9 calls before, the unit that died among them
    with pytest.raises(Exception):
        ask(15, "another system prompt")
    assert len(layouts) == 1 and units.found(spark, str(folders / "out")).pairs == total - 12
    assert ask(None, "another system prompt")["saved"] == total - 12
    assert files.completed_pairs(files.reply_records(spark, str(folders / "out"))).count() == total
    assert ask(None)["processed"] == 0
    assert verbs.import_results(store, str(folders / "out"))["imported"] == total


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_units_are_ranges_of_documents(spark, size):
    rows = [(d, c) for d in range(30) for c in range(d % 4)]
    got = sorted(tuple(r) for r in units.ranges(spark.createDataFrame(rows, "result_id bigint, category_id bigint").repartition(5), size).collect())
    want, before = [], 0
    for d in range(30):
        if d % 4:
            want.append((before // size, d, list(range(d % 4))))
            before += d % 4
    assert got == want


def test_the_first_line_of_a_pair_wins_in_a_stream(spark, tmp_path):
    """A file in many splits that names each pair twice, far apart and in neighbouring lines."""
    from docquarry.streaming.imports import replies, stream_import

    record = lambda k, trace: json.dumps({"result_id": k, "category_id": 1, "match": "yes", "reasoning_trace": trace, "blockquotes": [trace, "é" * (k % 60)]}, ensure_ascii=False)
    lines = [record(k, "first") for k in range(1500)] + ["", "  "] + [record(k, "later") for k in reversed(range(1500))]
    lines += [x for k in range(1500, 2500) for x in (record(k, "first"), record(k, "later"))]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/part-0.jsonl").write_text("\n".join(lines))
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    store = CorpusStore(own, str(tmp_path / "store"))
    store.create()
    stream_import(store, str(tmp_path / "in"), str(tmp_path / "checkpoint"), glob="part-*", by_line=True).awaitTermination()
    got = store.read("result_category")
    assert got.count() == 2500 and got.where("reasoning_trace <> 'first'").count() == 0
    quotes = [(r.result_id, r.blockquote) for r in store.read("result_category_blockquote").orderBy("blockquote_id").collect()]
    assert quotes == [(k, q) for k in range(2500) for q in ("first", "é" * (k % 60))]
    # Only the files of a batch's ids are opened: their bounds are in the read.
    later = own.createDataFrame([(1, "x", 0, record(7000 + k, "first")) for k in range(5)], "source_rank int, source string, line long, value string")
    known = importer.known_verdicts(store, importer.parse(later))
    assert known.count() == 0 and "GreaterThanOrEqual(result_id,7000)" in known._jdf.queryExecution().toString()
    assert replies(store, str(tmp_path / "in"), glob="part-*", by_line=True).isStreaming


def test_compacted_verdicts_lie_by_document(spark, store):
    rows = lambda first: spark.createDataFrame([(k, 1, "yes", "t", None) for k in range(first, 4000, 4)], "result_id long, category_id long, match string, reasoning_trace string, created_at timestamp").repartition(2)
    for first in range(4):
        store.append("result_category", rows(first))
    assert store.compact(3) == ["result_category"]
    files_of = store.read("result_category").groupBy(F.input_file_name()).agg(F.min("result_id"), F.max("result_id")).collect()
    spans = sorted((r[1], r[2]) for r in files_of)
    assert store.read("result_category").count() == 4000 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


_FRESH = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession, functions as F
from docquarry.functions import split
from docquarry.functions.markdown import html_to_markdown
from docquarry.operators import {module}
from docquarry.plans import run as verbs
from docquarry.sources import archive, files, records
from docquarry.store import CorpusStore
from docquarry.streaming.imports import stream_import
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
store = CorpusStore(spark, {folder!r} + "/fresh-store")
store.create()
{code}
assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
print("fine")
"""
_VERBS = {
    "stream": "open({folder!r} + '/r1_c1.json', 'w').write('{{\"result_id\": 1, \"category_id\": 1, \"match\": \"yes\"}}'); stream_import(store, {folder!r}, {folder!r} + '/checkpoint').awaitTermination(); assert store.read('result_category').count() == 1",
    "prep": "verbs.prep_db(store, {folder!r} + '/in', {folder!r} + '/prompts', limit=2000, size=1500); assert store.read('result').where('part_number = 1').count() == 1",
    "html": "assert spark.range(1).select(html_to_markdown(F.lit('<h1>a</h1>'))).first()[0] == '# a'",
    "records": "i = records.write_archives(spark.range(3).select(F.lit('u').alias('url'), F.lit('2004').alias('time'), F.lit('x').alias('html')), {folder!r} + '/w'); i.write.parquet({folder!r} + '/i'); assert records.read_archives(spark, {folder!r} + '/w', {folder!r} + '/i').where('error IS NULL').count() == 3",
    "process": "verbs.prep_db(store, {folder!r} + '/in', {folder!r} + '/prompts'); assert verbs.process(store, {folder!r} + '/prompts', 's', {folder!r} + '/out', infer.Rules())['saved'] == 8",
}


@pytest.mark.parametrize("verb", sorted(_VERBS))
def test_a_script_elsewhere_whose_workers_lack_the_package(folders, verb):
    """Each verb ships its code, and leaves the session's settings as they are."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = _FRESH.format(repo=repo, module="infer", folder=str(folders), code=_VERBS[verb].format(folder=str(folders)))
    (folders / "script.py").write_text(code)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(folders / "script.py")], cwd=folders, env=env, capture_output=True, text=True, timeout=300)
    assert "fine" in done.stdout, done.stderr[-3000:]


def test_import_of_many_splits_has_few_tasks(spark, tmp_path, monkeypatch):
    """Each step after the read has as many tasks as a shuffle, and the first record of a pair wins as before."""
    from docquarry.operators import importer
    from docquarry.sources import files
    from docquarry.store import CorpusStore

    steps = []
    monkeypatch.setattr(importer, "materialise", lambda df, f=importer.materialise: steps.append(out := f(df)) or out)
    store = CorpusStore(spark, str(tmp_path / "store"))
    store.create()
    lines = spark.range(0, 400, 1, 40).selectExpr("""format_string('{"result_id": %d, "category_id": 1, "match": "yes", "reasoning_trace": "%d"}', id % 100, id) AS value""", "'x' AS file_name", "id div 10 AS file_block_start")
    assert importer.run(store, files.placed(lines, 1))["imported"] == 100
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [df.rdd.getNumPartitions() <= n for df, n in zip(steps, (shuffled, 2 * shuffled))] == [True, True]
    assert sorted((r.result_id, r.reasoning_trace) for r in store.read("result_category").collect()) == [(i, str(i)) for i in range(100)]


def test_many_small_files_are_few_tasks(spark, tmp_path):
    """Every file is read once, in tasks that don't grow with each few files."""
    for k in range(200):
        (tmp_path / f"d{k}.md").write_text(f"http://a/{k}\n\ntext é {k}\r\n")
        (tmp_path / f"r{k}_c1.json").write_text(f'{{"result_id": {k}}}')
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # each file is a piece
    try:
        found, replies = files.documents(spark, str(tmp_path)), files.json_files(spark, str(tmp_path))
        assert max(found.rdd.getNumPartitions(), replies.rdd.getNumPartitions()) <= 4 * spark.sparkContext.defaultParallelism
        rows = sorted((r.filepath.rsplit("/", 1)[1], r.content, r.valid_utf8) for r in found.collect())
        assert rows == sorted((f"d{k}.md", f"http://a/{k}\n\ntext é {k}\n", True) for k in range(200))
        assert sorted((r.source, r.value) for r in replies.collect()) == sorted((f"r{k}_c1.json", f'{{"result_id": {k}}}') for k in range(200))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
