import hashlib
import re
from collections import Counter, defaultdict

import corpus_pipeline
import sentencepiece
from pyspark.sql import functions as F

from docquarry.llm import language, pieces, pii
from docquarry.llm.token_counts import tokenizer_path
from tests.llm.test_language import brute_fusion
from tests.llm.test_mixing import brute_targets
from tests.llm.test_pii import BASE, brute, brute_discovery
from tests.llm.test_simhash import near_components


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def mask(text, spans):
    out, at = "", 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += text[at:start] + f"<{kind.upper()}>"
        at = max(at, end)
    return out + text[at:]


def test_pipeline_matches_brute_force(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = spark.createDataFrame(
        [(5000, "### $$$ 12345 ---", "en", "src0", 17), (5001, None, None, None, None), (5002, "", "en", None, 0), (5003, "the and of " * 9000, "en", "src1", 99000)], docs.schema
    )
    token = F.concat(F.lit(' the token = "'), F.sha1(F.col("doc_id").cast("string")), F.lit('" '))
    secret = docs.where("doc_id BETWEEN 20 AND 29").select((F.col("doc_id") + 6000).alias("doc_id"), F.concat("text", token, F.reverse("text")).alias("text"), "lang", "source", "n_chars")
    docs = docs.union(extra).union(docs.limit(3)).union(secret)
    # Other columns, with names that the stages work with or add.
    clashes = ["id", "th", "key", "hash", "position", "part", "turn", "__id", "__th", "__text", "piece_ids", "keep", "spans", "best"]
    docs = docs.select("*", *[(F.col("doc_id") * 10 + n).cast("string").alias(c) for n, c in enumerate(clashes)])
    docs.coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == [*docs.columns, "piece_ids_", "lattice_ids", "n_pieces", "round_trip"]
    got = got.collect()
    assert all(r[c] == str(r.doc_id * 10 + n) for r in got for n, c in enumerate(clashes))

    rows = spark.read.parquet(str(tmp_path / "documents.parquet"))
    primary = lambda lang: lang and lang.lower().split("-")[0]
    verdicts = brute_fusion(language.fit(rows), [(r.doc_id, r.text, primary(r.lang), None, r.source) for r in rows.collect()])
    kept = {i for i, v in verdicts.items() if v[3]}
    assert not {5000, 5001, 5002} & kept and len(kept) >= 200
    rows = [r for r in rows.collect() if r.doc_id in kept]
    least = near_components([r.doc_id for r in rows], [r.text for r in rows])
    rows = list({r.doc_id: r for r, c in zip(rows, least) if r.doc_id == c}.values())
    extracted = pii.extract(spark.createDataFrame(rows, docs.schema)).collect()
    found = {r.doc_id: brute(r.text) for r in rows}
    for i, kind, start, end in brute_discovery(extracted):
        found[i].append((pii.NAMES[kind], start, end))
    assert any(found.values()) and set(BASE) == set(pii.KINDS) and any(k == "secret" for x in found.values() for k, _, _ in x)
    rows = [(r.doc_id, mask(r.text, found[r.doc_id]), r.source) for r in rows]
    total, docs_of = defaultdict(int), defaultdict(list)
    for i, t, s in rows:
        total[s] += words(t)
        docs_of[s].append((hashlib.md5(f"{i} {t}".encode()).hexdigest(), i, t))
    want = Counter()
    for s, goal in brute_targets(total).items():
        passes, rest = divmod(int(round(goal, 6) + 0.5), total[s]) if total[s] else (0, 0)
        at = 0
        for _, i, t in sorted(docs_of[s]):
            want[i, t] += passes + (2 * at + words(t) < 2 * rest)
            at += words(t)
    assert Counter((r.doc_id, r.text) for r in got) == +want
    assert all(r.round_trip and r.n_chars == len(r.text) for r in got)
    model = pieces.load("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    assert all(model.decode(r.lattice_ids) == r.text and list(r.piece_ids_) == library.encode(r.text) for r in got)


def test_empty_documents(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
