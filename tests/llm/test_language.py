import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from docquarry.llm import language, queries

WORDS = {"aa": "ka ta po mi ru ne so".split(), "bb": "strx gnol wref blum kvist dorf".split(), "cc": "été où ça forêt naïf même".split()}


def sentence(lang, n=60):
    return " ".join(random.choice(WORDS[lang]) + random.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture
def docs(spark):
    random.seed(15)
    rows = [(i, sentence(lang), lang, f"www.{lang}.example.org", 1.0) for i, lang in enumerate(random.choice(list(WORDS)) for _ in range(600))]
    rows += [(1000, None, None, None, None), (1001, "", "aa", "x", 0.0), (1002, "12 34 !!", "aa", "x", 0.0), (1003, sentence("bb", 20000), "aa", None, 0.0), (1004, sentence("cc"), None, "www.cc.example.org", 0.0)]
    rows += [(1005, "zzqj xqzv jjqx vvzq qxzj zqvx " * 9, "aa", "x", 0.0)] + [rows[0]] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, confidence double"), rows


def test_held_out_accuracy_and_rejection(spark, docs):
    df, rows = docs
    model = language.fit(df.where("doc_id < 300"))
    assert model.languages == ["aa", "bb", "cc"]
    held_out = df.where("doc_id >= 300 AND doc_id < 1000")
    got = {r.doc_id: r for r in language.identify(held_out, model=model).collect()}
    assert all(got[i].lang == lang and got[i].kept for i, _, lang, _, _ in rows if i in got) and len(got) == 300
    every = language.identify(df, model=model)
    assert every.columns == ["doc_id", "th", "lang", "confidence", "text_lang", "kept"]
    odd = {r.doc_id: r for r in every.where("doc_id >= 1000").collect()}
    assert [odd[i].kept for i in range(1000, 1006)] == [False, False, False, True, True, False]
    assert odd[1003].lang == "bb" and odd[1004].lang == "cc" and odd[1005].lang == "und"
    kept = language.keep_identified(df, model=model)
    assert kept.columns == df.columns and kept.count() == len(rows) - 4


def brute_fusion(model, rows):
    """Verdicts of (id, text, declared, suffix, host) rows, in plain Python."""
    names = [*model.languages, "und"]
    size, lift = len(names), language.SMOOTH
    scored = [model.score(t) for _, t, *_ in rows]
    best = [int(np.argmax(ll)) if n else -1 for n, ll in scored]
    seen = [float(best.count(k)) for k in range(size)]
    overall = [(s + 1) / (sum(seen) + size) for s in seen]
    domain_of = lambda h: m[0] if h and (m := re.search(r"[^.]*\.[^.]*$", h)) else None

    def counts(keys):
        out = defaultdict(lambda: [0] * size)
        for key, b in zip(keys, best):
            if key is not None and b >= 0:
                out[key][b] += 1
        return out

    smooth = lambda c, above: [(x + a * lift) / (sum(c) + lift) for x, a in zip(c, above)]
    domains = {d: smooth(c, overall) for d, c in counts([domain_of(r[4]) for r in rows]).items()}
    hosts = {h: smooth(c, domains.get(domain_of(h), overall)) for h, c in counts([r[4] for r in rows]).items()}
    rates = []
    for k in (2, 3):
        rates.append({v: [math.log((x + lift * sum(c) / sum(seen)) / (s + lift)) for x, s in zip(c, seen)] for v, c in counts([r[k] for r in rows]).items()})
    out = {}
    for row, (n, ll), b in zip(rows, scored, best):
        fused = [x + math.log(p) for x, p in zip(ll, hosts.get(row[4], overall))]
        for table, value in zip(rates, row[2:4]):
            fused = [x + y for x, y in zip(fused, table.get(value, [0.0] * size))]
        top = max(fused)
        lang = names[fused.index(top)] if n else "und"
        confidence = 1 / sum(math.exp(x - top) for x in fused)
        out[row[0]] = lang, confidence, names[b] if b >= 0 else None, lang != "und" and round(confidence, 6) >= 0.5
    return out


def test_fusion_matches_brute_force(spark):
    random.seed(25)
    rows = []
    for i in range(500):
        lang = random.choice(list(WORDS))
        text = random.choice([sentence(lang, 20), sentence(lang, 1), random.choice("kx") + " ", "", None, "12"])
        rows.append((i, text, random.choice([lang, lang, "zz", None]), random.choice([lang, "com", None]), random.choice([f"www.{lang}.org", f"h{i}.{lang}.org", "one.site.com", "local", None])))
    df = spark.createDataFrame(rows, "id long, words string, said string, last string, site string")
    model = language.fit(df, id_column="id", text_column="words", label_column="said")
    got = language.identify(df, id_column="id", text_column="words", declared_column="said", host_column="site", suffix=df["last"], model=model).collect()
    want = brute_fusion(model, rows)
    for r in got:
        lang, confidence, text_lang, kept = want[r.id]
        assert (r.lang, r.text_lang) == (lang, text_lang) and abs(r.confidence - confidence) < 1e-5 and (r.kept == kept or abs(confidence - 0.5) < 1e-5)
    assert len(got) == len(rows) and sum(r.text_lang is not None and r.lang != r.text_lang for r in got) > 20


def test_held_out_labels_are_found_without_them(spark):
    """Accuracy on rows that the model wasn't fitted on, with no declaration as evidence; short texts gain by their hosts."""
    random.seed(26)
    rows = [(i, sentence(lang, random.choice([1, 1, 30])), lang, f"www.{lang}.org") for i, lang in enumerate(random.choice(list(WORDS)) for _ in range(1500))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = language.fit(df.where("doc_id < 500"))
    held = df.where("doc_id >= 500")
    right = lambda how: sum(r.lang == rows[r.doc_id][2] for r in language.identify(held, declared_column=None, model=model, **how).collect())
    alone, with_hosts = right({"host_column": None}), right({})
    assert alone >= 900 and with_hosts >= alone and with_hosts >= 990


@pytest.mark.parametrize("parts", [1, 7])
def test_no_label_is_dropped_in_any_partitioning(spark, parts):
    rows = [(i, f"w{i % 300:03d}" * 5, random.choice(["l%d", "L%d-XX", " l%d_y"]) % (i % 300)) for i in range(900)] + [(9000 + i, "common words here", "l0") for i in range(3000)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(parts), rows=100)
    assert model.languages == sorted(f"l{k}" for k in range(300))
    again = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3), rows=100)
    assert (model.table == again.table).all()


def test_other_evidence_decides_short_texts(spark):
    random.seed(16)
    rows = [(i, sentence("aa" if i % 2 else "bb"), "aa" if i % 2 else "bb", f"h{i % 2}.example.{'aa' if i % 2 else 'bb'}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = language.fit(df)
    short = spark.createDataFrame([(900, "k", "aa", None), (901, "k", "bb", None), (902, "k", None, "h1.example.aa"), (903, "k", None, "h0.example.bb"), (904, "k", None, "new.example.bb")], df.schema)
    got = {r.doc_id: r.lang for r in language.identify(df.union(short), model=model).where("doc_id >= 900").collect()}
    assert [got[i] for i in (900, 901, 902, 903, 904)] == ["aa", "bb", "aa", "bb", "bb"]


def test_pages_and_empty_tables(spark, docs):
    df, _ = docs
    model = language.fit(df)
    random.seed(17)
    page = f"<html lang='aa'><script>strx gnol wref</script><body><p>{sentence('aa')}</p></body></html>"
    pages = spark.createDataFrame([(1, "http://x.example.aa/y", page), (2, None, None), (3, "", f"<p>{sentence('cc')}")], "page_id long, url string, html string")
    got = {r.page_id: (r.lang, r.kept) for r in language.identify_pages(pages, model).collect()}
    assert got == {1: ("aa", True), 2: ("und", False), 3: ("cc", True)}
    assert language.identify(df.limit(0)).count() == 0 and language.keep_identified(df.limit(0)).count() == 0
    assert language.identify_pages(pages.limit(0), model).count() == 0


def test_query_covers_documents_and_pages(spark, docs, tmp_path):
    df, rows = docs
    df.withColumn("n_chars", df["confidence"]).drop("confidence").write.parquet(str(tmp_path / "documents.parquet"))
    random.seed(18)
    # Pages without a word that tells: the suffix, or the domain above a new host, decides.
    page = lambda lang, n: f"<html lang='{lang}'><p>{sentence(lang)}</p></html>" if n < 100 else "<p>k</p>"
    pages = [(n * 2 + (lang == "bb"), f"http://h{n}.site.{lang}/x", page(lang, n)) for n in range(104) for lang in ("aa", "bb")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.op6_language_id(spark, str(tmp_path)).collect()
    assert sum(r.doc_id is not None for r in got) == len(rows)
    found = {r.page_id: r.lang for r in got if r.page_id is not None}
    assert found == {i: url.split("/")[2][-2:] for i, url, _ in pages}
