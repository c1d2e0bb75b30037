import random
import re
from collections import Counter

import pytest

from docquarry.llm import quality, queries


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 8)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered)


def test_measures_match_brute_force():
    random.seed(10)
    for _ in range(500):
        text = "".join(random.choice(["a ", "b ", "é\n", "# ", "a b a b a b a b ", "\n", "\x85", "*"]) for _ in range(random.randint(0, 40)))
        assert quality.measure_text(text.encode())[:5] == brute(text), text
    assert quality.measure_text(None)[:5] == (0, 0, 0, 0, 0)
    assert quality.measure_text(b"a " * 30000)[4] == 30000


def test_lines_above_the_limit_deplete_documents(spark):
    random.seed(11)
    fresh = lambda n: " ".join("w%d" % random.randrange(10**6) for _ in range(n))
    menu = "Home " + fresh(40)
    rows = [(i, f"{menu}\n{fresh(30)}", "a") for i in range(12)]
    rows += [(100 + i, f"  {menu.upper()} \n{fresh(4)}", "a") for i in range(3)]
    rows += [(200, menu, "b"), (201, fresh(40), "a"), (202, None, None), (203, "", "a"), (204, "x " * 50, "a"), (205, fresh(40), None)]
    rows += [(300 + i, "same text " + " ".join(map(str, range(40))), "a") for i in range(40)]  # copies are one document
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, source string, host string")
    got = {r.doc_id: r for r in quality.judge(df, spread=1, min_documents=10, max_removed=0.8).collect()}
    assert len(got) == len(rows)
    texts = {i: t for i, t, _ in rows}
    for i, r in got.items():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(texts[i])
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
    kept = {i for i, r in got.items() if r.kept}
    assert kept == set(range(12)) | {200, 201, 205} | set(range(300, 340))
    assert got[0].removed_words == 41 and got[100].removed_words == 41 and got[200].removed_words == 0
    assert quality.judge(df.limit(0)).count() == 0


@pytest.mark.parametrize("size", [200, 2000])
def test_limit_comes_from_the_lines_of_the_host_and_not_from_its_size(spark, size):
    # Fifty documents share a menu: it is common in a host of any size.
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30)) + f"\npair {i // 2 % 100}" + ("\nshared line of this host" if i < 50 else ""), "h") for i in range(size)]
    rows += [(10_000 + i, " ".join(f"v{i}x{k}" for k in range(30)) + f"\nquote of many {i % 30}", "even") for i in range(200)] + [(20_000 + i, f"quote of many {i % 30}\nquote {i}", "even") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = quality.judge(df, spread=10, min_documents=10)
    assert found.where("removed_words >= 5 AND doc_id < 50").count() == 50
    # Where each line is in a dozen documents, that many are no outliers.
    assert found.where("removed_words > 0 AND doc_id >= 10000").count() == 0
    assert quality.judge(df, spread=10, min_documents=size).where("removed_words > 0").count() == 0


def test_documents_made_of_shared_lines_are_rejected_in_the_query(spark, tmp_path):
    random.seed(13)
    fresh = lambda n: " ".join("u%d" % random.randrange(10**6) for _ in range(n))
    menu = "All of this stands below every page " + fresh(20)
    rows = [(i, f"{fresh(40)}\nline {i // 2} twice", "en", "s", 1) for i in range(100)] + [(200 + i, f"{fresh(15)}\n{menu}", "en", "s", 1) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op4_quality_rules(spark, str(tmp_path)).collect()}
    assert all(not r.base_failed and r.kept == (i < 200) for i, r in got.items()) and len(got) == 130


def test_cleaned_texts_lose_the_common_lines(spark):
    random.seed(12)
    fresh = lambda n: " ".join("v%d" % random.randrange(10**6) for _ in range(n))
    menu = "Home About " + fresh(40)
    bodies = {i: f"{fresh(30)}\n\n {fresh(20)} é" for i in range(12)}
    rows = [(i, f"{menu}\n{body}\n  {menu.upper()}", "a", "k") for i, body in bodies.items()]
    rows += [(100, f"{menu}\n{fresh(4)}", "a", "k"), (200, f"{menu}\n{bodies[0]}", "b", "k"), (201, None, "a", "k"), (202, fresh(40), None, "k"), (0, *rows[0][1:]), (None, rows[1][1], "a", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, common string")
    how = {"spread": 1, "min_documents": 10, "max_removed": 0.8}
    got = quality.cleaned(df, **how)
    assert got.columns == df.columns
    want = [(i, bodies[i], "a", "k") for i in range(12)] + [(200, f"{menu}\n{bodies[0]}", "b", "k"), rows[-3], (0, bodies[0], "a", "k"), (None, bodies[1], "a", "x")]
    assert Counter(map(tuple, got.collect())) == Counter(want)
    lost = {r.doc_id: r.removed_words for r in quality.judge(df, **how).collect()}
    assert all(lost[i] == brute(t)[0] - brute(bodies[i])[0] for i, t, _, _ in rows[:12])
    assert quality.cleaned(df.limit(0)).count() == 0
