import json
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docquarry.arrow import SLICE, in_bytes
from docquarry.functions import markdown, split, strict_json, text


def column(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    return [r[1] for r in sorted(df.select("i", expression(F.col("x"))).collect())]


def body_of(content):
    return content.split("\n\n", 1)[1] if "\n\n" in content else content


CONTENTS = ["", "a", "head\n\nbody", "head\n\n", "\n\nx", "a\n\nb\n\nc", "h\n\n" + "x" * 99, "h\n\n" + "x" * 100, "h\n\nPK" + "x" * 200, "h\n\nBMI is text" + "x" * 99, "h\n\nGIF89a" + "x" * 99, "h\n\n" + "x" * 99 + "\0\0",
            "h\n\n" + "x" * 85 + "\x01" * 15, "h\n\n" + "x" * 84 + "\x01" * 16, "h\n\n ​" * 60, "h\n\n" + "é 漢\t\r\n🙂" * 30, "%PDF" + "x" * 100, "h\n\n7z" + "x" * 100]


def test_header_and_body(spark):
    assert column(spark, CONTENTS, text.content_body) == [body_of(c) for c in CONTENTS]
    assert column(spark, CONTENTS, text.url_header) == [c.split("\n\n", 1)[0] if "\n\n" in c else "" for c in CONTENTS]


def reason(content, flight):
    """The checks in their order, in plain Python."""
    if not content:
        return "empty content"
    body = body_of(content)
    if flight and not body:
        return "no body after header"
    if len(body) < 100:
        return f"body too short ({len(body)} chars, need 100)" if flight else f"content too short ({len(body)} chars)"
    for magic, name in text.MAGIC:
        if body[:20].encode().startswith(magic):
            return f"binary content ({name})" if flight else f"binary content detected ({name})"
    if "\0" in content:
        return "contains null bytes"
    ratio = sum(c.isprintable() or c in "\n\r\t" for c in body) / len(body)
    if ratio < 0.85:
        return f"low printable ratio ({ratio:.1%}" + (", need 85%)" if flight else ")")
    return None


def test_validation(spark):
    df = spark.createDataFrame(list(enumerate(CONTENTS)), "i int, content string")
    for flight in (False, True):
        rows = sorted(text.with_reason(df, flight=flight).collect())
        assert [r.reason for r in rows] == [reason(c, flight) for c in CONTENTS] and text.with_reason(df).columns == ["i", "content", "reason"]
    odd = spark.createDataFrame([(1, None), (2, "h\n\nshort")], df.schema)
    assert [r.reason for r in sorted(text.with_reason(odd, min_length=3).collect(), key=lambda r: r.i)] == ["empty content", None]


def test_percentages_round_the_exact_ratio(spark):
    """88.35 % of 2000 characters is a double below that tie, and 0.05 % one above it; 88.25 % is a true tie."""
    sizes = [(1767, 2000), (1, 2000), (13, 2000), (1699, 2000), (353, 400), (355, 400), (1, 3000), (1, 30000), (2, 3)] + [(p, 2000) for p in range(3, 1767, 90)]
    df = spark.createDataFrame([(i, "h\n\n" + "x" * p + "\x01" * (n - p)) for i, (p, n) in enumerate(sizes)], "i int, content string")
    rows = sorted(text.with_reason(df, min_length=1, min_printable=0.9).collect())
    assert [r.reason for r in rows] == [f"low printable ratio ({100 * (p / n):.1f}%)" for p, n in sizes]


def test_urls_and_names(spark):
    good = "https://web.archive.org/web/20040701020553/http://www.kidlink.org:80/KIDFORUM/"
    urls = [good, "http://web.archive.org/web/20040701020553/x", "https://web.archive.org/web/2004/x", "http://example.org", "https://web.archive.org/web/20040701020553/"]
    assert column(spark, urls, text.archive_time) == ["20040701020553"] * 2 + [None] * 3
    assert column(spark, urls, text.archive_target) == ["http://www.kidlink.org:80/KIDFORUM/", "x", None, None, None]
    names = ["http://www.kidlink.org:80/KIDFORUM/", "https://a/b?c=d&e\\f", "/x//y/", "http://" + "a" * 300]
    assert column(spark, names, text.file_name) == ["www.kidlink.org_80_KIDFORUM.md", "a_b_c_d_e_f.md", "x_y.md", "a" * 200 + ".md"]
    assert column(spark, ["r12_c3", "r1_cx", ""], lambda c: text.custom_id_parts(c)[0]) == [12, None, None]


def test_reasoning_ends_at_the_last_brace(spark):
    texts = ['why {"a": {"b": 1}}', "no brace", "{", " \t 　so \x1f {x", "", 'a {"x": 1} b {"y": 2}']
    want = [t[: t.rfind("{")].strip() if "{" in t else "" for t in texts]
    assert column(spark, texts, text.reasoning_before_json) == want


OBJECTS = ["", "no", '{"a": 1}', 'x {"a": "}"} y', '{"a": "\\"}"}', '{"a": {"b": 2}} {"c": 3}', "{'a': 1}", '{"a": 1', '{bad} {"a": 1}', '{"a": 1, "a": 2}', '{"a": NaN}', '{"t": "' + "x" * 5000 + '"}', '"{" {"a": 1}']


def scan(content):
    """Brace counting character by character, as a second implementation."""
    start = content.find("{")
    depth, quoted, skip = 0, False, False
    for i in range(start, len(content)) if start >= 0 else ():
        c = content[i]
        if skip:
            skip = False
        elif quoted and c == "\\":
            skip = True
        elif c == '"':
            quoted = not quoted
        elif not quoted and c in "{}":
            depth += 1 if c == "{" else -1
            if depth == 0:
                try:
                    return json.loads(content[start : i + 1])
                except ValueError:
                    return None
    return None


def test_first_objects():
    random.seed(1)
    odd = ["".join(random.choice('{}"\\:1,a ') for _ in range(random.randint(0, 25))) for _ in range(4000)]
    for t in OBJECTS + odd:
        assert repr(strict_json.first_object(t)) == repr(scan(t)), t


@pytest.mark.parametrize(
    "value, status, match, quotes, bad",
    [
        ('{"result_id": 1, "category_id": 2, "match": "yes", "blockquotes": ["a", 1, true, 1.5]}', "ok", "yes", ["a", "1", "1", "1.5"], False),
        ('{"result_id": "1", "category_id": 2.0, "match": 1}', "ok", "1", [], False),
        ('{"result_id": 1, "category_id": 2, "match": true}', "ok", "1", [], False),
        ('{"result_id": 1, "category_id": 2, "match": 1.0}', "ignored", "1.0", [], False),
        ('{"result_id": 1, "category_id": 2, "match": "YES"}', "ignored", "YES", [], False),
        ('{"result_id": null, "category_id": 2, "match": "no"}', "ignored", "no", [], False),
        ('{"result_id": 1, "category_id": 2, "match": null}', "ignored", None, [], False),
        ('{"result_id": 1, "category_id": 2, "match": []}', "error", None, [], False),
        ('{"result_id": 1.5, "category_id": 2, "match": "no"}', "error", None, [], False),
        ('{"result_id": 1, "category_id": 2}', "error", None, [], False),
        ('{"result_id": 1, "category_id": 2, "match": "no", "blockquotes": "ab"}', "ok", "no", ["a", "b"], False),
        ('{"result_id": 1, "category_id": 2, "match": "no", "blockquotes": null}', "ok", "no", [], False),
        ('{"result_id": 1, "category_id": 2, "match": "no", "blockquotes": ["a", null, "b"]}', "ok", "no", ["a"], True),
        ('{"result_id": 1, "category_id": 2, "match": "no"} trailing', "error", None, [], False),
        ("[1]", "error", None, [], False),
        (None, "error", None, [], False),
    ],
)
def test_records(value, status, match, quotes, bad):
    r = strict_json.flatten_record(value)
    assert (r["status"], r["blockquotes"], r["quote_error"]) == (status, quotes, bad)
    assert status == "error" or r["match"] == match


def test_missing_trace_is_empty_but_null_stays_null():
    base = '{"result_id": 1, "category_id": 2, "match": "no"'
    assert strict_json.flatten_record(base + "}")["reasoning_trace"] == ""
    assert strict_json.flatten_record(base + ', "reasoning_trace": null}')["reasoning_trace"] is None


def test_replies(spark):
    rows = [
        ("r1_c2", 'It is. {"match": "yes", "blockquotes": ["a \\"q\\""]}', None, None, True, True),
        ("r1_c3", '{"match": "no"}', "thought \"x\"", None, True, True),
        ("r1_c4", "x", None, "URLError: gone", False, False),
        ("r1_c5", None, None, None, False, False),
        ("r1_c6", None, None, None, True, False),
        ("r1_c7", None, None, None, True, True),
        ("r1_c8", "line\n" + "y" * 300, None, None, True, True),
        ("r1_c9", '{"blockquotes": []}', None, None, True, True),
    ]
    df = spark.createDataFrame(rows, "custom_id string, content string, reasoning_content string, error string, has_response boolean, has_choices boolean")
    got = {r.custom_id: r for r in strict_json.parse_replies(df).collect()}
    assert json.loads(got["r1_c2"].record) == {"result_id": 1, "category_id": 2, "match": "yes", "reasoning_trace": "It is.", "blockquotes": ['a "q"']}
    assert json.loads(got["r1_c3"].record)["reasoning_trace"] == 'thought "x"' and json.loads(got["r1_c3"].record)["blockquotes"] == []
    assert [got[f"r1_c{k}"].failure for k in range(4, 10)] == [
        "HTTP error: URLError: gone", "No response received", "No choices in response", "Empty content in response",
        "No JSON found. Preview: " + ("line " + "y" * 300)[:200] + "...", "Missing 'match' field: {'blockquotes': []}",
    ]


def test_split_keeps_the_text(spark):
    random.seed(2)
    body = "".join(random.choice(["word ", "end. ", "\n", "\n\n", "\n---\n", "x" * 50, "\n* * *\n"]) for _ in range(3000))
    parts = split.split_text(body, 1000, 100)
    assert all(0 < len(p) <= 1000 and p == p.strip() for p in parts)
    assert all(p in body for p in parts)
    at = 0
    for p in parts:  # in order, and no character but white space between them
        found = body.index(p, max(0, at - 150))
        assert not body[at:found].strip()
        at = max(at, found + len(p))
    assert not body[at:].strip()
    assert split.split_text("z" * 2500, 1000, 0) == ["z" * 1000, "z" * 1000, "z" * 500]
    df = spark.createDataFrame([(1, "head\n\n" + body), (2, "head\n\nshort")], "i int, content string")
    rows = sorted(split.split_documents(df, 5000, 1000, 100).collect(), key=lambda r: r.part_number)
    assert [r.part_number for r in rows] == list(range(1, len(parts) + 1)) and {r.i for r in rows} == {1}
    assert [r.part_content for r in rows] == ["head\n\n" + p for p in parts]


def test_markdown():
    page = "<html><head><title>t</title></head><body><h1>Hello</h1><p>World <b>bold</b> <a href='/x'>link</a></p><ul><li>one</li><li>two<ol><li>in</li></ol></li></ul><script>no()</script><pre>a  b</pre>x<br>y</body></html>"
    out = markdown.to_markdown(page)
    assert out.startswith("# Hello\n\nWorld **bold** [link](/x)\n\n* one\n* two")
    assert "no()" not in out and "t\n" not in out[:3] and "1. in" in out and "a  b" in out and "x  \ny" in out
    assert markdown.to_markdown(None) == "" and not re.search("\n{3}", out)


def _markup(rng, depth=0):
    """A random body as two texts: with all end tags, and without those that may be left out."""
    full, short = "", ""
    for _ in range(rng.randint(1, 4)):
        word = "".join(rng.choice("abc") for _ in range(4))
        kind = rng.choice(["p", "ul", "table", "h2", "div"] if depth < 2 else ["p", "h2"])
        if kind == "p":
            full, short = full + f"<p>{word} {word}</p>", short + f"<p>{word} {word}"
        elif kind == "h2":
            full, short = full + f"<h2>{word}</h2>", short + f"<h2>{word}</h2>"
        elif kind == "div":
            a, b = _markup(rng, depth + 1)
            full, short = full + f"<div>{a}</div>", short + f"<div>{b}</div>"
        elif kind == "ul":
            full, short = full + f"<ul><li>{word}</li><li>x</li></ul>", short + f"<ul><li>{word}<li>x</ul>"
        else:
            full += f"<table><tr><th>{word}</th><th>n</th></tr><tr><td>1</td><td>2</td></tr></table>"
            short += f"<table><tr><th>{word}<th>n<tr><td>1<td>2</table>"
    return full, short


def test_markdown_without_the_end_tags_that_may_be_missing():
    rng = random.Random(21)
    for _ in range(300):
        full, short = _markup(rng)
        want = markdown.to_markdown(f"<html><head><title>t</title><meta charset=x></head><body>{full}</body></html>")
        assert want and markdown.to_markdown(f"<head><title>t</title><meta charset=x>{short}") == want, short
        assert markdown.to_markdown(f"<title>t</title><noscript></noscript><body>{short}") == want
    assert markdown.to_markdown("<head><title>t</title><body><p>Hello world</p>") == "Hello world"
    assert markdown.to_markdown("<noscript>Enable it</noscript><template>no</template>yes") == "Enable ityes"
    assert markdown.to_markdown("<table><tr><th>a<th>b<tr><td>1\n2<td><a href='/u'>x</a></table>") == "| a | b |\n| --- | --- |\n| 1 2 | [x](/u) |"


def test_kinds_of_reasons_are_few(spark):
    from docquarry.operators import preflight

    rows = [(f"body too short ({n} chars, need 100)", n) for n in range(50)] + [(f"low printable ratio ({n / 10}%, need 85%)", 1) for n in range(2000)] + [("binary content (MP3 with ID3 tag)", 7), ("binary content (7-Zip archive)", 1)]
    got = [(r.kind, r.documents) for r in preflight.kinds(spark.createDataFrame(rows, "reason string, documents long")).collect()]
    assert got == [("low printable ratio (N%, need N%)", 2000), ("body too short (N chars, need N)", 1225), ("binary content (MP3 with ID3 tag)", 7), ("binary content (7-Zip archive)", 1)]


def test_markdown_of_quotations_and_open_templates():
    from docquarry.functions.markdown import to_markdown

    assert to_markdown("<blockquote><p>a</p><p>b<br>c</p></blockquote>d") == "> a\n>\n> b  \n> c\n\nd"
    assert to_markdown("x<blockquote>a<blockquote>b</blockquote></blockquote>") == "x\n\n> a\n>\n> > b"
    assert to_markdown("<blockquote>left open <b>c</b>") == "> left open **c**"
    assert to_markdown("<blockquote> </blockquote><p>a") == "a"
    assert to_markdown("a<template>b") == "ab"
    assert to_markdown("a<template>b</template>c") == "ac"


def test_long_texts_are_python_objects_a_slice_at_a_time(spark):
    """A batch of any size is taken in slices of few bytes, in order and whole; a long row is a slice of its own."""
    texts = ["x" * 400, None, "é" * 300, "y" * 5000, "", "z"] * 50
    for columns in ([texts], [texts, texts[::-1]]):
        found = list(in_bytes([tuple(map(pa.array, columns)), tuple(pa.array([], pa.string()) for _ in columns)], 1000))
        assert [list(sum(x, [])) for x in zip(*found)] == columns
        assert all(len(rows[0]) == 1 or sum(len((t or "").encode()) for x in rows for t in x) <= 1000 for rows in found)
    bodies = [f"h{i}\n\n" + f"words of text {i}. " * n for i, n in enumerate([1, 9000, 40_000, 3, 100_000, 200, 30_000, 5])] + [None]
    assert sum(len(b or "") for b in bodies) > 2 * SLICE
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, content string").coalesce(1)
    got = [r[1] for r in sorted(df.select("i", split.split_column(F.col("content"), 5000, 1000, 100)).collect())]
    assert got[:-1] == [[b] if len(b) <= 5000 else [f"h{i}\n\n{p}" for p in split.split_text(body_of(b), 1000, 100)] for i, b in enumerate(bodies[:-1])] and got[-1] is None
    pages = [f"<p>{b}</p>" for b in bodies[:-1]] + [None]
    assert column(spark, pages, markdown.html_to_markdown) == [markdown.to_markdown(x) for x in pages]
