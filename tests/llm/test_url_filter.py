import random

import pytest

from docquarry.llm import url_filter


def brute(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, "allow"
    best = max(fits)
    return host, path, best[3], best[4]


RULES = [*url_filter.RULES, ("ads.example.net", "/", "block"), ("ads.example.net", "/ok", "allow"), ("ads.example.net", "/ok/not", "block"), ("a-b.org", "/", "block"), ("b.org", "", "block"), ("org", "/fr/x", "block"), ("com", "/deep/path/", "block")]


@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_sweep_matches_brute_force(spark, ranges):
    random.seed(12)
    hosts = ["net", "x.net", "example.net", "ads.example.net", "a.ads.example.net", "example.com", "a.example.com", "org", "b.org", "a-b.org", "x.a-b.org", "bb.org", "NET", "ex.am.ple", "", "net.", "example.net:80"]
    paths = ["", "/", "/en/", "/en", "/de/1", "/fr/x/y", "/ok", "/ok/not/", "?q=/en/", "#/", "/deep/path/1", "/a://b/"]
    urls = [f"{s}://{h}{p}{t}" for s in ("http", "HTTPS") for h in hosts for p in paths for t in ("", "?x=1", "#y")]
    urls = urls + urls[:50] + [None, "", "no scheme", "://", "a:b//c"] + ["http://hot.example.net/en/%d" % i for i in range(500)]
    random.shuffle(urls)
    df = spark.createDataFrame([(i, u, "z", "p") for i, u in enumerate(urls)], "page_id long, url string, rule string, path string")
    got = sorted(tuple(r) for r in url_filter.judge_urls(df, url_filter.rule_frame(spark, RULES), ranges=ranges).collect())
    assert got == [(i, *brute(u, RULES)) for i, u in enumerate(urls)]


def test_empty_tables_and_null_ids(spark):
    df = spark.createDataFrame([(None, "http://x.net/"), (None, "http://x.net/")], "page_id long, url string")
    rules = url_filter.rule_frame(spark, RULES)
    assert url_filter.judge_urls(df, rules).collect() == [(None, "x.net", "/", "net/", "block")] * 2
    assert url_filter.judge_urls(df.limit(0), rules).count() == 0
    assert [r.verdict for r in url_filter.judge_urls(df, rules.limit(0), default="block").collect()] == ["block"] * 2
