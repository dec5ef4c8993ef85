"""URL rules against a plain version, and the held-out accuracy of the trees."""

import random
from collections import Counter

import duckdb
import pytest

from rowtide.llm import url_filter
from tests.conftest import SF_SMALL


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host):]
    for c in "?#":
        path = path.split(c, 1)[0]
    return "".join(x.lower() if x.isascii() else x for x in host), path


def rule_of(host, path, rules=url_filter.RULES):
    fits = [(-len(h) - len(p), -len(h), v != "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return min(fits)[3:] if fits else (None, None)


URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://EXAMPLE.NET/en/x", "http://example.net/en", "http://a.example.net/en/1?x=/y#z", "http://badexample.net/en/1", "http://net/", "http://net",
    "http://x.net?a=1", "http://x.net#/en/", "http://example.com/de/", "http://deep.sub.example.com/de/x", "http://example.com/fr/", "http://w.org/fr/", "http://org/fr/a", "http://org./fr/a", "http://\u00c4.net/en/",
    "https://a.b/c://d.net/en/", "x\n://a.net/p\nq?r", "http://..net/", "http://" + "a." * 3000 + "net/x", "http://e.org/" + "f" * 200_000, "http://example.net:80/en/", "http://cheap-pills-4-you.info/a?b=1&c=2&d=3",
]


def test_rules(spark):
    rows = [(i, u, "h", "r") for i, u in enumerate(URLS)] + [(None, URLS[7], None, None), (7, URLS[7], None, None)]
    got = url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, host string, rule string")).collect()
    want = Counter((i, *parts(u), rule_of(*parts(u))[0]) for i, u, *_ in rows)
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in got) == want
    for r in got:
        assert r.verdict == (rule_of(r.host, r.path)[1] or ("block" if r.score >= 0.5 else "allow"))
    assert [r.verdict for r in got if r.host == "cheap-pills-4-you.info"] == ["block"]


def test_other_rules(spark):
    rules = [("b.c", "/", "allow"), ("a.b.c", "", "block"), ("c", "/x/y", "allow"), ("b.c", "/x", "block")]
    urls = ["http://a.b.c/x/y", "http://b.c/x/y", "http://q.c/x/yz", "http://b.c/", "http://c"]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.filter_urls(frame, table).collect() if r.rule}
    assert got == {i: rule_of(*parts(u), rules) for i, u in enumerate(urls) if rule_of(*parts(u), rules)[0]}
    assert url_filter.filter_urls(frame, table.limit(0)).where("rule is not null").count() == 0
    assert url_filter.filter_urls(frame.limit(0)).count() == 0


def test_pages(spark):
    pages = duckdb.sql(f"SELECT page_id, url FROM '{SF_SMALL}/pages.parquet'").fetchall()
    got = url_filter.filter_urls(spark.read.parquet(f"{SF_SMALL}/pages.parquet")).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in got) == Counter((i, *parts(u), rule_of(*parts(u))[0]) for i, u in pages)


def test_held_out_accuracy():
    rows = [(u, 1) for u in url_filter.BLOCKED] + [(u, 0) for u in url_filter.ALLOWED]
    random.Random(0).shuffle(rows)
    right = 0
    for k in range(5):
        model = url_filter.fit(*zip(*[r for i, r in enumerate(rows) if i % 5 != k], strict=True))
        right += sum((s >= 0.5) == y for s, (_, y) in zip(model.score([u for u, _ in rows[k::5]]), rows[k::5], strict=True))
    assert right / len(rows) >= 0.9


@pytest.mark.parametrize("labels", [[], [0, 0], [1, 1, 1]])
def test_labels_of_one_class(spark, labels):
    frame = spark.createDataFrame([(f"http://a{i}.b/", y) for i, y in enumerate(labels)], "url string, label int")
    scores = url_filter.train(frame).score(["http://x.y/z", None])
    assert scores[0] == scores[1] == pytest.approx((sum(labels) + 1) / (len(labels) + 2))


def test_bad_labels(spark):
    frame = spark.createDataFrame([(None, 1), ("http://a.b/", None), ("http://a.b/", 7)], "url string, label int")
    assert url_filter.train(frame).trees == []
