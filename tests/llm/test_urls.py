from __future__ import annotations

import re

from rillflow.llm.queries import URL_RULES
from rillflow.llm.urls import filter_urls

SCHEMA = "page_id bigint, url string, html string, id string, label int, host string"
ODD = [
    None,
    "",
    "no scheme",
    "://",
    "http://",
    "http://EXAMPLE.com/en/x",
    "http://www.example.com/en/",
    "http://a.www.example.com/en/1",
    "http://notexample.com/en/1",
    "http://example.com/EN/1",
    "http://example.com",
    "http://example.com?x=/en/",
    "http://x.net/es/1#a?b",
    "http://net/fr/",
    "x://y://z.com/p",
    "http://ÄB.com/q",
    "http://a.com/line\nbreak?x",
    "http://a.org/" + "p/" * 20_000,
]


def plain(url):
    """Host, path, rule and verdict (none where the trees decide), in plain Python."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = max(
        (r for r in URL_RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])),
        key=lambda r: len(r[1] + r[2]),
        default=None,
    )
    return (host, path, best and best[1] + best[2], best and best[0])


def test_rules_and_parts(spark):
    made = [f"http://{h}.example.{t}/{p}/{k}?a=1" for k, (h, t, p) in enumerate((h, t, p) for h in ("a", "www", "b-c") for t in ("com", "net", "org") for p in ("en", "es", "de"))]
    urls = ODD + made * 8
    rows = [(k, u, "", "x", 1, "h") for k, u in enumerate(urls)]
    found = {r.page_id: r for r in filter_urls(spark.createDataFrame(rows, SCHEMA).repartition(4), URL_RULES).collect()}
    assert len(found) == len(urls)
    for k, url in enumerate(urls):
        host, path, rule, verdict = plain(url)
        r = found[k]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        if rule:
            assert r.verdict == verdict and r.block_score is None
        else:
            assert r.verdict == ("block" if r.block_score >= 0.5 else "allow")


def test_trees_learn_what_the_rules_mark(spark):
    rules = [("block", "bad.net", "/"), ("allow", "good.net", "/")]
    rows = []
    for k in range(400):
        rows.append((len(rows), f"http://h{k}.bad.net/q{k}{k * 7}?a={k}&b=2&c=3", "", "", 0, ""))
        rows.append((len(rows), f"http://h.good.net/section/story{k % 9}", "", "", 0, ""))
    probes = {10_000: "http://other.org/q881777?a=1&b=2&c=4", 10_001: "http://other.org/section/story"}
    rows += [(i, u, "", "", 0, "") for i, u in probes.items()]
    found = {r.page_id: r.verdict for r in filter_urls(spark.createDataFrame(rows, SCHEMA), rules).collect()}
    assert found[10_000] == "block" and found[10_001] == "allow"


def test_odd_tables(spark):
    assert filter_urls(spark.createDataFrame([], SCHEMA), URL_RULES).collect() == []
    only = [(1, "http://a.com/x", "", "", 0, ""), (1, "http://a.com/x", "", "", 0, ""), (2, None, "", "", 0, "")]
    found = filter_urls(spark.createDataFrame(only, SCHEMA), URL_RULES).collect()
    assert sorted((r.page_id, r.rule, r.verdict) for r in found) == [(1, "com/", "allow"), (1, "com/", "allow"), (2, None, "allow")]
