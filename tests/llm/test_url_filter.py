import time

from topicflow.llm import url_filter

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "Example.com", "/de/x"), ("allow", "org", "/fr/")]
URLS = [
    (1, "http://a.example.net/en/1?x=1"), (2, "https://EXAMPLE.net/EN/1"), (3, "http://example.com/de/xyz#y"),
    (4, "http://notexample.com/de/xyz"), (5, "http://b.org/fr"), (6, "http://b.org/fr/"), (7, None), (8, "no scheme"),
    (9, "x://net"), (10, "http://net/"), (None, "http://c.net/"), (10, "http://net/"), (11, "http://a.b://c.net/"),
    (12, "http://é.net/é"), (13, ""), (14, "http://x.example.com/de/" + "y" * 50_000), (15, "http://q.net?/en/"),
    (16, "http://..net./"), (17, "HTTP://user@w.example.net:80/en/"),
]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [
        (len(h + p), h + p, v)
        for v, h, p in [(v, h.lower(), p) for v, h, p in RULES]
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_like_trying_every_rule(spark):
    pages = spark.createDataFrame([(i, u, "h", "p", "k") for i, u in URLS], "page_id int, url string, host string, path string, key string")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    found = sorted(map(tuple, url_filter.judge(pages, rules).collect()), key=str)
    assert found == sorted(((i, *brute(u)) for i, u in URLS), key=str)


def test_without_rules_or_pages(spark):
    pages = spark.createDataFrame(URLS, "page_id int, url string")
    rules = spark.createDataFrame([], "verdict string, host string, path string")
    assert {(r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect()} == {(None, "allow")}
    some = spark.createDataFrame([*RULES, ("block", None, "/"), (None, "a", "/")], "verdict string, host string, path string")
    assert url_filter.judge(pages.limit(0), some).collect() == []


def test_very_long_hosts_and_paths(spark):
    """A url of a megabyte costs no more than its length for each number of labels and length of path among the rules."""
    hosts = ["a." * 250_000 + "example.net", "." * 300_000 + "net", "b." * 100_000 + "org"]
    urls = [(i, f"http://{host}/{'en/' * 150_000}?x") for i, host in enumerate(hosts)]
    pages = spark.createDataFrame(urls, "page_id int, url string")
    rules = spark.createDataFrame([*RULES, ("block", "a.a.a.a.example.net", "/en/en/"), ("block", "", "/")], "verdict string, host string, path string")
    began = time.time()
    found = sorted((r.page_id, r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect())
    assert time.time() - began < 60
    assert found == [(0, "a.a.a.a.example.net/en/en/", "block"), (1, "net/", "block"), (2, None, "allow")]
