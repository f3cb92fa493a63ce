from __future__ import annotations

import random

from eventloom.llm import url_rules

RULES = "host string, path string, verdict string"
PAGES = "page_id long, url string, key string, cell string, verdict string"


def verdicts(spark, urls, rules, **more):
    pages = spark.createDataFrame([(i, u, "", "", "") for i, u in enumerate(urls)], PAGES)
    judged = url_rules.judge(pages, spark.createDataFrame(rules, RULES), **more).collect()
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged}


def expected(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")
    ]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def test_odd_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?y#z", "http://example.net/en", "x://y://z/q",
        "http://notexample.net/", "http://example.net?/en/", "http://net/", "http://É.org/fr/", "http://a..net/", "http://b.net/#",
    ]
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("org", "/fr/", "allow")]
    got = verdicts(spark, urls, rules)
    assert got == {i: expected(u, rules) for i, u in enumerate(urls)}


def test_nested_rules_against_brute_force(spark):
    rng = random.Random(3)
    labels, paths = ["a", "b", "c", "d"], ["/", "/x", "/x/", "/x/y", "/z/", ""]
    host = lambda n: ".".join(rng.choice(labels) for _ in range(rng.randint(1, n)))
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in ((host(3), rng.choice(paths)) for _ in range(60))}.values())
    urls = [f"http://{host(5)}{rng.choice(paths)}{rng.choice(['', 'q', '/y'])}" for _ in range(3000)] + ["http://a.a/x"] * 3000
    got = verdicts(spark, urls, rules, default="block")
    assert got == {i: expected(u, rules, "block") for i, u in enumerate(urls)}


def test_empty_tables_nulls_and_equal_rules(spark):
    assert verdicts(spark, [], [("a", "/", "block")]) == {}
    assert verdicts(spark, ["http://a/"], []) == {0: ("a", "/", None, "allow")}
    rules = [("a", "/", "allow"), ("a", "/", "block"), (None, "/", "block"), ("", "/", "block"), ("b", None, "block")]
    got = verdicts(spark, ["http://a/", "http://b/q", None], rules)
    assert [got[i][2:] for i in range(3)] == [("a/", "block"), ("b", "block"), (None, "allow")]


def test_null_and_large_page_ids_survive(spark):
    pages = spark.createDataFrame([(None, "http://a.net/"), (2**60 + 1, "http://a.net/")], "page_id long, url string")
    rules = spark.createDataFrame([("net", "/", "block")], RULES)
    assert {r.page_id for r in url_rules.judge(pages, rules).collect()} == {None, 2**60 + 1}
