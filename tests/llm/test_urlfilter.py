"""URL filter against a plain search of every term at every place."""

from __future__ import annotations

import random

import pytest

from shardloom.llm import urlfilter as U
from shardloom.llm.queries import op11_url_filter

EDGES = [
    None, "", "://", "http://", "no scheme casino", "HTTP://WWW.Example.NET/en/1", "http://example.net/EN/1", "http://net/", "http://net",
    "http://a.net?x=1", "http://a.net#/", "http://notexample.net/en/", "http://example.net/en/?q=http://example.com/de/", "http://fr.org/fr/",
    "http://org/fr", "x://casino-win.test/", "x://casinos.test/", "x://mycasino.test/", "x://free-bets.test/", "x://free.test/free/free",
    "x://track-ads.test", "x://über-sex.test", "x://übersex-poker.test/", "x://a.test/?sex=poker", "x://a.test:80/porn%20casino", "x://.net/", "x://a..net/",
    "x://a.test/" + "casino-" * 3000, "x://" + "a." * 5000 + "net/", "x://a\n.net/\n", "http://user@example.com/de/",
]


def low(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(url):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = low(rest[:end]), rest[end:]
        end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
        path = rest[:end]
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    text, hits = low(url), {}
    for term in U.VOCABULARY:
        for i in range(len(text)):
            if text.startswith(term, i):
                around = text[i - 1 : i] + text[i + len(term) : i + len(term) + 1]
                if not any(c.isalnum() for c in around):
                    hits[term] = hits.get(term, 0) + 1
    strict = sum(n for t, n in hits.items() if U.VOCABULARY[t] >= U.LIMIT)
    soft = sorted(t for t in hits if U.VOCABULARY[t] < U.LIMIT)
    weight = sum(U.VOCABULARY[t] for t in hits)
    verdict = max(fits)[3] if fits else "block" if strict or weight >= U.LIMIT else "allow"
    return host, path, max(fits)[2] if fits else None, verdict, strict, soft, weight


def test_urls_equal_brute_force(spark):
    rng = random.Random(1)
    parts = ["casino", "win", "free", "bets", "sexy", "ads", "a", "-", ".", "/", "example", "net", "com", "org", "/en/", "/de/", "/fr/", "?", "#", "://", "Ads"]
    urls = EDGES + ["http://" + "".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(800)]
    rows = [(i // 2, u, "x", u, i) for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, Host string, `a.b` string, i int")
    out = U.judge_urls(pages)
    assert out.columns == ["page_id", "url", "a.b", "i", "host", "path", "rule", "verdict", "strict_hits", "soft_terms", "weight"]
    got = {r["i"]: (r["url"], tuple(r[4:])) for r in out.collect()}
    for i, u in enumerate(urls):
        if u is not None and len(u) > 10_000:
            continue
        assert got[i] == (u, brute(u)), u
    long = got[EDGES.index("x://a.test/" + "casino-" * 3000)][1]
    assert long[4] == 3000 and long[6] == 4
    assert got[EDGES.index("x://" + "a." * 5000 + "net/")][1][2] == "net/"


def test_one_strict_or_several_soft_terms(spark):
    urls = ["x://casino.a", "x://free.a", "x://free.a/free", "x://free-bets.a", "x://track.a/ads", "x://windows.a", None]
    out = U.judge_urls(spark.createDataFrame([(u,) for u in urls], "url string")).select("verdict").collect()
    assert [r[0] for r in out] == ["block", "allow", "allow", "block", "block", "allow", "allow"]


def test_parameters_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    got = U.judge_urls(pages, rules=[("block", "B", "/"), ("allow", "b", "/c")], vocabulary={}).first()
    assert (got["rule"], got["verdict"], got["weight"]) == ("b/c", "allow", 0)
    with pytest.raises(ValueError):
        U.judge_urls(pages, rules=[("block", "b", "/"), ("allow", "B", "/")])
    with pytest.raises(ValueError):
        U.judge_urls(pages, vocabulary={"": 1})
    assert U.judge_urls(pages.limit(0)).count() == 0


def test_query_on_given_table(spark):
    rows = op11_url_filter(spark, "/root/testdata/sf0.01").collect()
    assert {r["rule"] for r in rows} >= {"net/", "example.net/en/", "example.com/de/", "org/fr/", None}
