"""URL rules by index, by join and by trying every rule."""

import random
import re

import pytest

from thumbwheel.llm import urls
from thumbwheel.llm.queries import DOMAIN_RULES, URL_PATTERNS
from thumbwheel.llm.urls import UrlConfig, UrlRule, domain_rule, filter_urls

RULES = [*DOMAIN_RULES, *URL_PATTERNS]
SCHEMA = "page_id long, url string, verdict string, host int"


def plain(url):
    """The contract's rules by hand; then every pattern, the longest first."""
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0] if rest[len(host) : len(host) + 1] == "/" else ""
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = []
    for name, action in (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")):
        domain, _, start = name.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
            fits.append((len(name), name, action))
    return host, path, (max(fits)[1:] if fits else (None, None))


EDGES = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "http://a.net?x=/", "HTTPS://WWW.Example.NET/en/1",
    "http://example.net/EN/", "http://myexample.com/de/x", "http://example.com/de", "http://x.org/fr/#a", "http://org/fr/?q",
    "http://b.example.com:80/de/", "ftp://a.b://c.net/", "http://e.net/\n/en/", "http://é.net/en/", "http://u@x.net/",
    "http://x.com?u=http://y.example.net/en/", "http://q#.net/", "http://x.com/ads/1", "http://adult-x.com/", "http://x.com/login",
    "http://x.com/login/", "http://x.com/logins", "http://x.com/wiki/login", "http://x.com/a.exe", "http://x.com/a.exe\n",
    "http://x.com/search?lang=en&q=1", "http://archive.x.com/search?q=1", "http://x.com/tag/a/b/page/2", "http://x.com/?sessionid=3",
    "http://.net/", "http://..net/a", "http://Xnet/", "http://" + "a" * 50_000 + ".net/",
]


def random_urls(n):
    rng = random.Random(4)
    part = lambda xs: rng.choice(xs)
    return [
        "http://" + part(["", "www.", "ads.", "x.casino.", "adult-b."]) + part(["example", "ads", "net", "tag"]) + part([".net", ".com", ".org"])
        + part(["/en/", "/de/", "/fr/", "/ads/", "/login", "/tag/x/", "?q", ""]) + part(["page/1", "a.exe", "search?x=1&q=2", "", "#a"])
        for _ in range(n)
    ]


@pytest.fixture(scope="module")
def table(spark):
    every = EDGES + random_urls(300)
    rows = [(i, u, "v", 1) for i, u in enumerate(every)] + [(0, EDGES[7], "v", 1), (None, "http://net/", "v", 1)]
    return spark.createDataFrame(rows, SCHEMA)


def test_rules_by_hand(spark, table):
    source = sorted(((r.page_id, r.url) for r in table.collect()), key=str)
    got = sorted(((r.page_id, r) for r in filter_urls(spark, table, RULES).collect()), key=str)
    assert len(got) == len(source)
    by_id = {}
    for page_id, r in got:
        by_id.setdefault(page_id, []).append(r)
    for page_id, url in source:
        host, path, (rule, action) = plain(url)
        target = host + path + ("?" + re.split("[#]", url.split("?", 1)[1])[0] if url and "?" in url and "://" in url and "#" not in url.split("?")[0] else "")
        fits = [r for r in URL_PATTERNS if re.search(r.regex, target)]
        best = max(fits, key=lambda r: (len(r.pattern), r.action == "block", r.pattern)) if fits and rule is None else None
        want = (host, path, rule, best and best.pattern, action or (best.action if best else "allow"))
        assert want in [(r.host, r.path, r.rule, r.pattern, r.verdict) for r in by_id[page_id]], url


def test_index_and_join_agree(spark, table):
    one = filter_urls(spark, table, RULES)
    other = filter_urls(spark, table, RULES, cfg=UrlConfig(broadcast_bytes=0))
    assert sorted(one.collect(), key=str) == sorted(other.collect(), key=str)


def test_rules_lie_under_a_token_that_every_fitting_url_has(table):
    counts = {"example": 5, "net": 9, "en": 1}
    assert urls.filed_rules([DOMAIN_RULES[1]], counts)[0][0] == "en"
    assert UrlRule("*sessionid=", "block").tokens == [] and UrlRule("/login^", "block").tokens == ["login"]
    assert UrlRule("/log", "block").tokens == [] and UrlRule("||a.b*c/d/", "block").tokens == ["a", "d"]
    for rule in RULES:
        for (url,) in table.select("url").collect():
            host, path, query = urls.split_url(url)
            if re.search(rule.regex, host + path + query):
                assert set(rule.tokens) <= urls.url_tokens(host + path + query)


def test_no_rules_and_no_rows(spark, table):
    assert {r.verdict for r in filter_urls(spark, table, []).collect()} == {"allow"}
    assert filter_urls(spark, table.limit(0), RULES).count() == 0
    with pytest.raises(ValueError):
        domain_rule("block", "a*b")
