"""URL filter against a plain version, over odd rows and a filter that is full."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.llm import urls
from lumenframe.llm.queries import ORACLE, QUERIES, URL_RULES
from tests.compare import differences

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, host string, path string, key string, found boolean, rule string, h long"


def addresses():
    odd = [
        None, "", "no scheme.com/x", "://", "http://", "http:///only/path", "HTTP://EXAMPLE.COM/EN/x", "http://example.com/en/", "http://example.com/en",
        "http://www.example.com/en/1?a=1#x", "http://sub.www.example.com/en/1", "http://badexample.com/en/1", "http://com", "http://com/", "http://a.com?x=/",
        "http://x.net/es/1", "http://net/fr/", "http://net/de/", "http://é.net/és/", "https://u:p@spam.org:443/a/index.html?utm_source=x&b=2&a=1#f",
        "ftp://spam.org/a?a=1&b=2&ref=q", "http://spam.org./a/?b=2&a=1", "http://www.spam.org/a?a=1", "http://spam.org/a?A=1&b=2", "http://a://b/c",
        "http://long.org/" + "x" * 50_000, "http://q.org/?&&", "http://q.org", "http://q.org/index.htm?ref=1", "http://ÀB.org/ü?ö",
    ]
    many = [f"http://h{i % 7}.site{i % 3}.org/p/{i}" for i in range(300)]
    return odd + many + ["http://same.org/x"] * 40 + odd[:5]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest).group()
    tail = rest[len(host) :]
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    path = re.match("[^?#]*", tail).group()
    query = tail[len(path) :].split("#")[0][1:] if tail[len(path) :].startswith("?") else ""
    short = host.split("@", 1)[1] if "@" in host else host
    for pattern in (":(80|443)?$", "[.]$", "^www[.]"):
        short = re.sub(pattern, "", short)
    kept = sorted(p for p in query.split("&") if p and not re.match(urls.TRACKING, p))
    canonical = short + re.sub("/(index[.]html?)?$", "", path) + ("?" + "&".join(kept) if kept else "")
    return host, path, canonical if short else None


def plain_rule(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


LISTED = ["https://spam.org/a?b=2&a=1", "http://same.org/x", "http://h3.site1.org/p/10", "http://q.org/#top", "http://a.com/nothing", "http://net/fr/", None, "bad", "http://spam.org/a?a=1&b=2"]


@pytest.mark.parametrize("filter_bytes", [urls.FILTER_BYTES, 64])
def test_urls(spark, filter_bytes):
    given = [(i if i % 11 else None, u) for i, u in enumerate(addresses())]
    pages = spark.createDataFrame([(*g, "<p>", "h", "p", "k", True, "r", 7) for g in given], SCHEMA).repartition(3)
    more = [*LISTED, *[f"http://other.org/{i}" for i in range(2000)]]  # 64 bytes of filter are full then
    listed = spark.createDataFrame([(u, 1) for u in more], "url string, key int").repartition(2)
    known = {plain_parts(u)[2] for u in more} - {None}
    wanted = []
    for i, u in given:
        host, path, canonical = plain_parts(u)
        rule = plain_rule(host, path)
        hit = rule is None and canonical in known
        wanted.append((i, u, host, path, canonical, rule and rule.name, hit, rule.verdict if rule else "block" if hit else "allow"))
    got = urls.judge(pages, URL_RULES, listed, filter_bytes=filter_bytes)
    assert got.columns == ["page_id", "url", "host", "path", "canonical", "rule", "listed", "verdict"]
    assert Counter(map(tuple, got.collect())) == Counter(wanted)
    assert sum(w[6] for w in wanted) > 40
    kept = urls.allowed_pages(pages, URL_RULES, listed)
    assert kept.columns == pages.columns
    assert Counter(r["url"] for r in kept.collect()) == Counter(w[1] for w in wanted if w[7] == "allow")


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(5000).select(F.concat(F.lit("site.org/"), F.col("id").cast("string")).alias("key"))
    blocks = urls.build_filter(keys)
    inside = np.array([r[0] for r in keys.select(F.xxhash64("key")).collect()])
    outside = np.array([r[0] for r in spark.range(20_000).select(F.xxhash64(F.concat(F.lit("other/"), F.col("id").cast("string")))).collect()])
    assert urls.may_hold(blocks, inside).all()
    assert urls.may_hold(blocks, outside).mean() < 0.01


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    none = pages.limit(0)
    assert urls.judge(none, URL_RULES, pages.select("url")).count() == 0
    assert [r["verdict"] for r in urls.judge(pages, URL_RULES, none.select("url")).collect()] == ["allow"]
    assert [r["verdict"] for r in urls.judge(pages, [], pages.select("url")).collect()] == ["block"]


def test_query(spark):
    assert differences(spark, SF_DIR, QUERIES["op11_url_filters"], ORACLE["op11_url_filters"]) is None
