from datetime import datetime

import pytest

from tests.parity import differences, duck
from tidemark.llm import shingles, url_filters
from tidemark.llm.queries import STATEMENTS, op2_url_filter

EVENT = "list_id string, kind string, pattern string, verdict string, action string, at timestamp"
CAPTURE = "capture_id long, url string, fetched_at timestamp"


def day(n):
    return datetime(2024, 1 + n // 28, 1 + n % 28)


def verdicts(spark, captures, events, **more):
    c, e = spark.createDataFrame([(i, u, None if d is None else day(d)) for i, u, d in captures], CAPTURE), spark.createDataFrame(events, EVENT)
    return {r.capture_id: (r.verdict, r.list_id, r.pattern) for r in url_filters.decide(c, e, **more).collect()}


@pytest.mark.parametrize("limit", [shingles.BROADCAST_ROWS, 0])
@pytest.mark.parametrize("days", [1, 30])
def test_entries_active_at_fetch_time(spark, monkeypatch, limit, days):
    monkeypatch.setattr(shingles, "BROADCAST_ROWS", limit)
    events = [
        ("l", "domain", "Bad.org", "block", "add", day(10)), ("l", "domain", "bad.org", "block", "add", day(12)), ("l", "domain", "bad.org", "block", "remove", day(20)),
        ("l", "domain", "bad.org", "block", "remove", day(21)), ("l", "domain", "bad.org", "block", "add", day(30)), ("l", "domain", "bad.org", "block", "remove", day(30)),
        ("m", "prefix", "bad.org/Ok/", "allow", "add", day(11)), ("m", "domain", "www.bad.org", "allow", "add", day(0)), ("m", "domain", "org", "block", "add", day(200)),
        ("k", "domain", "tie.net", "block", "add", day(1)), ("k", "domain", "tie.net", "allow", "add", day(2)), ("a", "domain", "tie.net", "block", "add", day(1)),
        ("l", "domain", None, "block", "add", day(1)), ("l", "domain", "x.y", "block", None, day(1)), ("l", "domain", "x.y", "block", "add", None),
    ]
    captures = [
        (1, "http://bad.org", 9), (2, "http://bad.org", 10), (3, "https://a.b.BAD.org:80/x?q", 19), (4, "http://bad.org/", 20), (5, "http://bad.org", 31),
        (6, "http://bad.org/Ok/page", 15), (7, "http://bad.org/ok/page", 15), (8, "http://bad.org/Ok", 15), (9, "http://u:p@www.bad.org./", 15),
        (10, "http://notbad.org/", 15), (11, "http://tie.net/", 1), (12, "http://tie.net/", 2), (13, None, 15), (14, "no url", 15), (15, "http://bad.org", None),
        (16, "http://" + "a." * 200 + "bad.org/", 15), (17, "http://x.y/", 5),
    ]
    b, n = ("block", "l", "bad.org"), ("none", None, None)
    assert verdicts(spark, captures, events, bucket_days=days) == {
        1: n, 2: b, 3: b, 4: n, 5: b, 6: ("allow", "m", "bad.org/Ok/"), 7: b, 8: b, 9: ("allow", "m", "www.bad.org"), 10: n,
        11: ("block", "a", "tie.net"), 12: ("allow", "k", "tie.net"), 13: n, 14: n, 15: n, 16: b, 17: n,
    }


def test_empty_tables_repeats_and_extra_columns(spark):
    c = spark.createDataFrame([(1, "http://a.b/", day(1), "x"), (1, "http://a.b/", day(1), "x"), (None, "http://a.b/", day(1), "x")], CAPTURE + ", verdict string")
    e = spark.createDataFrame([("l", "domain", "a.b", "block", "add", day(0))] * 2, EVENT)
    assert sorted((str(r.capture_id), r.verdict) for r in url_filters.decide(c, e).collect()) == [("1", "block"), ("None", "block")]
    assert {r.verdict for r in url_filters.decide(c, e.limit(0)).collect()} == {"none"}
    assert url_filters.decide(c.limit(0), e).count() == 0
    only_paths = spark.createDataFrame([("l", "prefix", "a.b/", "block", "add", day(0))], EVENT)
    assert {r.verdict for r in url_filters.decide(c, only_paths).collect()} == {"block"}


def test_hosts_of_any_length_and_no_needless_keys(spark):
    events = [("l", "domain", "evil.com", "block", "add", day(0)), ("l", "domain", "a.b.c.d", "block", "add", day(0))]
    captures = [(n, f"http://{'a.' * n}evil.com/x", 5) for n in (0, 2, 122, 130, 3000)]
    assert set(verdicts(spark, captures, events).values()) == {("block", "l", "evil.com")}
    c = spark.createDataFrame([(1, "http://x.y.z.evil.com/", day(5)), (2, "", day(5)), (3, "http://org/", day(5))], CAPTURE)
    found = url_filters.decide(c, spark.createDataFrame(events, EVENT))
    keys = c.select("capture_id", url_filters.host(c.url).alias("host"), url_filters.path(c.url).alias("path")).select(url_filters._keys([2, 4], []).alias("k"))
    assert sorted(len(r.k) for r in keys.collect()) == [0, 0, 2]  # of two and of four labels, no top-level domain
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "LeftOuter" not in plan


def test_query_equals_its_statement(spark, sf_dir):
    got = op2_url_filter(spark, sf_dir).toPandas()
    assert set(got.verdict) == {"none", "block", "allow"}
    assert not differences(got, duck(sf_dir).execute(STATEMENTS["op2_url_filter"]).df())


@pytest.mark.parametrize("limit", [shingles.BROADCAST_ROWS, 0])
def test_prefixes_end_anywhere(spark, monkeypatch, limit):
    monkeypatch.setattr(shingles, "BROADCAST_ROWS", limit)
    patterns = ["example.com/ads", "Shop.net", "a.b/c/d", "a.b/c/de", "é.org/ü"]
    urls = [
        "http://example.com/ads", "http://example.com/ads/1", "http://example.com/ads.js?x", "http://example.com/ad", "http://www.example.com/ads", "http://example.com/Ads",
        "http://shop.net", "http://SHOP.net/x", "http://shop.network/", "http://a.b/c/d", "http://a.b/c/def/g", "http://a.b/c/", "http://é.org/über", "http://example.com",
    ]
    strings = [url_filters_plain(u) for u in urls]
    want = {i: max((p for p in map(str.lower, patterns) if s.startswith(p)), key=len, default=None) for i, s in enumerate(strings)}
    got = verdicts(spark, [(i, u, 5) for i, u in enumerate(urls)], [("l", "prefix", p, "block", "add", day(1)) for p in patterns])
    assert {i: p for i, (_, _, p) in got.items()} == want and sum(p is not None for p in want.values()) == 9


def url_filters_plain(url):
    host, _, path = url.removeprefix("http://").partition("/")
    return f"{host.lower()}/{path.partition('?')[0]}"
