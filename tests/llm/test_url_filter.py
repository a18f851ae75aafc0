import random

import pytest

from spendguard.llm import url_filter

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host) :].split("#")[0].split("?")[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def judge(url, listed):
    host, path = split(url)
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    if fits:
        best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])))
        return best[0] + best[1], best[2]
    return None, "block" if listed else "allow"


URLS = [
    None, "", "nothing", "://", "http://", "http://a.org", "HTTP://WWW.Example.ORG/es/x?utm_source=a&b=2&a=1#f", "x://com/fr/",
    "http://notcom/fr/", "http://a.com/de/1?ref=x", "http://a.com?q=/de/", "http://a.com#/de/", "a://b://com/de/", "http://ÄB.com/de/",
    "http://spam.net/a/", "https://www.spam.net/a?utm_campaign=z", "http://spam.net/a?x=1", "http://example.org/ES/", "http://.com/fr/x",
]


@pytest.mark.parametrize("max_blocks", [url_filter.MAX_BLOCKS, 1])
def test_against_plain_code(spark, max_blocks):
    rng = random.Random(3)
    urls = URLS + [f"http://h{rng.randint(0, 50)}.net/p{rng.randint(0, 9)}" for _ in range(800)] + ["http://spam.net/a"] * 400
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr(
        "*", "'x' AS listed", "'y' AS canonical", "1 AS _salt", "2 AS host"
    )
    bad = [f"h{i}.net/p3" for i in range(50)] + ["spam.net/a", "spam.net/a", None]
    listed = spark.createDataFrame([(b,) for b in bad], "canonical string")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, RULES, listed, max_blocks=max_blocks).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        host, path = split(url)
        known = url is not None and (host.removeprefix("www.") + path.rstrip("/") in bad) and "x=1" not in url
        assert (got[i].host, got[i].path) == (host, path), url
        assert got[i].listed == known, url
        assert (got[i].rule, got[i].verdict) == judge(url, known), url


def test_equally_long_rules_and_repeated_pages(spark):
    rules = [("b.org", "/x", "block"), ("a.b.org", "", "allow"), ("c.org", "/long", "allow"), ("c.org", "/", "block")]
    urls = [(1, "http://a.b.org/x"), (2, "http://b.org/x"), (1, "http://a.b.org/x"), (3, "http://c.org/longer"), (3, None)]
    pages = spark.createDataFrame(urls * 2, "page_id long, url string")
    listed = spark.createDataFrame([("nothing.net",)], "canonical string")
    got = sorted((r.page_id, r.rule or "", r.verdict) for r in url_filter.judge_urls(pages, rules, listed).collect())
    one = [(1, "a.b.org", "allow")] * 2 + [(2, "b.org/x", "block"), (3, "", "allow"), (3, "c.org/long", "allow")]
    assert got == sorted(one * 2)


def test_pages_are_read_once(spark, tmp_path):
    rows = spark.range(200).selectExpr("id AS page_id", "concat('http://h', id % 7, '.net/', id % 3) AS url", "'long' AS html")
    rows.write.parquet(str(tmp_path / "pages"))
    pages = spark.read.parquet(str(tmp_path / "pages"))
    judged = url_filter.judge_urls(pages, RULES, spark.createDataFrame([("h1.net/1",)], "canonical string"))
    assert "parquet" not in judged._jdf.queryExecution().executedPlan().toString().lower()
    assert judged.where("listed").count() == sum(i % 7 == 1 and i % 3 == 1 for i in range(200))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    listed = spark.createDataFrame([], "canonical string")
    assert url_filter.judge_urls(none, RULES, listed).count() == 0
    one = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge_urls(one, RULES, listed).collect()] == ["allow"]
    assert [r.verdict for r in url_filter.judge_urls(one, [], listed).collect()] == ["allow"]


def test_filter_lets_all_listed_through_and_few_others(spark):
    urls = spark.range(4000).selectExpr("concat('h', id) AS canonical")
    words, blocks = url_filter.bloom(urls, "canonical")
    assert words.count() <= blocks <= url_filter.MAX_BLOCKS
    found = url_filter.is_listed(spark.range(4000, 8000).selectExpr("id", "concat('h', id) AS canonical"), "canonical", urls, "id")
    assert not found.where("listed").count()
