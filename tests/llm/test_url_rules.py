from pyspark.sql import functions as F

from bazaarlake.llm import url_rules
from bazaarlake.llm.url_rules import Rule

URLS = [
    "http://a.example.org/es/x", "http://example.org/es/x", "https://EXAMPLE.ORG/en/12?q#f", "http://example.org", "http://org/", "http://org?x=/",
    "http://notexample.org/es/", "http://x.com/fr/1", "http://x.com/de/1", "http://x.com/DE/1", "ftp://com/de/", "no scheme/de/", "", None,
    "http://adult-x.example.com/fr/440.html", "http://adult-x.example.com/en/1", "http://user@x.com:80/de/", "http://x.com:80/de/?u=http://y.org/es/",
    "http://éa.org/é", "x://", "http:///path/only", "http://a.net/ads/1", "http://a.net/p/ads/1", "http://a.net/pads/1", "http://x.com/de/\nline",
    "http://free-bets.example.net/", "http://xfree-bets.example.net/", "://a.org/", "http://x.com#/de/",
]


def test_rows_equal_sql(spark, sql):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(1, URLS[1]), (None, URLS[0])] + [(100 + i, URLS[0]) for i in range(50)]
    rows.append((999, "http://" + "a." * 20000 + "org/" + "x" * 50000))
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
    got = url_rules.judge(pages)
    names, want = sql(url_rules.SQL, pages=pages.drop("host"))
    assert sorted(map(tuple, got.select(names).collect()), key=str) == sorted(want, key=str)


def judged(spark, url, rules):
    r = url_rules.judge(spark.createDataFrame([(1, url)], "page_id long, url string"), rules).first()
    return r.host, r.path, r.rule, r.pattern_rule, r.verdict


def test_contract_cases(spark):
    rules = url_rules.SITE_RULES
    assert judged(spark, "http://a.Example.org/es/x?y", rules) == ("a.example.org", "/es/x", "example.org/es/", None, "block")
    assert judged(spark, "http://example.org/en/1", rules)[2:] == ("example.org/en/1", None, "block")
    assert judged(spark, "http://example.org/en/2", rules)[2:] == ("org/", None, "allow")
    assert judged(spark, "http://example.org", rules) == ("example.org", "", None, None, "allow")


def test_index_takes_the_rarest_token(spark):
    rules = [Rule("example.org/rare/", "block"), Rule("*/x*", "block"), Rule("none.of.these/", "block")]
    urls = spark.createDataFrame([(["example", "org"],), (["example"],), (["rare", "example", "org"],)], "tokens array<string>")
    index = {r.pattern: r.token for r in url_rules.index_rules(urls, rules).collect()}
    assert index == {"example.org/rare/": "rare", "*/x*": "", "none.of.these/": "none"}
    assert url_rules.literal_tokens("adult-*.Example.com/p/open") == ["adult", "com", "example", "p"]


def test_empty_table(spark):
    assert url_rules.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_many_urls_without_a_host(spark):
    rows = [(i, None if i % 3 == 0 else f"http://h{i % 7}.example.org/es/{i % 11}") for i in range(3000)]
    got = url_rules.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert sorted(r.page_id for r in got) == list(range(3000))
    assert all((r.host, r.path, r.rule) == ("", "", None) for r in got if r.page_id % 3 == 0)
    assert all(r.verdict == "block" and r.rule == "example.org/es/" for r in got if r.page_id % 3)
