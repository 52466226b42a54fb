import re

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import url_filter as u
from ledgerline.llm.queries import QUERIES, URL_RULES


def split(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0] if rest[len(host) :].startswith("/") else ""
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    best = None
    for rule, verdict in URL_RULES:
        h, p = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return best or (None, None)


URLS = [
    "http://www.Example.COM/en/a", "https://example.com/en/", "http://a.www.example.com/en/x?y=1", "http://example.com/EN/", "http://x.net/es/1#a",
    "http://net/fr/", "http://notnet/fr/", "http://com", "http://com?x/", "http://com#/", "//none", "", None, "http://", "x://h.net/fr", "ftp://a://b.com/en/",
    "http://É.example.com/en/ünï", "http://a.com/" + "p" * 50_000, "http://examplexcom/en/", "http://example.com\n.net/es/",
]


@pytest.fixture(scope="module")
def model(spark):
    return u.fit(u.labelled_urls(spark))


def test_rules_and_parts(spark, model):
    df = spark.createDataFrame([(i, x, 1, "v", "r") for i, x in enumerate(URLS * 2)], "page_id long, url string, host int, verdict string, rule string")
    found = u.filter_urls(df, URL_RULES, model).collect()
    assert len(found) == 2 * len(URLS)
    for r in found:
        url = URLS[r.page_id % len(URLS)]
        host, path = split(url)
        rule, verdict = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.p_block >= u.THRESHOLD else "allow"))
    assert u.filter_urls(df.limit(0), URL_RULES, model).count() == 0
    assert u.filter_urls(df, [], model).filter("rule IS NOT NULL").count() == 0


def test_urls_that_were_not_trained_on(spark, model):
    bad = ["m.casino-royal.test", "cheap-pills24.test", "spam-farm7.test", "www.adult-xx.test", "ads-track3.test", "free-bets9.test"]
    good = ["www.gallery.test", "blog.village.test", "thenorth.test", "m.statute.test", "news-today.test", "www.botany.test", "ththan.test"]
    df = spark.createDataFrame([(h, "/en/12") for h in bad + good], "host string, path string")
    p = {r.host: r.p for r in df.select("host", u.probability(F.col("host"), F.col("path"), model).alias("p")).collect()}
    assert all(p[h] > 0.5 for h in bad) and all(p[h] < u.THRESHOLD for h in good)
    assert sum(p[h] >= u.THRESHOLD for h in bad) >= 5


def test_fit_limits(spark, model):
    assert u.fit(u.labelled_urls(spark).limit(0)) == (0.0, [0.0] * u.BUCKETS)
    with pytest.raises(ValueError):
        u.fit(spark.range(u.MAX_LABELLED + 1).selectExpr("'h' AS host", "'p' AS path", "1 AS label"))


def test_query_runs_without_python_or_shuffle_of_pages(spark, folder):
    df = QUERIES["op6_url_filter"](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Pandas", plan)
    for r in df.join(spark.read.parquet(f"{folder}/pages.parquet"), "page_id").collect():
        assert (r.host, r.path) == split(r.url) and r.rule == rule_of(r.host, r.path)[0]
        assert r.verdict == (rule_of(r.host, r.path)[1] or ("block" if r.p_block >= u.THRESHOLD else "allow"))
