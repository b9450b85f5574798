import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tributary.llm.urls import RULE_COLUMNS, judge_urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("example.com", "/de/a", "allow"), ("b.example.com", "/", "block"), ("b.example.com", "", "allow")]


def brute(url, rules, default="allow"):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), h.count("."), h + p, v) for h, p, v in rules
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


URLS = ["http://x.example.net/en/5", "https://EXAMPLE.net/de?x#y", "http://example.net", "http://a.b.example.com/de/abc#t",
        "http://b.example.com", "http://notexample.com/de/", "ftp://org/fr/x", "no scheme/net/", None, "", "://", "http://net/",
        "http://x.net/" + "p/" * 5000, "http://" + "a." * 3000 + "net/q", "http://example.com/de/ü\n", "http://.net/", "a://b://net/"]


def got(spark, urls, rules, **kw):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string").repartition(3)
    table = spark.createDataFrame(rules, RULE_COLUMNS)
    rows = judge_urls(pages, table, keep=("page_id",), **kw).collect()
    return [tuple(r)[1:] for r in sorted(rows, key=lambda r: r.page_id)]


@pytest.mark.parametrize("sweep_keys", [1_000_000, 3])
def test_against_brute_force(spark, sweep_keys):
    assert got(spark, URLS, RULES, sweep_keys=sweep_keys) == [brute(u, RULES) for u in URLS]


def test_no_rules_no_pages_and_another_default(spark):
    assert got(spark, URLS, [], default="block") == [brute(u, [], "block") for u in URLS]
    assert got(spark, [], RULES) == []


def test_contradicting_and_incomplete_rules(spark):
    rules = [("net", "/", "allow"), ("net", "/", "block"), ("", "/", "block"), (None, "/", "block"), ("org", None, "block"), ("com", "/", None)]
    assert [r[3] for r in got(spark, ["http://a.net/", "http://a.org", "http://a.com/"], rules)] == ["block", "block", "allow"]


def test_repeated_rows_and_clashing_names(spark):
    pages = spark.createDataFrame([(1, "http://a.net/", "x", "y")] * 3 + [(None, None, None, None)],
                                  "page_id bigint, url string, host string, sweep string")
    rows = judge_urls(pages, spark.createDataFrame(RULES, RULE_COLUMNS), keep=("page_id", "sweep")).collect()
    assert sorted((tuple(r) for r in rows), key=repr) == sorted(
        [(1, "y", "a.net", "/", "net/", "block")] * 3 + [(None, None, "", "", None, "allow")], key=repr)


hosts = st.lists(st.sampled_from(["a", "b", "net", "com"]), min_size=1, max_size=4).map(".".join)
paths = st.lists(st.sampled_from(["/", "a", "b", "/a"]), max_size=4).map("".join)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(hosts, paths, st.sampled_from(["allow", "block"])), max_size=12), st.lists(st.tuples(hosts, paths), max_size=12))
def test_nested_rules(spark, rules, urls):
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    made = [f"http://{h}{p if p.startswith('/') else ''}" for h, p in urls]
    assert got(spark, made, rules) == [brute(u, rules) for u in made]


def test_a_rule_goes_to_the_sweeps_of_its_host_only(spark):
    """100,000 rules and a hot host: rows for rules stay near the rules that urls can meet."""
    from pyspark.sql import functions as F

    from tributary.llm import urls as U

    rules = spark.range(100_000).select(F.concat(F.lit("h"), F.col("id"), F.lit(".net")).alias("host"), F.lit("/a").alias("path"),
                                        F.lit("block").alias("verdict"))
    hot = spark.createDataFrame([("net", "/a/b", "allow"), ("net", "/", "allow")], RULE_COLUMNS)
    rules = rules.unionByName(hot).cache()
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(
        F.lit("http://"), F.when(F.col("id") % 3 == 0, "x").otherwise(F.concat(F.lit("h"), F.col("id") * 50)), F.lit(".net/a/b")).alias("url"))
    out = judge_urls(pages, rules, keep=("page_id",), sweep_keys=100)
    got = {(r.verdict, r.rule is not None and r.rule.startswith("h")): r["count"] for r in
           out.groupBy("verdict", "rule").count().collect()}
    assert out.count() == 3000
    want = sum(1 for i in range(3000) if i % 3 and i * 50 < 100_000)
    assert out.where("verdict = 'block'").count() == want and ("block", True) in got
    points = pages.select(F.explode(F.array(F.lit("net"), F.concat(F.lit("net."), F.regexp_extract("url", "//(.*?)\\.", 1)))).alias("key_host"))
    sizes = U._sweep_sizes(points, rules, 100).cache()
    assert {r.sweeps for r in sizes.where("key_host = 'net'").collect()} == {30}
    assert U._marks(rules, sizes).count() == 2 * (2 * 30 + want)
