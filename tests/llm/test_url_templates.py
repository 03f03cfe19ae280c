"""URL verdicts: parts, rules and templates, against SQL and plain Python."""

import re

import pytest
from pyspark.sql import functions as F

from lendspark.llm import url_templates
from lendspark.llm.common import table
from tests.oracle import connect, differences

URLS = [
    None, "", "no scheme/en/1", "://", "http://", "HTTP://Example.ORG/ES/1", "http://EXAMPLE.org/es/1", "http://example.org",
    "http://example.org?x=/es/", "http://example.org#/es/", "http://a.b.example.org/en/1", "http://example.org/en/12?q#f",
    "http://example.org/en/2", "http://badexample.org/es/", "http://example.com/de/x", "http://org/", "http://xorg/",
    "http://com/fr/", "x://y://org/fr/", "http://ÄÖ.example.org/es/ü", "http://example.org:80/es/", "http://u@example.org/es/",
    "http://h.net/" + "/".join("abcdefghij"), "http://h.net//", "http://h.net/a\nb/c\nd?e\nf", "http://h.net/*/{n}/7",
]


def plain(url):
    """Host, path, rule and verdict of the rule by the contract's words."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url[url.index("://") + 3 :]
        host, rest = re.match(r"([^/?#]*)(.*)", rest, re.S).groups()
        path = re.match(r"([^?#]*)", rest, re.S).group(1)
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [
        (h + p, v) for h, p, v in url_templates.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *max(fits, key=lambda f: len(f[0]), default=(None, None)))


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def test_parts_and_rules(spark):
    df = pages(spark, URLS + URLS[:7]).withColumn("host", F.lit("x")).withColumn("s1", F.lit(1)).withColumn("n", F.lit("y"))
    rows = {r["page_id"]: r for r in url_templates.judge_urls(df).collect()}
    assert len(rows) == len(URLS) + 7
    for i, url in enumerate(URLS + URLS[:7]):
        host, path, rule, verdict = plain(url)
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"]) == (host, path, rule), url
        assert rows[i]["verdict"] == (verdict or "allow"), url


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_tables_against_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    found = url_templates.op13_url_templates(spark, folder)
    assert differences(found, connect(folder), url_templates.OP13_SQL) == []
    for r in table(spark, folder, "pages").select("url").limit(50).collect():
        assert plain(r["url"])[0]


def _labelled(spark):
    """A shop whose offers are labelled bad and a forum that is good, each with unlabelled pages."""
    rows = []
    for i in range(60):
        known = None if i % 3 == 0 else 1
        rows.append((f"http://shop.net/offers/item-{i}.html", known))
        rows.append((f"http://shop.net/help/topic-{'abcdefghij'[i % 10]}{'klmnop'[i % 6]}/x", None if i % 3 else 0))
        rows.append((f"http://forum.net/t/{i * 7}/", None if i % 2 else 0))
    rows += [("http://other.net/offers/item-3.html", None), (None, None), (None, 1), ("http://shop.net", None)]
    data = [(i, u, k) for i, (u, k) in enumerate(rows)]
    return spark.createDataFrame(data, "page_id long, url string, known int")


def test_templates_reject_by_purity(spark):
    got = url_templates.judge_urls(_labelled(spark), label=F.col("known")).collect()
    offers = {r["verdict"] for r in got if r["host"] == "shop.net" and r["path"].startswith("/offers/")}
    rest = {r["verdict"] for r in got if not (r["host"] == "shop.net" and r["path"].startswith("/offers/"))}
    assert offers == {"block"} and rest == {"allow"}
    shown = {r["template"] for r in got if r["host"] == "shop.net"}
    # Digits become a wildcard, rare topics another; the two branches differ and stay apart.
    assert "/offers/item-{n}.html" in shown and "/help/*/x" in shown


def test_similar_branches_merge(spark):
    rows = [(f"http://h.net/{'abcdef'[i % 6]}/{i}", i // 6 % 2) for i in range(240)]
    rows += [(f"http://h.net/z/{i}", 1) for i in range(60)]
    df = spark.createDataFrame([(i, u, k) for i, (u, k) in enumerate(rows)], "page_id long, url string, known int")
    got = url_templates.judge_urls(df, label=F.col("known")).collect()
    assert {r["template"] for r in got} == {"/*/{n}", "/z/{n}"}
    assert {r["verdict"] for r in got if r["template"] == "/z/{n}"} == {"block"}
    assert {r["verdict"] for r in got if r["template"] == "/*/{n}"} == {"allow"}


def test_longest_rule_wins_and_label_counts_below_rules(spark):
    rules = (("a.b", "/cd", "allow"), ("b", "/cdef", "block"), ("b", "/", "allow"))
    df = pages(spark, ["http://a.b/cdef", "http://x.b/cdef", "http://b/c", "http://c/"])
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_templates.judge_urls(df, rules).collect()}
    assert got == {0: ("a.b/cd", "allow"), 1: ("b/cdef", "block"), 2: ("b/", "allow"), 3: (None, "allow")}


def test_empty_table(spark):
    got = url_templates.judge_urls(pages(spark, URLS).limit(0))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "template", "purity"]
    assert got.collect() == []


def test_no_python_in_the_plan(spark):
    plan = url_templates.op13_url_templates(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
