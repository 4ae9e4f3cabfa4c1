import re

import pytest

from lakeworks.llm import url_filter
from lakeworks.llm.queries import URL_RULES


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


def rule_for(host, path, rules):
    fits = [(len(r), r, v) for v, r in rules for h, p in [(r.split("/", 1)[0], "/" + r.split("/", 1)[1])]
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = ["http://a.example.org/en/12?x=1", "https://Example.ORG/es/x", "https://org/", "http://notorg/", "http://b.org", "ftp://c.com/fr/1#a/b",
        "http://c.com/de/#x", "http://c.com/DE/", "no scheme", "", None, "http://", "://x.org/a://b.com/de/", "http://É.org/de/é", "http://x.net?y=/de/",
        "http://u:p@x.com:80/fr/", "http://a.com/fr/de/\nz"]


def test_rules_by_definition(spark):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)], "page_id long, url string, html string")
    out = url_filter.judge(pages, url_filter.rule_table(spark, URL_RULES)).collect()
    assert len(out) == len(URLS)
    for r in out:
        host, path = split(URLS[r.page_id])
        assert (r.host, r.path) == (host, path)
        rule, verdict = rule_for(host, path, URL_RULES)
        assert (r.rule, r.verdict) == (rule, verdict or "allow")


def link(target, kind="canonical"):
    if kind == "canonical":
        return f"<HTML><Link href='{target}' REL=\"canonical\" >x"
    return f'<meta content="0; URL={target}" http-equiv=refresh>'


CHAIN = [
    (1, "http://x.net/a", link("http://y.net/b")),               # y.net/b -> com/de/ : blocked over two steps
    (2, "http://y.net/b#frag", link("http://z.com/de/1", "refresh")),
    (3, "http://z.com/de/1", "<p>blocked itself"),
    (4, "http://m.net/1", link("/2?a=1&amp;b=2")),                # relative; with an allowed alias: allowed
    (5, "http://m.net/2?a=1&b=2", link("http://k.com/de/")),
    (6, "http://n.net/x/y", link("../q")),
    (7, "https://s.org/any", link("//m.net/1")),
    (8, "http://own.com/de/", link("http://t.org/allowed")),     # its own rule is stronger than the alias
    (9, "http://lone.net/", link("http://never-crawled.com/de/7")),
    (10, "http://free.net/", "no links"), (11, None, link("http://z.com/de/1")), (12, "http://lone.net/", None),
]


def test_blocks_reach_aliases_and_allow_comes_first(spark):
    pages = spark.createDataFrame(CHAIN, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "1 AS node", "2 AS rule")
    got = {r.page_id: (r.verdict, r.reason) for r in url_filter.judge(pages, url_filter.rule_table(spark, URL_RULES)).collect()}
    assert got == {1: ("block", "alias"), 2: ("block", "alias"), 3: ("block", "rule"), 4: ("allow", "alias"), 5: ("allow", "alias"),
                   6: ("allow", "none"), 7: ("allow", "rule"), 8: ("block", "rule"), 9: ("block", "alias"), 10: ("allow", "none"),
                   11: ("allow", "none"), 12: ("block", "alias")}


def test_given_redirects(spark):
    pages = spark.createDataFrame([(1, "http://a.net/", None)], "page_id long, url string, html string")
    hops = spark.createDataFrame([("http://a.net", "http://b.net/"), ("http://b.net/", "http://c.com/de/"), (None, "http://c.com/de/")],
                                 "source_url string, target_url string")
    out = url_filter.judge(pages, url_filter.rule_table(spark, URL_RULES), redirects=hops).collect()
    assert [(r.verdict, r.reason) for r in out] == [("block", "alias")]


def test_many_aliases_of_one_page(spark):
    rows = [(i, f"http://h{i}.net/", link("http://hub.com/de/")) for i in range(500)]
    out = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), url_filter.rule_table(spark, URL_RULES))
    assert out.where("verdict = 'block'").count() == 500


@pytest.mark.parametrize("rules", [URL_RULES, []])
def test_empty_tables(spark, rules):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    table = url_filter.rule_table(spark, rules) if rules else spark.createDataFrame([], "host string, path string, verdict string, rule string")
    assert url_filter.judge(pages, table).collect() == []


def test_no_python_in_the_plan(spark, capsys):
    pages = spark.createDataFrame(CHAIN, "page_id long, url string, html string")
    url_filter.judge(pages, url_filter.rule_table(spark, URL_RULES)).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
