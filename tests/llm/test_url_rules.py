"""Verdicts against plain string tests, by both kinds of join; edges and the SQL twin."""

import random

import __spark_entry__ as entry
import pytest
from conftest import SF01

from loadlens.llm.url_rules import RULES, judge_urls, rules_frame
from oracle_compare import compare, duck

SCHEMA = "page_id bigint, url string, host string, path string, key string, rule string, found string, prefix string"


def plain_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host = rest[:min(ends, default=len(rest))]
    path = rest[len(host):].split("?")[0].split("#")[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_judge(rows, rules):
    out = []
    for page_id, url in rows:
        host, path = plain_split(url)
        fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules
                if (host == h or (h and host.endswith("." + h))) and path.startswith(p)]
        best = max(fits, default=None)
        out.append((page_id, host, path, best[3] if best else None, best[2] if best else "allow"))
    return sorted(out, key=str)


def judged(spark, rows, rules, **kw):
    df = spark.createDataFrame([(i, u, "h", "p", "k", "r", "f", "x") for i, u in rows], SCHEMA)
    result = judge_urls(df, rules_frame(spark, rules), **kw)
    assert result.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted((tuple(r) for r in result.collect()), key=str)


URLS = [None, "", "   ", "net/", "http://net", "http://net/", "http://NET/x", "http://a.net/en/1", "http://example.net/en/1", "http://x.Example.NET/en/", "http://example.net/en",
        "http://notexample.net/en/", "http://example.com/de/1", "http://www.example.com/DE/1", "https://a.b.org/fr/#x", "https://org/fr/x?y=://net/", "https://org?/fr/", "://", ":///",
        "://.net/", "http://net./", "http://u:p@net:80/", "x://y://net/", "http://é.net/é", "http://a.net#/b", "ftp://example.org/fr", "http://" + "a." * 3000 + "net/" + "p/" * 50_000]


@pytest.mark.parametrize("kw", [{}, {"most_rules": 0, "most_keys": 0}])
def test_contract_rules(spark, kw):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://net/"), (5, "http://net/"), (5, "http://net/")]
    assert judged(spark, rows, RULES, **kw) == plain_judge(rows, RULES)


@pytest.mark.parametrize("kw", [{}, {"most_rules": 0, "most_keys": 0}])
def test_many_rules_of_all_lengths(spark, kw):
    rng = random.Random(4)
    label = lambda: rng.choice(["a", "bb", "ccc", "net", "org"])
    host = lambda: ".".join(label() for _ in range(rng.randint(1, 4)))
    path = lambda: "".join(rng.choice("/abc") for _ in range(rng.randint(0, 5)))
    rules = {(host(), path()): rng.choice(["allow", "block"]) for _ in range(300)}
    rules[("", "")] = "block"
    rules = [(h, p, v) for (h, p), v in rules.items()]
    rows = [(i, f"http://{host()}/{path()}") for i in range(600)] + [(i, "http://hot.net/a/b") for i in range(300)] + [(1, None)]
    assert judged(spark, rows, rules, **kw) == plain_judge(rows, rules)


def test_ties_nulls_and_empty_tables(spark):
    rows = [(1, "http://a.net/x"), (2, "http://b.org/")]
    assert judged(spark, rows, [("NET", None, "allow"), ("net", "", "block"), (None, "/x", "allow")]) == [(1, "a.net", "/x", "net", "block"), (2, "b.org", "/", None, "allow")]
    # equally long rules: the longer host
    assert judged(spark, rows, [("net", "/x", "block"), ("a.net", "", "allow")])[0][3:] == ("a.net", "allow")
    assert judged(spark, [], RULES) == []
    df = spark.createDataFrame(rows, "page_id bigint, url string")
    no_rules = judge_urls(df, rules_frame(spark).limit(0), default="block")
    assert {(r["rule"], r["verdict"]) for r in no_rules.collect()} == {(None, "block")}
    with pytest.raises(Exception, match="verdict of a rule"):
        judged(spark, rows, [("net", "/", "maybe")])


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "http://net/")], "page_id bigint, url string")
    plan = judge_urls(df, rules_frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan


def test_query_matches_sql(spark):
    ok, msg, _ = compare(spark, duck(SF01), "op13_urls", entry.queries()["op13_urls"], entry.oracle_sql()["op13_urls"], SF01)
    assert ok, msg
