"""Goldens: the parser's sample log and the seed-42 statistical report."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import MALFORMED, SAMPLE_LOG, SAMPLE_PARSED, STAT_SCHEMA, stat_golden_rows
from loadlens.functions import logparse as LP
from loadlens.operators import aggregations as A
from loadlens.operators import filters as P
from loadlens.operators import inference as I
from loadlens.operators import timeseries as W


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_parse_sample_log(spark):
    out = LP.parse_access_log(lines(spark, SAMPLE_LOG)).orderBy("timestamp").collect()
    assert len(out) == 10
    for row, (sec, ip, method, ep, code, size, ms) in zip(out, SAMPLE_PARSED):
        assert row.timestamp == dt.datetime(2024, 10, 9, 10, 30, sec)
        assert (row.client_ip, row.request_method, row.endpoint) == (ip, method, ep)
        assert (row.response_code, row.response_size, row.response_time_ms) == (code, size, ms)
        assert (row.referer, row.user_agent) == ("https://example.com", "Mozilla/5.0")
    assert list(LP.parse_access_log(lines(spark, SAMPLE_LOG)).columns) == LP.ACCESS_LOG_COLUMNS


def test_sample_log_facts(spark):
    logs = LP.parse_access_log(lines(spark, SAMPLE_LOG))
    ov = A.log_overview(logs).first()
    assert (ov.total_requests, ov.unique_clients, ov.unique_endpoints) == (10, 6, 10)
    assert ov.response_time_ms_mean == 179.1
    st = A.access_log_stats(logs, "2024-10-09 12:00:00", 24).first()
    assert (st.error_count, st.error_rate) == (3, 30.0)
    assert P.slow_requests(logs).count() == 1
    methods = {r.request_method: r["count"] for r in A.method_counts(logs).collect()}
    assert methods == {"GET": 7, "POST": 2, "PUT": 1}


def test_quarantine(spark):
    df = lines(spark, SAMPLE_LOG + MALFORMED + ["", "   "])
    assert LP.parse_access_log(df).count() == 10
    errs = {r.line: r.reason for r in LP.parse_errors(df).collect()}
    assert len(errs) == 5                               # blank lines are skipped silently
    assert errs[MALFORMED[1]] == "bad_timestamp"
    assert all(errs[m] == "no_match" for i, m in enumerate(MALFORMED) if i != 1)
    rt = LP.parse_access_log(df, "nginx_rt").collect()
    assert len(rt) == 1 and rt[0].response_time_ms == 100.0 and rt[0].x_forwarded_for is None


def test_control_characters(spark):
    good = SAMPLE_LOG[0]
    poison = ["\u0002not a line", "\u0002" + good[:20], good.replace('"Mozilla/5.0"', '"Mo\u0001zilla"'), good.replace("https://example.com", "r\u0001x\u0002"),
              "\u0001", "a \u0002 b"]
    df = lines(spark, poison + [good])
    got = {(r.referer, r.user_agent) for r in LP.parse_access_log(df).collect()}
    assert got == {("https://example.com", "Mo\u0001zilla"), ("r\u0001x\u0002", "Mozilla/5.0"), ("https://example.com", "Mozilla/5.0")}
    assert sorted(r.line for r in LP.parse_errors(df).collect()) == sorted([poison[0], poison[1], poison[4], poison[5]])


@pytest.fixture(scope="module")
def golden(spark):
    return spark.createDataFrame(stat_golden_rows(), STAT_SCHEMA)


def test_golden_completeness(spark, golden):
    total = W.completeness_total(golden).first()
    assert (total.expected, total.actual, total.completeness_pct) == (613, 613, 100.0)
    by = {r.server_id: (r.actual, r.expected, r.completeness_pct)
          for r in W.completeness_by_server(golden).collect()}
    assert by == {"web01": (203, 217, 93.55), "db01": (204, 217, 94.01), "api01": (206, 216, 95.37)}


def test_golden_kruskal(golden):
    kw = I.kruskal_wallis(golden).first()
    assert (kw.h_statistic, kw.p_value, kw.homogeneous) == (1.1626, 0.5592, True)


def test_golden_confidence_intervals(golden):
    ci = {r.metric: r for r in I.confidence_intervals(golden).collect()}
    expect = {"cpu_usage": (50.3328, 1.1414, 49.1914, 51.4742, 2.27),
              "memory_usage": (59.8767, 0.7997, 59.0770, 60.6763, 1.34),
              "response_time_ms": (100.6741, 2.2981, 98.3760, 102.9722, 2.28),
              "error_rate": (0.9537, 0.0754, 0.8783, 1.0291, 7.91)}
    for m, (mean, moe, lo, hi, rel) in expect.items():
        r = ci[m]
        assert (r.mean, r.margin_of_error, r.ci_lower, r.ci_upper, r.relative_error_percent) == (mean, moe, lo, hi, rel)
        assert r.t_critical == 1.9638 and r.sample_size == 613


def test_common_log_format(spark):
    df = lines(spark, ['127.0.0.1 - frank [10/Oct/2000:13:55:36 -0700] "GET /apache_pb.gif HTTP/1.0" 200 2326',
                       'host.example - - [01/Jul/1995:00:00:01 -0400] "GET /history/ HTTP/1.0" 304 -'])
    rows = LP.parse_access_log(df, "common").orderBy("timestamp").collect()
    assert [r.endpoint for r in rows] == ["/history/", "/apache_pb.gif"]
    assert rows[0].response_size == 0 and rows[1].remote_user == "frank" and rows[0].remote_user is None
    assert rows[1].timestamp == dt.datetime(2000, 10, 10, 13, 55, 36)


def test_drop_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 1.0), (None, 1.0), (3.0, None)], "p double, a double")
    assert P.drop_missing(df, ["p", "a"]).count() == 1
