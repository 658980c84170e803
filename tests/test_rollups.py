"""Rollup windows against statistics over the log itself."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from loadlens.operators import aggregations as A
from loadlens.operators import rollups as RU
from loadlens.sources.views import logs_view


@pytest.fixture(scope="module")
def logs(spark):
    return logs_view(spark, SF01)


def test_windows_of_whole_hours(spark, logs):
    rollup = RU.save_rollup(logs, tempfile.mkdtemp(prefix="loadlens-rollup-"))
    for hours in (1, 24, 300):
        end = dt.datetime(2024, 1, 20, 5)
        got = RU.rollup_stats(rollup, end, hours).first().asDict()
        want = A.access_log_stats(logs, end - dt.timedelta(microseconds=1), hours).first().asDict()     # the other window is closed
        edge = logs.where((F.col("timestamp") >= F.lit(end - dt.timedelta(hours=hours))) & (F.col("timestamp") < F.lit(end)))
        assert got["total_requests"] == edge.count() and got["error_count"] == want["error_count"]
        for c in ("unique_ips", "unique_endpoints"):
            assert got[c] == pytest.approx(want[c], rel=RU.SKETCH_ERROR)
    empty = RU.rollup_stats(rollup, dt.datetime(2030, 1, 1), 24).first().asDict()
    assert empty == {"total_requests": 0, "avg_response_time": None, "error_count": 0, "error_rate": 0.0, "unique_ips": 0, "unique_endpoints": 0}


def test_days_are_replaced_not_added(spark, logs):
    path = tempfile.mkdtemp(prefix="loadlens-rollup-")
    day = lambda a, b: logs.where((F.to_date("timestamp") >= F.lit(a).cast("date")) & (F.to_date("timestamp") < F.lit(b).cast("date")))
    RU.save_rollup(day("2024-01-03", "2024-01-05"), path)
    RU.save_rollup(day("2024-01-04", "2024-01-06"), path)       # one day again, one new
    total = RU.read_rollup(spark, path).agg(F.sum("requests")).first()[0]
    assert total == day("2024-01-03", "2024-01-06").count()
    window = RU.rollup_stats(RU.read_rollup(spark, path), dt.datetime(2024, 1, 5), 24)
    assert "PartitionFilters: [isnotnull(day" in window._jdf.queryExecution().toString()


def test_trailing_windows(spark, logs):
    few = logs.where("timestamp < timestamp_ntz'2024-01-04'")
    out = {r.hour: r for r in RU.trailing_stats(RU.log_rollup(few), 6).collect()}
    times = [(r.timestamp, r.client_ip) for r in few.select("timestamp", "client_ip").collect()]
    assert len(out) == few.select(F.date_trunc("hour", "timestamp")).distinct().count()
    for hour, r in out.items():
        inside = [c for t, c in times if hour - dt.timedelta(hours=5) <= t < hour + dt.timedelta(hours=1)]
        assert r.total_requests == len(inside) and r.unique_ips == pytest.approx(len(set(inside)), rel=RU.SKETCH_ERROR)


def test_missing_values_and_empty_log(spark, logs):
    rows = [("2024-01-01 00:10:00", None, None, None, None), (None, "c", "/e", 1.0, 500), ("2024-01-01 00:20:00", "c", None, 4.0, 404)]
    df = spark.createDataFrame(rows, "timestamp string, client_ip string, endpoint string, response_time_ms double, response_code int")\
        .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    r = RU.rollup_stats(RU.log_rollup(df), "2024-01-01 01:00:00", 1).first()
    assert (r.total_requests, r.avg_response_time, r.error_count, r.error_rate, r.unique_ips, r.unique_endpoints) == (2, 4.0, 1, 50.0, 1, 0)
    assert RU.log_rollup(logs.limit(0)).count() == 0 and RU.trailing_stats(RU.log_rollup(logs.limit(0))).count() == 0
