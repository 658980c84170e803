"""Edge fixtures: NULL keys, NaN, one-row and constant groups, ties, empty
input, duplicate rows, empty hours, forecast-error hand case."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from loadlens.functions.numeric import normalize_nans
from loadlens.operators import aggregations as A
from loadlens.operators import anomalies as T
from loadlens.operators import filters as P
from loadlens.operators import inference as I
from loadlens.operators import timeseries as W
from loadlens.schemas import METRICS

T0 = dt.datetime(2024, 1, 1, 9, 0)


def metrics(spark, rows):
    full = [(r + (None,) * 9)[:9] for r in rows]
    return spark.createDataFrame(full, METRICS.simpleString().replace("struct<", "").rstrip(">").replace(":", " "))


@pytest.fixture(scope="module")
def edge(spark):
    h = lambda i: T0 + dt.timedelta(hours=i)
    rows = [
        (h(0), "web01", 45.2, 67.8, 120.5, 45.3, 1500, 0.5, 145.2),
        (h(1), "web01", 95.0, 60.0, 1.0, 1.0, 10, 8.0, 500.0),
        (h(3), "web01", 50.0, float("nan"), 1.0, 1.0, 20, 1.0, 150.0),   # hour 2 empty
        (h(0), "api02", 78.9, 45.1, 89.3, 120.7, 2300, 2.1, 89.5),          # one-row server
        (h(0), None, 10.0, 10.0, 1.0, 1.0, 1, 0.1, 10.0),                   # NULL key
    ]
    return normalize_nans(metrics(spark, rows))


def test_null_key_and_one_row_group(edge):
    s = {r.server_id: r for r in A.server_stats(edge).collect()}
    assert set(s) == {"web01", "api02"}
    assert s["api02"].cpu_usage_std is None and s["api02"].cpu_usage_mean == 78.9
    assert s["web01"].memory_usage_mean == 63.9          # NaN counted as missing


def test_thresholds_are_strict(edge):
    assert P.cpu_peaks(edge).count() == 1
    assert P.error_peaks(edge).count() == 1
    assert edge.where(F.col("response_time_ms") > 500).count() == 0   # 500 is not > 500


def test_constant_column_correlation(spark):
    df = metrics(spark, [(T0, "a", 5.0, 1.0, 1.0, 1.0, 1, 1.0, 2.0), (T0, "a", 5.0, 2.0, 1.0, 1.0, 1, 1.0, 3.0)])
    assert A.cpu_response_corr(df).first().cpu_response_corr is None
    m = {(r.x, r.y): r.r for r in A.correlation_matrix(df).collect()}
    assert m[("memory_usage", "response_time_ms")] == 1.0 and m[("cpu_usage", "memory_usage")] is None


def test_ties_in_top_k(spark):
    rows = [(T0, f"s{i}", 50.0, 1.0, 1.0, 1.0, 1, 1.0, 1.0) for i in (3, 1, 2)]
    assert A.busiest_server(metrics(spark, rows)).first().server_id == "s1"
    logs = spark.createDataFrame([("/b",), ("/a",), ("/c",), ("/a",), ("/b",)], "endpoint string")
    assert [r.endpoint for r in A.top5_endpoints(logs, 2).collect()] == ["/a", "/b"]


def test_empty_input(spark):
    empty = metrics(spark, []).where("false")
    assert A.server_stats(empty).count() == 0
    assert W.completeness_total(empty).count() == 1 and W.completeness_total(empty).first().actual == 0
    assert T.anomalies_zscore(empty).count() == 0
    assert I.kruskal_wallis(empty).count() == 0
    v = {r.check: r for r in P.validate(empty, ["cpu_usage"]).collect()}
    assert "empty" in v and v["is_valid"].value == 1 and "null_values" not in v


def test_validate_missing_columns_and_nulls(edge):
    rows = P.validate(edge, ["timestamp", "host"]).collect()
    checks = {(r.check, r.column): r.value for r in rows}
    assert ("missing_column", "host") in checks and checks[("is_valid", None)] == 0
    assert checks[("null_values", "server_id")] == 1 and checks[("null_values", "memory_usage")] == 1


def test_hourly_resample_keeps_empty_hours(edge):
    out = {r.hour: r.cpu_usage_mean for r in W.hourly_resample(edge).collect()}
    assert len(out) == 4 and out[T0 + dt.timedelta(hours=2)] is None


def test_forecast_needs_full_window(edge):
    rows = W.forecast_load(edge, hours=6).orderBy("hour").collect()
    assert len(rows) == 4                                # only 4 hours exist in the span
    assert [r.forecast for r in rows][:3] == [None, None, None]   # hour 2 is empty
    assert rows[3].forecast is None


def test_anomalies_collapse_duplicates(spark):
    base = [(T0 + dt.timedelta(minutes=i), "a", 50.0, 50.0, 1.0, 1.0, 1, 1.0, 100.0) for i in range(30)]
    spike = (T0, "a", 500.0, 50.0, 1.0, 1.0, 1, 1.0, 100.0)
    df = metrics(spark, base + [spike, spike])
    z = T.anomalies_zscore(df, 3.0)
    assert z.count() == 1                                # duplicate rows collapse
    assert T.anomalies_iqr(df).count() == 1
    assert T.detect_anomalies(df, "unknown").count() == 0


def test_error_metrics_hand_case(spark):
    pairs = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 2.0), (3, 3.0, 3.0), (4, 3.0, 4.0),
                                   (5, None, 9.0), (6, float("nan"), 1.0)],
                                  "seq long, predicted double, actual double")
    r = I.error_metrics(pairs).first()
    assert (r.mae, r.mse, r.rmse, r.mape, r.r_squared, r.durbin_watson) == (0.5, 0.5, 0.7071, 18.75, 0.6, 1.5)


def test_error_metrics_edges(spark):
    mk = lambda rows: spark.createDataFrame(rows, "seq long, predicted double, actual double")
    zero = I.error_metrics(mk([(1, 1.0, 0.0), (2, 2.0, 0.0)])).first()
    assert zero.mape is None and zero.r_squared is None
    perfect = I.error_metrics(mk([(1, 1.0, 1.0), (2, 2.0, 2.0)])).first()
    assert perfect.durbin_watson is None and perfect.r_squared == 1.0
    assert I.error_metrics(mk([])).count() == 0


def test_recommendations_rounding_and_else_if(spark):
    rows = [(T0, "a", 95.0, 1.0, 1.0, 1.0, 1, 1.0, 250.0), (T0, "a", 46.0, 1.0, 1.0, 1.0, 1, 1.0, 250.0),
            (T0, "b", 80.0, 1.0, 1.0, 1.0, 1, 1.0, 10.0)]
    rec = {(r.server_id, r.rule) for r in A.server_recommendations(metrics(spark, rows)).collect()}
    assert rec == {("a", "scale"), ("a", "slow_response"), ("b", "scale")}


def test_histogram_counts_every_row(spark, edge):
    h = A.response_histogram(edge)
    assert h.agg(F.sum("count")).first()[0] == edge.where("server_id is not null").count()
    one = h.where("server_id = 'api02'").first()
    assert (one.lo, one.hi, one.bin) == (89.5, 89.55, 10)  # constant group: [x-0.5, x+0.5], middle bin


def test_slowest_endpoints_rank_on_the_raw_mean(spark):
    rows = [("/a", 600.001), ("/b", 600.004), ("/c", 600.003), ("/d", 600.002)]
    df = spark.createDataFrame(rows, "endpoint string, response_time_ms double")
    assert [r.endpoint for r in A.slowest_endpoints(df).collect()] == ["/b", "/c", "/d"]


def test_approximate_distinct_counts(spark):
    rows = [("2024-01-01 00:00:00", f"10.0.0.{i % 200}", f"/e{i % 50}", 1.0, 200) for i in range(2000)]
    df = spark.createDataFrame(rows, "timestamp string, client_ip string, endpoint string, response_time_ms double, response_code int")\
        .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    r = A.access_log_stats(df, "2024-01-01 01:00:00", 24, approximate=True).first()
    assert abs(r.unique_ips - 200) <= 30 and abs(r.unique_endpoints - 50) <= 8 and r.total_requests == 2000
    o = A.log_overview(df, approximate=True).first()
    assert abs(o.unique_clients - 200) <= 30 and A.log_overview(df).first().unique_clients == 200


def test_long_gap_is_filled_by_several_tasks(spark):
    """One stray date: a gap of 10 million hours, and two short ones."""
    first = dt.datetime(1000, 1, 1)
    times = [first, first + dt.timedelta(hours=3), first + dt.timedelta(hours=5, minutes=30), first + dt.timedelta(hours=10_000_005)]
    df = spark.createDataFrame([(t, 1.0) for t in times], "timestamp timestamp_ntz, cpu_usage double")
    out = W.hourly_resample(df)
    r = out.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("hour").alias("hours"), F.count("cpu_usage_mean").alias("filled"), F.max("hour").alias("last"), F.min("hour").alias("first")).first()
    assert (r.n, r.hours, r.filled, r.first, r.last) == (10_000_006, 10_000_006, 4, first, times[-1])
    per_task = [r["count"] for r in W.missing_hours(out.where("cpu_usage_mean is not null")).groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) >= 3 and max(per_task) < 0.6 * 10_000_002


def test_no_gap_to_fill(spark):
    df = spark.createDataFrame([(T0, 1.0), (T0 + dt.timedelta(hours=1), None)], "timestamp timestamp_ntz, cpu_usage double")
    assert sorted(W.hourly_resample(df).collect()) == [(T0, 1.0), (T0 + dt.timedelta(hours=1), None)]
    assert W.hourly_resample(df.limit(1)).count() == 1 and W.hourly_resample(df.limit(0)).count() == 0
