"""Named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables through the stand-in views of
``loadlens.sources.views`` and applies one library operator to the whole
table.  Parameters are fixed here so that the DuckDB twin in
``loadlens.plans.oracle`` can state the same question.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.operators import aggregations as A
from loadlens.operators import anomalies as T
from loadlens.operators import chunks as U
from loadlens.operators import clustering as K
from loadlens.operators import correlate as J
from loadlens.operators import filters as P
from loadlens.operators import rollups as RU
from loadlens.operators import inference as I
from loadlens.operators import timeseries as W
from loadlens.functions import logparse as LP
from loadlens.functions.numeric import np_round
from loadlens.plans import reports as R
from loadlens.session import scratch_dir
from loadlens.sources import readers as S
from loadlens.sources import sinks as SK
from loadlens.sources import tables as TB
from loadlens.streaming import alerts as D
from loadlens.schemas import ACCESS_LOGS, HOST_METRICS, METRICS
from loadlens.sources.views import access_log_cells_view, access_log_lines_view, forecast_pairs_view, host_metrics_view, metrics_ev_from, table, logs_view, metrics_ev_view, metrics_view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


M, L, E = metrics_view, logs_view, metrics_ev_view

# ---------------------------------------------------------------- filters
query("metrics_filter")(lambda s, d: P.metrics_filter(M(s, d), "server_7", "1995-01-01", "1998-12-31"))
query("cpu_peaks")(lambda s, d: P.cpu_peaks(M(s, d)))
query("error_peaks")(lambda s, d: P.error_peaks(M(s, d)))
query("memory_peaks")(lambda s, d: P.memory_peaks(M(s, d)))
query("slow_requests")(lambda s, d: P.slow_requests(L(s, d)))
query("retention")(lambda s, d: P.retention(L(s, d), "2024-01-31 00:00:00", 30))
query("validate")(lambda s, d: P.validate(M(s, d), ["timestamp", "server_id", "cpu_usage", "host"]))

query("retention_recent")(lambda s, d: P.retention(L(s, d), "2024-01-31 00:00:00", 7))
query("validate_events")(lambda s, d: P.validate(E(s, d).select("timestamp", "server_id", "cpu_usage", "memory_usage"), ["timestamp", "memory_usage"]))


def _requests(df):
    """Events with a request count, as the hour-of-day operators read."""
    return df.withColumn("request_count", F.col("seq") % 10)


# ---------------------------------------------------------------- aggregations
query("server_stats")(lambda s, d: A.server_stats(M(s, d)))
query("server_mean_std")(lambda s, d: A.server_mean_std(M(s, d)))
query("hourly_stats")(lambda s, d: A.hourly_stats(M(s, d)))
query("hourly_log_stats")(lambda s, d: A.hourly_log_stats(L(s, d)))
query("log_overview")(lambda s, d: A.log_overview(L(s, d)))
query("metrics_overview")(lambda s, d: A.metrics_overview(M(s, d)))
query("server_list")(lambda s, d: A.server_list(M(s, d)))
query("status_counts")(lambda s, d: A.status_counts(L(s, d)))
query("method_counts")(lambda s, d: A.method_counts(L(s, d)))
query("top5_endpoints")(lambda s, d: A.top5_endpoints(L(s, d)))
query("describe_response")(lambda s, d: A.describe_response(L(s, d)))
query("access_log_stats")(lambda s, d: A.access_log_stats(L(s, d), "2024-01-31 00:00:00", 168))
query("top_endpoints")(lambda s, d: A.top_endpoints(L(s, d), 10))
query("slowest_endpoints")(lambda s, d: A.slowest_endpoints(L(s, d)))
query("busiest_server")(lambda s, d: A.busiest_server(M(s, d)))
query("peak_hour")(lambda s, d: A.peak_hour(M(s, d)))
query("server_features")(lambda s, d: A.server_features(M(s, d)))
query("server_recommendations")(lambda s, d: A.server_recommendations(M(s, d)))
query("fleet_recommendations")(lambda s, d: A.fleet_recommendations(M(s, d)))
query("correlation_matrix")(lambda s, d: A.correlation_matrix(M(s, d)))
query("cpu_response_corr")(lambda s, d: A.cpu_response_corr(M(s, d)))
query("response_histogram")(lambda s, d: A.response_histogram(M(s, d)))
query("null_profile")(lambda s, d: A.null_profile(M(s, d), by=("server_id",)))
query("hourly_stats_events")(lambda s, d: A.hourly_stats(_requests(E(s, d))))
query("peak_hour_events")(lambda s, d: A.peak_hour(_requests(E(s, d))))
query("null_profile_hourly")(lambda s, d: A.null_profile(
    E(s, d).withColumn("hour", F.hour("timestamp").cast("bigint")), by=("server_id", "hour"), columns=["cpu_usage", "memory_usage"]))
query("cpu_trend")(lambda s, d: A.cpu_trend(M(s, d)))
query("kde_curve")(lambda s, d: A.kde_curve(E(s, d)))
query("heavy_endpoints")(lambda s, d: A.heavy_endpoints(L(s, d)))
query("status_class_share")(lambda s, d: A.status_class_share(L(s, d)))
query("suspicious_clients")(lambda s, d: A.suspicious_clients(L(s, d), min_endpoints=7, min_error_share=0.25))



def _rollup(s, d):
    return RU.save_rollup(L(s, d), scratch_dir(s, "rollup"))


@query("rollup_log_stats")
def _rollup_log_stats(s, d):
    """A week from the stored rollup; the estimates are held against exact counts."""
    got = RU.rollup_stats(_rollup(s, d), "2024-01-31 00:00:00", 168)
    week = L(s, d).where((F.col("timestamp") >= F.lit("2024-01-24").cast("timestamp_ntz")) & (F.col("timestamp") < F.lit("2024-01-31").cast("timestamp_ntz")))
    exact = week.agg(F.count_distinct("client_ip").alias("_ips"), F.count_distinct("endpoint").alias("_endpoints"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.lit(RU.SKETCH_ERROR) * F.col(b)
    return got.crossJoin(exact).select("total_requests", "avg_response_time", "error_count", "error_rate",       # one row each
                                       near("unique_ips", "_ips").alias("ips_near"), near("unique_endpoints", "_endpoints").alias("endpoints_near"))


query("trailing_log_stats")(lambda s, d: RU.trailing_stats(_rollup(s, d), 24).select("hour", "total_requests", "error_count", "error_rate"))

# ---------------------------------------------------------------- log parsing
query("parse_access_log")(lambda s, d: LP.parse_access_log(access_log_lines_view(s, d)))
query("parse_errors")(lambda s, d: LP.parse_errors(access_log_lines_view(s, d))
                      .groupBy("reason").agg(F.count(F.lit(1)).alias("lines")))
query("parse_nginx_rt")(lambda s, d: LP.parse_access_log(access_log_lines_view(s, d), "nginx_rt"))

query("parse_common")(lambda s, d: LP.parse_access_log(access_log_lines_view(s, d), "common"))
query("parse_common_errors")(lambda s, d: LP.parse_errors(access_log_lines_view(s, d), "common").groupBy("reason").agg(F.count(F.lit(1)).alias("lines")))


def _log_files(s, d):
    path = scratch_dir(s, "access-log")
    access_log_lines_view(s, d).write.text(path)
    return path


query("parse_log_files")(lambda s, d: S.read_access_log_text(s, _log_files(s, d)))
query("parse_log_file_errors")(lambda s, d: S.read_access_log_errors(s, _log_files(s, d)).groupBy("reason").agg(
    F.count(F.lit(1)).alias("lines"), F.count_if(F.col("file_path").contains("access-log")).alias("with_file")))

# ---------------------------------------------------------------- time series
query("hourly_resample")(lambda s, d: W.hourly_resample(E(s, d)))
query("forecast_load")(lambda s, d: W.forecast_load(E(s, d), hours=6))
query("modal_interval")(lambda s, d: W.modal_interval(M(s, d)))
query("completeness_by_server")(lambda s, d: W.completeness_by_server(M(s, d)))
query("completeness_total")(lambda s, d: W.completeness_total(M(s, d)))
query("client_completeness")(lambda s, d: W.completeness_by_server(L(s, d), key="client_ip"))

# ---------------------------------------------------------------- anomalies
query("anomalies_zscore")(lambda s, d: T.anomalies_zscore(E(s, d), 3.0))
query("anomalies_iqr")(lambda s, d: T.anomalies_iqr(E(s, d)))
query("iqr_fences")(lambda s, d: T.iqr_fences(E(s, d)))

# ---------------------------------------------------------------- inference
query("anova_offset")(lambda s, d: I.anova(E(s, d).withColumn("cpu_usage", F.col("cpu_usage") / 1000 + 1e7)))
query("normality_test")(lambda s, d: I.normality_test(E(s, d)))
query("anova")(lambda s, d: I.anova(E(s, d)))
query("kruskal_wallis")(lambda s, d: I.kruskal_wallis(E(s, d)))
query("confidence_intervals")(lambda s, d: I.confidence_intervals(E(s, d)))
query("error_metrics")(lambda s, d: I.error_metrics(forecast_pairs_view(s, d)))
query("cluster_servers")(lambda s, d: K.cluster_servers(M(s, d)))


def _daily(s, d):
    """Mean quantity of the line items of each ship date, three suppliers' groups
    as servers: means of many values, so close to normal."""
    li = table(s, d, "lineitem")
    server = F.concat(F.lit("group_"), (F.col("l_suppkey") % 3).cast("string"))
    month = F.date_trunc("month", F.col("l_shipdate").cast("timestamp_ntz"))
    return li.groupBy(server.alias("server_id"), month.alias("timestamp")).agg(F.avg("l_quantity").alias("cpu_usage"))


def _nodes(s, d):
    """Three servers of many close to normal values each: a vector component is a
    reading of the vector's server."""
    server = F.concat(F.lit("node_"), (F.col("vec_id") % 3).cast("string"))
    return table(s, d, "embeddings").select(server.alias("server_id"), F.explode("embedding").alias("_x"))\
        .select("server_id", (F.lit(50) + F.lit(100) * F.col("_x").cast("double")).alias("cpu_usage"))


query("anderson_darling")(lambda s, d: I.anderson_darling(E(s, d)))

# ---------------------------------------------------------------- composites
query("homogeneity_large")(lambda s, d: R.homogeneity(_nodes(s, d)))
query("basic_report")(lambda s, d: R.basic_report(M(s, d)))
query("advanced_report")(lambda s, d: R.advanced_report(E(s, d)))
query("advanced_report_sections")(lambda s, d: R.advanced_report(E(s, d), clusters=False))
query("homogeneity_daily")(lambda s, d: R.homogeneity(_daily(s, d)))
query("homogeneity")(lambda s, d: R.homogeneity(E(s, d)))
query("stat_report")(lambda s, d: R.stat_report(E(s, d), forecast_pairs_view(s, d)))


# ---------------------------------------------------------------- sources and sinks
@query("compact")
def _compact(s, d):
    src = scratch_dir(s, "compact-src")
    M(s, d).write.option("maxRecordsPerFile", 20_000).parquet(src)   # a multi-file input
    return SK.compact(s, src, scratch_dir(s, "compact-dest"), target_file_mb=64)


def _loaded(s, df, kind):
    names = SK.create_tables(s, scratch_dir(s, "tables"), suffix=f"_{uuid.uuid4().hex[:12]}")
    SK.load_table(df, names[kind], kind)
    return TB.open_table(s, names[kind])


query("load_metrics")(lambda s, d: TB.data_columns(_loaded(s, M(s, d), "server_metrics")))
query("load_logs")(lambda s, d: TB.data_columns(_loaded(s, L(s, d), "access_logs")))
query("table_filter")(lambda s, d: TB.data_columns(P.metrics_filter(_loaded(s, M(s, d), "server_metrics"), "server_7", "1995-01-01", "1998-12-31")))
query("table_retention")(lambda s, d: TB.data_columns(P.retention(_loaded(s, L(s, d), "access_logs"), "2024-01-31 00:00:00", 7)))
query("table_log_stats")(lambda s, d: A.access_log_stats(_loaded(s, L(s, d), "access_logs"), "2024-01-31 00:00:00", 168))


@query("error_hours")
def _error_hours(s, d):
    """Requests during the three hours with most failed requests."""
    logs = _loaded(s, L(s, d), "access_logs")
    hour = F.date_trunc("hour", "timestamp")
    worst = logs.where(P.is_error()).groupBy(hour.alias("start")).agg(F.count(F.lit(1)).alias("errors")).orderBy(F.desc("errors"), "start").limit(3)
    hits = TB.rows_in_windows(logs, worst.select("start", (F.col("start") + F.expr("INTERVAL 1 HOUR")).alias("end")))
    return hits.groupBy(F.col("start").alias("hour"), "endpoint").agg(F.count(F.lit(1)).alias("requests"), F.count_if(P.is_error()).alias("errors"))


@query("csv_roundtrip")
def _csv_roundtrip(s, d):
    path = scratch_dir(s, "metrics-csv")
    SK.write_csv(M(s, d), path)
    return S.read_metrics_csv(s, path)


def _log_cells(s, d):
    path = scratch_dir(s, "logs-csv")
    access_log_cells_view(s, d).write.option("header", True).csv(path)
    return path


query("csv_logs")(lambda s, d: S.read_access_logs_csv(s, _log_cells(s, d)))
query("csv_errors")(lambda s, d: S.read_csv_errors(s, _log_cells(s, d), ACCESS_LOGS).groupBy("reason").agg(
    F.count(F.lit(1)).alias("records"), F.count_if(F.col("file_path").contains("logs-csv")).alias("with_file")))


def _host_files(s, d):
    """Host files of two layouts below one folder: the agent's own, and another with
    other names and order, a column more and one less."""
    path, rows = scratch_dir(s, "host"), host_metrics_view(s, d)
    SK.write_csv(rows.where(F.col("server_id").isin("click", "view")), f"{path}/a")
    other = rows.where(~F.col("server_id").isin("click", "view")).drop("swap_usage").withColumnsRenamed({"server_id": "Host", "cpu_usage": "cpu"})
    SK.write_csv(other.select(F.lit("2.1").alias("agent"), *reversed(other.columns)), f"{path}/b")
    return f"{path}/*"


@query("load_formats")
def _load_formats(s, d):
    """The same rows written in two formats and read by their suffix."""
    path = scratch_dir(s, "formats")
    SK.write_parquet(M(s, d), f"{path}/metrics.parquet")
    SK.write_csv(M(s, d), f"{path}/metrics.csv")
    return S.union_sources({"parquet": S.load(s, f"{path}/metrics.parquet"), "csv": S.load(s, f"{path}/metrics.csv", schema=METRICS)}).select(
        "source", "timestamp", "server_id", "cpu_usage", "request_count")


@query("report_sink")
def _report_sink(s, d):
    path = scratch_dir(s, "report")
    R.write_report(R.basic_report(M(s, d)), path)
    return R.read_report(s, path)


@query("host_files")
def _read_host_files(s, d):
    rows = S.read_host_metrics(s, _host_files(s, d))
    layout = F.regexp_extract("source_file", "/([ab])/[^/]*$", 1)
    return rows.withColumn("layout", layout).withColumn("dated", F.col("file_time").isNotNull()).drop("source_file", "file_time")


query("host_layouts")(lambda s, d: S.file_layouts(s, _host_files(s, d), HOST_METRICS, S.HOST_ALIASES).select(
    F.concat_ws(",", "columns").alias("columns"), F.concat_ws(",", "missing").alias("missing"), F.concat_ws(",", "unknown").alias("unknown")).distinct())


@query("hybrid_files")
def _hybrid_files(s, d):
    logs = scratch_dir(s, "hybrid")
    SK.write_csv(L(s, d), logs)
    rows = S.union_files(s, {"host": (_host_files(s, d), HOST_METRICS, S.HOST_ALIASES), "access_logs": (logs, ACCESS_LOGS)})
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.count("server_id").alias("servers"), F.count("endpoint").alias("endpoints"),
                                      F.count("source_file").alias("with_file"))


@query("storage_footprint")
def _storage_footprint(s, d):
    f = SK.storage_footprint(M(s, d), scratch_dir(s, "footprint"))
    return f.select("format", "rows", (F.col("bytes") > 0).alias("has_bytes"), (F.col("ratio") > 1).alias("below_csv"))


query("hybrid_sources")(lambda s, d: S.source_counts({"metrics": M(s, d), "metrics_ev": E(s, d)}))
query("hybrid_union")(lambda s, d: S.union_sources({"metrics": M(s, d), "metrics_ev": E(s, d), "access_logs": L(s, d)}))
query("chunk_summary")(lambda s, d: U.chunk_summary(M(s, d)).select(
    "rows", np_round("avg_cpu", 6).alias("avg_cpu"), "max_response"))
query("chunk_apply")(lambda s, d: U.load_level(M(s, d)))
query("logs_metrics_join")(lambda s, d: J.logs_metrics_join(L(s, d), E(s, d)))


# ---------------------------------------------------------------- streaming
def _event_stream(s, d):
    schema = table(s, d, "events").schema
    ev = s.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return metrics_ev_from(ev)


query("stream_alerts")(lambda s, d: D.run_alerts(s, _event_stream(s, d)))
query("stream_hourly")(lambda s, d: D.run_hourly(s, _event_stream(s, d)))
