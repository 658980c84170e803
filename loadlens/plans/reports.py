"""Report composites in long form ``(section, subject, metric, value, text)``.

Each composite is a union of the operators' own results (no re-computation
on the driver); a section appears only when its operator produced rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.operators import aggregations as A
from loadlens.operators import anomalies as T
from loadlens.operators import clustering as K
from loadlens.operators import inference as I
from loadlens.operators import timeseries as W
from loadlens.schemas import METRIC_COLUMNS, REPORT
from loadlens.session import materialize


def to_long(df: DataFrame, section: str, subject: Column | str | None, metrics: Sequence[str],
            text: Column | None = None) -> DataFrame:
    """Wide rows -> one report row per (row, metric); booleans become 1/0."""
    subj = (F.lit(None).cast("string") if subject is None
            else (F.col(subject) if isinstance(subject, str) else subject).cast("string"))
    txt = F.lit(None).cast("string") if text is None else text.cast("string")
    entries = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                        for m in metrics])
    return df.select(F.lit(section).alias("section"), subj.alias("subject"), txt.alias("text"),
                     F.explode(entries).alias("e"))\
        .select("section", "subject", "e.metric", "e.value", "text")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def basic_report(metrics: DataFrame) -> DataFrame:
    """Busiest server, peak hour, cpu/response correlation, fleet rules."""
    return _union([
        to_long(A.busiest_server(metrics), "busiest_server", "server_id", ["cpu_usage_mean"]),
        to_long(A.peak_hour(metrics), "peak_hour", None, ["hour", "request_count_sum"]),
        to_long(A.cpu_response_corr(metrics), "correlation", None, ["cpu_response_corr"]),
        A.fleet_recommendations(metrics).select(
            F.lit("recommendation").alias("section"), F.lit(None).cast("string").alias("subject"),
            F.col("rule").alias("metric"), F.col("value").cast("double").alias("value"),
            F.lit(None).cast("string").alias("text")),
    ])


def advanced_report(metrics: DataFrame, forecast_hours: int = 6, top: int = 5, clusters: bool = True) -> DataFrame:
    """Anomaly count and the first ``top`` anomalous rows (by time, server and
    values), clusters (optional), load forecast and per-server recommendations; no rows
    for an empty input."""
    hits = materialize(T.anomalies_zscore(metrics))
    anomalies = hits.agg(F.count(F.lit(1)).alias("anomalous_rows"))
    present = [c for c in METRIC_COLUMNS if c in metrics.columns]
    first = hits.orderBy("timestamp", "server_id", *present).limit(top)
    return _union([
        to_long(anomalies, "anomalies", None, ["anomalous_rows"]),
        to_long(first, "anomaly_rows", F.concat_ws(" ", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), F.col("server_id")), present),
        *([to_long(K.cluster_servers(metrics), "clusters", "server_id", ["cluster"])] if clusters else []),
        to_long(W.forecast_load(metrics, forecast_hours), "forecast",
                F.date_format("hour", "yyyy-MM-dd HH:mm"), ["forecast"]),
        A.server_recommendations(metrics).select(
            F.lit("recommendation").alias("section"), F.col("server_id").alias("subject"),
            F.col("rule").alias("metric"), F.col("value").cast("double").alias("value"),
            F.lit(None).cast("string").alias("text")),
    ])


def homogeneity(metrics: DataFrame, column: str = "cpu_usage", key: str = "server_id") -> DataFrame:
    """Normality per server, ANOVA (only when every server passed a normality
    test) and Kruskal-Wallis, in long form.  Servers with more values than
    Shapiro-Wilk has a p-value for are judged by Anderson-Darling, in a section of
    their own."""
    norm = materialize(I.normality_test(metrics, column, key))
    servers = metrics.where(F.col(key).isNotNull()).select(key).distinct()
    beyond = norm.where(F.col("n") > I.SHAPIRO_MAX_N).select(key)
    large = materialize(I.anderson_darling(metrics.join(beyond, key, "left_semi"), column, key)) if beyond.take(1) else None
    judged = norm.select(key, "is_normal")
    if large is not None:
        judged = judged.join(beyond, key, "left_anti").unionByName(large.select(key, "is_normal"))
    # every server must have passed
    gate = servers.join(judged, key, "left")\
        .agg(F.coalesce(F.bool_and(F.coalesce(F.col("is_normal"), F.lit(False))), F.lit(False)).alias("_all"))
    anova = I.anova(metrics, column, key).crossJoin(gate).where(F.col("_all")).drop("_all")
    return _union([
        to_long(norm, "normality_test", key, ["statistic", "p_value", "is_normal"]),
        *([to_long(large, "normality_large", key, ["statistic", "p_value", "is_normal"])] if large is not None else []),
        to_long(anova, "anova", None, ["f_statistic", "p_value", "homogeneous"]),
        to_long(I.kruskal_wallis(metrics, column, key), "kruskal_wallis", None,
                ["h_statistic", "p_value", "homogeneous"]),
    ])


CI_FIELDS = ["mean", "std_dev", "sample_size", "confidence_level", "t_critical", "standard_error",
             "margin_of_error", "ci_lower", "ci_upper", "relative_error_percent"]
ERROR_FIELDS = ["mae", "mse", "rmse", "mape", "r_squared", "durbin_watson"]


def stat_report(metrics: DataFrame, pairs: DataFrame | None = None, column: str = "cpu_usage") -> DataFrame:
    """Statistical evaluation report: completeness (overall and per server),
    Kruskal-Wallis homogeneity, confidence intervals, forecast-error metrics."""
    parts = [
        to_long(W.completeness_total(metrics), "completeness", F.lit("all"),
                ["expected", "actual", "completeness_pct"]),
        to_long(W.completeness_by_server(metrics), "completeness", "server_id",
                ["expected", "actual", "completeness_pct"]),
        to_long(I.kruskal_wallis(metrics, column), "homogeneity", None, ["h_statistic", "p_value", "homogeneous"]),
        to_long(I.confidence_intervals(metrics), "confidence_intervals", "metric", CI_FIELDS),
    ]
    if pairs is not None:
        parts.append(to_long(I.error_metrics(pairs), "error_metrics", None, ERROR_FIELDS))
    return _union(parts)


def write_report(report: DataFrame, path: str, fmt: str = "json") -> None:
    """Persist a long-form report (JSON lines or CSV with header)."""
    w = report.select(*[f.name for f in REPORT.fields]).write.mode("overwrite")
    (w.json(path) if fmt == "json" else w.option("header", True).csv(path))


def read_report(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """A report written by :func:`write_report`."""
    reader = spark.read.schema(REPORT)
    return reader.json(path) if fmt == "json" else reader.option("header", True).csv(path)
