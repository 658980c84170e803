"""Logs and metrics side by side: both are aggregated to a time bucket
first (partial aggregation, one row per bucket) and then equi-joined on the
bucket, so the join inputs are bounded by the number of buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions.numeric import np_round
from loadlens.operators.filters import is_error


def logs_metrics_join(logs: DataFrame, metrics: DataFrame, bucket: str = "hour") -> DataFrame:
    """Per time bucket: request count, error count, mean response time from
    the access log, and mean/max cpu from the metrics (inner join)."""
    lg = (logs.where(F.col("timestamp").isNotNull())
              .groupBy(F.date_trunc(bucket, "timestamp").alias("bucket"))
              .agg(F.count(F.lit(1)).alias("requests"), F.count_if(is_error()).alias("errors"),
                   np_round(F.avg("response_time_ms"), 4).alias("response_time_ms_mean")))
    mt = (metrics.where(F.col("timestamp").isNotNull())
                 .groupBy(F.date_trunc(bucket, "timestamp").alias("bucket"))
                 .agg(np_round(F.avg("cpu_usage"), 4).alias("cpu_usage_mean"),
                      F.max("cpu_usage").alias("cpu_usage_max")))
    return lg.join(mt, "bucket")
