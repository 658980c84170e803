"""Hourly log rollups with distinct-count sketches.

A rollup keeps, per clock hour, what windowed log statistics need: counts, sums and
HyperLogLog sketches of clients and endpoints.  Sketches merge, so any window of
whole hours is answered from one small row per hour, without reading the log again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions.numeric import np_round
from loadlens.operators.filters import is_error

SKETCH_BITS = 14            # 2^14 registers: standard error 0.81 %
#: Relative error that an estimate exceeds in fewer than 3 of 1,000 cases (three standard errors).
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def log_rollup(logs: DataFrame) -> DataFrame:
    """One row per hour with rows: ``day, hour, requests, errors, timed``
    (requests with a response time), ``time_sum, clients, endpoints`` (sketches).
    Rows without a time are left out; NULL clients and endpoints are not counted."""
    hour = F.date_trunc("hour", F.col("timestamp")).cast("timestamp_ntz")
    return (logs.where(F.col("timestamp").isNotNull()).groupBy(F.to_date(hour).alias("day"), hour.alias("hour"))
            .agg(F.count(F.lit(1)).alias("requests"), F.count_if(is_error()).alias("errors"), F.count("response_time_ms").alias("timed"),
                 F.coalesce(F.sum("response_time_ms"), F.lit(0.0)).alias("time_sum"),
                 F.hll_sketch_agg("client_ip", SKETCH_BITS).alias("clients"), F.hll_sketch_agg("endpoint", SKETCH_BITS).alias("endpoints")))


def save_rollup(logs: DataFrame, path: str) -> DataFrame:
    """Write the rollup of ``logs`` to a table folder partitioned by day.  The days of
    ``logs`` are replaced, others stay: a new day is added by its own rows alone, and
    a day loaded again is not counted twice."""
    log_rollup(logs).repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    return read_rollup(logs.sparkSession, path)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _summary(rows: DataFrame, *by: Column) -> DataFrame:
    estimate = lambda sketch: F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(sketch)), F.lit(0)).cast("bigint")
    agg = rows.groupBy(*by).agg(F.coalesce(F.sum("requests"), F.lit(0)).alias("total_requests"), F.try_divide(F.sum("time_sum"), F.sum("timed")).alias("_mean"),
                                F.coalesce(F.sum("errors"), F.lit(0)).alias("error_count"), estimate("clients").alias("unique_ips"), estimate("endpoints").alias("unique_endpoints"))
    share = F.when(F.col("total_requests") > 0, np_round(F.col("error_count") / F.col("total_requests") * 100, 2)).otherwise(F.lit(0.0))
    return agg.select(*[c for c in agg.columns if c not in ("total_requests", "_mean", "error_count", "unique_ips", "unique_endpoints")],
                      "total_requests", np_round("_mean", 2).alias("avg_response_time"), "error_count", share.alias("error_rate"), "unique_ips", "unique_endpoints")


def rollup_stats(rollup: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """The windowed log statistics of the ``hours`` whole hours before ``as_of``
    (itself a whole hour; the window is half-open), always one row.  Counts, rate and
    mean are exact; distinct clients and endpoints are estimates (``SKETCH_ERROR``).
    Only the partitions of the window's days are read."""
    end = F.lit(as_of).cast("timestamp_ntz")
    start = end - F.expr(f"INTERVAL {int(hours)} HOURS")
    inside = (F.col("hour") >= start) & (F.col("hour") < end) & (F.col("day") >= F.to_date(start)) & (F.col("day") <= F.to_date(end))
    return _summary(rollup.where(inside))


def trailing_stats(rollup: DataFrame, hours: int = 24) -> DataFrame:
    """The same for the ``hours`` hours up to and including each hour of the rollup.
    An hour's row goes to the windows it lies in; each window merges at most
    ``hours`` rows."""
    ends = F.explode(F.sequence(F.col("hour"), F.col("hour") + F.expr(f"INTERVAL {int(hours) - 1} HOURS"), F.expr("INTERVAL 1 HOUR")))
    spread = rollup.withColumn("_end", ends)
    seen = rollup.select(F.col("hour").alias("_end"))
    return _summary(spread.join(seen, "_end", "left_semi"), F.col("_end").alias("hour"))
