"""Time-series operators: hourly resampling, trailing-mean "forecast",
sampling-interval mode and data completeness.

Row-to-row differences use :func:`loadlens.operators.ordered.with_prev`,
which works per (group, value-range bucket) instead of one window over a
whole group, so a server holding a third of all rows is still split across
tasks.  Duplicate timestamps are collapsed first: ``c`` copies of one time
contribute ``c - 1`` zero differences.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions.numeric import np_round
from loadlens.operators.ordered import with_prev
from loadlens.session import materialize


STRIDE_HOURS = 4_096        # hours of a gap that one row of the fill stands for
STRIDES_PER_TASK = 64       # such rows that one task fills


def missing_hours(hourly: DataFrame, hour: str = "hour") -> DataFrame:
    """The hours between the first and the last of ``hourly`` (one row each) that it
    lacks.

    An hour's successor ends its gap; a gap is cut into strides of ``STRIDE_HOURS``
    that are dealt to the tasks before they are filled, so neither a long gap nor
    many short ones end in one task or one array."""
    gaps = with_prev(hourly.select(hour), [], hour, [hour]).where(F.col("prev_" + hour).isNotNull())
    length = (F.timestamp_diff("HOUR", F.col("prev_" + hour), F.col(hour)) - 1).cast("bigint")
    gaps = gaps.select(F.col("prev_" + hour).alias("_before"), length.alias("_n")).where(F.col("_n") > 0)
    strides = materialize(gaps.select("_before", "_n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"), F.lit(STRIDE_HOURS).cast("bigint"))).alias("_lo")))
    last = F.least(F.col("_lo") + F.lit(STRIDE_HOURS - 1), F.col("_n"))
    dealt = strides.repartition(strides.count() // STRIDES_PER_TASK + 1, "_before", "_lo")      # a given number: small rows that grow
    return dealt.select("_before", F.explode(F.sequence(F.col("_lo"), last)).alias("_i"))\
        .select(F.timestamp_add("HOUR", F.col("_i"), F.col("_before")).alias(hour))


def hourly_resample(df: DataFrame, column: str = "cpu_usage", ts: str = "timestamp") -> DataFrame:
    """Mean of ``column`` per clock hour over all servers, with every hour
    between the first and last one present (empty hours -> NULL)."""
    hourly = materialize(df.where(F.col(ts).isNotNull())
                         .groupBy(F.date_trunc("hour", F.col(ts)).alias("hour"))
                         .agg(np_round(F.avg(column), 6).alias(f"{column}_mean")))      # a row per hour with rows
    return hourly.unionByName(missing_hours(hourly), allowMissingColumns=True)


def forecast_load(df: DataFrame, hours: int = 6, window: int = 3, column: str = "cpu_usage",
                  ts: str = "timestamp") -> DataFrame:
    """Trailing ``window``-hour mean of the hourly means, for the last
    ``hours`` observed hours (stamped with those hours).  A mean is NULL
    unless all ``window`` hours have a value.  Only the last
    ``hours + window - 1`` hours are materialised."""
    span = hours + window - 1
    day = F.col(ts)
    bounds = df.agg(F.date_trunc("hour", F.min(day)).alias("_lo"), F.date_trunc("hour", F.max(day)).alias("_hi")).where(F.col("_hi").isNotNull())
    start = F.greatest(F.col("_lo"), F.col("_hi") - F.make_dt_interval(hours=F.lit(span - 1)))
    # only the rows of the last hours are aggregated (``bounds`` is one row)
    recent = df.where(day.isNotNull()).join(F.broadcast(bounds.select(start.alias("_start"))), day >= F.col("_start"))
    hourly = recent.groupBy(F.date_trunc("hour", day).alias("hour")).agg(F.avg(column).alias("_m"))
    spine = bounds.select(F.explode(F.sequence(start, F.col("_hi"), F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    # <= hours + window - 1 rows: a single ordered window is fine here
    w = Window.orderBy("hour").rowsBetween(-(window - 1), 0)
    tail = (spine.join(hourly, "hour", "left")
                 .withColumn("_cnt", F.count("_m").over(w))
                 .withColumn("_avg", F.avg("_m").over(w))
                 .withColumn("_pos", F.row_number().over(Window.orderBy(F.desc("hour")))))
    return (tail.where(F.col("_pos") <= hours)
                .select("hour", F.when(F.col("_cnt") == window, np_round("_avg", 6)).alias("forecast")))


def interval_stats(df: DataFrame, keys: Sequence[str] = ("server_id",), ts: str = "timestamp") -> DataFrame:
    """Per group: rows ``n``, first/last time, and the modal difference in
    microseconds between consecutive rows (ties -> smallest); ``mode_us`` is
    NULL for fewer than two rows."""
    keys = list(keys)
    d = df.where(F.col(ts).isNotNull() & (F.lit(True) if not keys else F.col(keys[0]).isNotNull()))
    # distinct times with multiplicity, written once: every branch below reads it
    per_ts = materialize(d.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("_c")))
    base = per_ts.groupBy(*keys).agg(F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("n"),
                                     F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
                                     F.sum(F.col("_c") - 1).alias("_zeros"))
    # c copies of one time are c - 1 zero differences
    zeros = (base.where(F.col("_zeros") > 0)
                 .select(*keys, F.lit(0).cast("bigint").alias("diff_us"), F.col("_zeros").alias("_cnt")))
    steps = (with_prev(per_ts.select(*keys, ts), keys, ts, [ts], checkpoint=False)
             .where(F.col("prev_" + ts).isNotNull())
             .select(*keys, F.timestamp_diff("MICROSECOND", F.col("prev_" + ts), F.col(ts)).alias("diff_us"))
             .groupBy(*keys, "diff_us").agg(F.count(F.lit(1)).alias("_cnt")))
    diffs = steps.unionByName(zeros.select(*keys, "diff_us", "_cnt"))
    mode = diffs.groupBy(*keys).agg(
        F.min_by("diff_us", F.struct(-F.col("_cnt"), F.col("diff_us"))).alias("mode_us"))
    base = base.drop("_zeros")
    return base.join(mode, keys, "left") if keys else base.crossJoin(mode)


def modal_interval(df: DataFrame, keys: Sequence[str] = ("server_id",), ts: str = "timestamp") -> DataFrame:
    """Most frequent sampling interval per group, in seconds."""
    s = interval_stats(df, keys, ts)
    return s.select(*keys, (F.col("mode_us") / 1_000_000).alias("mode_seconds"))


def _completeness(stats: DataFrame, keys: list[str]) -> DataFrame:
    span_us = F.timestamp_diff("MICROSECOND", F.col("first_ts"), F.col("last_ts"))
    expected = (F.when(F.col("n") < 2, F.col("n"))
                 .when(F.col("mode_us").isNull() | (F.col("mode_us") <= 0), F.col("n"))
                 .otherwise(F.floor(span_us / F.col("mode_us") + 1)).cast("bigint"))
    return stats.select(*keys, expected.alias("expected"), F.col("n").alias("actual"))\
        .withColumn("completeness_pct",
                    F.when(F.col("expected") > 0, np_round(F.col("actual") / F.col("expected") * 100, 2))
                     .otherwise(F.lit(0.0)))


def completeness_by_server(df: DataFrame, key: str = "server_id", ts: str = "timestamp") -> DataFrame:
    """Expected vs actual rows per server: expected = span / modal interval + 1."""
    return _completeness(interval_stats(df, [key], ts), [key])


def completeness_total(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """The same over all rows pooled (servers sharing timestamps make the modal
    interval 0, and then expected = actual)."""
    return _completeness(interval_stats(df, [], ts), [])
