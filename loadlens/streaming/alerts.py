"""Structured Streaming forms of the threshold alerts and the hourly load
profile.

Both take a *streaming* metrics frame (e.g. ``readStream`` over a folder of
Parquet files), write through a checkpointed sink, and can be drained with an
``availableNow`` trigger so a bounded input is processed completely.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions.numeric import np_round
from loadlens.operators.filters import CPU_THRESHOLD, ERROR_RATE_THRESHOLD, RESPONSE_TIME_THRESHOLD
from loadlens.session import remove_folder, scratch_dir


def alert_rows(metrics: DataFrame, cpu: float = CPU_THRESHOLD, error_rate: float = ERROR_RATE_THRESHOLD,
               response_ms: float = RESPONSE_TIME_THRESHOLD) -> DataFrame:
    """Stateless alert rule set: one row per (event, fired rule)."""
    rules = F.array_compact(F.array(
        F.when(F.col("cpu_usage") > cpu, F.struct(F.lit("cpu").alias("rule"), F.col("cpu_usage").alias("value"))),
        F.when(F.col("error_rate") > error_rate,
               F.struct(F.lit("error_rate").alias("rule"), F.col("error_rate").alias("value"))),
        F.when(F.col("response_time_ms") > response_ms,
               F.struct(F.lit("response_time").alias("rule"), F.col("response_time_ms").alias("value")))))
    return metrics.select("timestamp", "server_id", F.explode(rules).alias("r"))\
        .select("timestamp", "server_id", "r.rule", "r.value")


def hourly_load(metrics: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """Event-time hourly windows per server with a watermark for late data."""
    ts = F.col("timestamp").cast("timestamp")       # windows need an event-time TIMESTAMP
    return (metrics.withColumn("_ts", ts).withWatermark("_ts", watermark)
                   .groupBy(F.window("_ts", "1 hour").alias("w"), "server_id")
                   .agg(F.count(F.lit(1)).alias("events"), F.avg("cpu_usage").alias("cpu_usage_mean"),
                        F.max("cpu_usage").alias("cpu_usage_max")))


def run_alerts(spark: SparkSession, stream: DataFrame, out: str | None = None,
               checkpoint: str | None = None) -> DataFrame:
    """Append alert rows to a Parquet folder (exactly-once via the file
    sink's log + checkpoint), drain the available input, read the result."""
    out = out or scratch_dir(spark, "alerts-out")
    checkpoint = checkpoint or scratch_dir(spark, "alerts-ckpt")
    q = (alert_rows(stream).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


_VALUES = ["events", "cpu_usage_mean", "cpu_usage_max"]
COMPACT_EVERY = 8       # epochs between two merges of the hourly output


def _folders(spark: SparkSession, path: str, prefix: str, complete: bool = True) -> list[str]:
    """Names of the (complete: with ``_SUCCESS``) sub-folders ``prefix...``, in order."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    if not fs.exists(at):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(at) if f.isDirectory() and f.getPath().getName().startswith(prefix)]
    return sorted(n for n in names if not complete or fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS")))


def _epoch_of(folder: str) -> int:
    return int(folder.split("=")[1].split("_")[0])


def _recent(spark: SparkSession, out: str, base: str | None, upto: int | None = None) -> DataFrame | None:
    """The latest values of every window in ``base`` and the epochs after it."""
    after = _epoch_of(base) if base else -1
    epochs = [f for f in _folders(spark, out, "epoch=") if after < _epoch_of(f) <= (upto if upto is not None else _epoch_of(f))]
    parts = [spark.read.parquet(f"{out}/{base}")] if base else []
    if epochs:
        parts.append(spark.read.parquet(*[f"{out}/{f}" for f in epochs]))
    if not parts:
        return None
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    latest = rows.groupBy("hour", "server_id").agg(F.max_by(F.struct(*_VALUES), "epoch").alias("v"), F.max("epoch").alias("epoch"))
    return latest.select("hour", "server_id", "v.*", "epoch")


def compact_hourly(spark: SparkSession, out: str, upto: int, watermark: str = "2 hours") -> None:
    """Merge the epochs up to ``upto`` into a new base; windows of days that the
    watermark has passed move to ``closed/day=...``, which no later merge touches.

    A step that is repeated writes the same again: closed days are whole when first
    written, and the new base counts from its ``_SUCCESS`` on, named after the last
    epoch merged and the first day still open.  What the base before it had merged
    is removed only now, a merge later, so readers that started on it can end."""
    bases = _folders(spark, out, "base=")
    bases = [b for b in bases if _epoch_of(b) < upto]
    before = bases[-1] if bases else None
    rows = _recent(spark, out, before, upto)
    if rows is None:
        return
    # no row older than the greatest event time less the delay is let in any more
    bound = rows.agg(F.to_date(F.max("hour") - F.expr(f"INTERVAL {watermark}")).cast("string").alias("d")).first()["d"]
    if before and bound is not None:
        bound = max(bound, before.split("_")[1])
    if bound is None:
        return
    day = F.to_date("hour")
    rows.where(day < F.lit(bound).cast("date")).withColumn("day", day).repartition("day").write.mode("overwrite")\
        .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{out}/closed")
    rows.where(day >= F.lit(bound).cast("date")).coalesce(1).write.mode("overwrite").parquet(f"{out}/base={upto:012d}_{bound}")
    for old in bases[:-1]:
        remove_folder(spark, f"{out}/{old}")
    if before:
        for f in _folders(spark, out, "epoch="):
            if _epoch_of(f) <= _epoch_of(before):
                remove_folder(spark, f"{out}/{f}")


def read_hourly(spark: SparkSession, out: str) -> DataFrame:
    """Every hourly window as last written: closed days as they are (pruned by day),
    and the latest epoch of the windows that are still open."""
    bases = _folders(spark, out, "base=")
    base = bases[-1] if bases else None
    recent = _recent(spark, out, base).select("hour", "server_id", *_VALUES)
    if base is None or not _folders(spark, f"{out}/closed", "day=", complete=False):
        return recent
    closed = spark.read.parquet(f"{out}/closed").where(F.col("day") < F.lit(base.split("_")[1]).cast("date"))
    return closed.select("hour", "server_id", *_VALUES).unionByName(recent)


def run_hourly(spark: SparkSession, stream: DataFrame, out: str | None = None,
               checkpoint: str | None = None, mode: str = "update",
               watermark: str = "2 hours", compact_every: int = COMPACT_EVERY) -> DataFrame:
    """Hourly windows per server.

    * ``mode="update"``: each micro-batch writes the windows it changed as its own
      epoch; the result is the latest epoch of every window, including those still
      open.  The watermark drops the state of closed windows, and rows that come
      later than it allows.  Every ``compact_every`` epochs are merged
      (:func:`compact_hourly`).
    * ``mode="append"``: each window is appended once, when the watermark passes
      its end; windows still open at the end are not in the result.
    """
    out = out or scratch_dir(spark, "hourly-out")
    checkpoint = checkpoint or scratch_dir(spark, "hourly-ckpt")
    shaped = lambda df: df.select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "server_id", "events",
                                  np_round("cpu_usage_mean", 6).alias("cpu_usage_mean"), "cpu_usage_max")
    if mode == "append":
        q = (shaped(hourly_load(stream, watermark)).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).outputMode("append")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return spark.read.parquet(out)

    def sink(batch: DataFrame, epoch: int) -> None:
        rows = shaped(batch).withColumn("epoch", F.lit(epoch).cast("bigint"))
        rows.write.mode("overwrite").parquet(f"{out}/epoch={epoch:012d}")       # a retried epoch replaces itself
        if (epoch + 1) % compact_every == 0:
            compact_hourly(batch.sparkSession, out, epoch, watermark)

    q = (hourly_load(stream, watermark).writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return read_hourly(spark, out)
