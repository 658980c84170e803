"""Structured Streaming: alerts and hourly windows against the batch forms."""

import os
import shutil
import tempfile

from pyspark.sql import functions as F

from loadlens.sources.views import metrics_ev_from, metrics_ev_view, table
from loadlens.streaming import alerts as D

SF = "/root/testdata/sf0.001"


def stream(spark):
    schema = table(spark, SF, "events").schema
    return metrics_ev_from(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(SF))


def test_alerts_equal_batch(spark):
    got = D.run_alerts(spark, stream(spark))
    ref = D.alert_rows(metrics_ev_view(spark, SF))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_hourly_append_is_update_minus_open_windows(spark):
    whole = D.run_hourly(spark, stream(spark), mode="update")
    append = D.run_hourly(spark, stream(spark), mode="append")
    assert append.exceptAll(whole).count() == 0          # every emitted window is final and equal
    last = metrics_ev_view(spark, SF).agg(F.max("timestamp")).first()[0]
    missing = whole.exceptAll(append)
    # only windows that end after the watermark (max event time - 2 h) stay open
    assert missing.where(F.col("hour") < F.lit(last) - F.expr("INTERVAL 3 HOURS")).count() == 0
    batch = (metrics_ev_view(spark, SF).groupBy(F.date_trunc("hour", "timestamp").alias("hour"), "server_id")
             .agg(F.count(F.lit(1)).alias("events")))
    assert whole.count() == batch.count()


def test_rows_beyond_the_watermark_are_dropped(spark):
    folder, out, ckpt = (tempfile.mkdtemp(prefix="loadlens-late-") for _ in range(3))
    schema = "timestamp timestamp_ntz, server_id string, cpu_usage double"

    def feed(*rows):
        spark.createDataFrame([(r,) for r in rows], "t string").selectExpr("cast(t as timestamp_ntz) timestamp", "'s' server_id", "1.0D cpu_usage")\
            .coalesce(1).write.mode("append").parquet(folder)
        src = spark.readStream.schema(schema).parquet(folder)
        return {str(r["hour"]): r["events"] for r in D.run_hourly(spark, src, out, ckpt).collect()}
    assert feed("2024-01-01 10:05:00", "2024-01-01 10:50:00") == {"2024-01-01 10:00:00": 2}
    feed("2024-01-01 20:00:00")
    got = feed("2024-01-01 10:55:00", "2024-01-01 19:30:00")     # ten hours late, half an hour late
    assert got == {"2024-01-01 10:00:00": 2, "2024-01-01 20:00:00": 1, "2024-01-01 19:00:00": 1}


def test_fifty_batches_leave_few_folders(spark):
    folder, out, ckpt = (tempfile.mkdtemp(prefix="loadlens-epochs-") for _ in range(3))
    events = metrics_ev_view(spark, SF).select("timestamp", "server_id", "cpu_usage").where("timestamp < timestamp_ntz'2024-01-09'")
    # fifty files in time order, with hours that overlap between neighbours
    hour = F.timestamp_diff("HOUR", F.lit("2024-01-01").cast("timestamp_ntz"), F.col("timestamp"))
    shifted = events.withColumn("f", F.least(F.floor((hour + F.pmod(F.hash("timestamp"), F.lit(2))) / 4), F.lit(49)))
    for i in range(50):
        shifted.where(F.col("f") == i).drop("f").coalesce(1).write.parquet(f"{folder}/f{i:02d}")
    src = spark.readStream.schema("timestamp timestamp_ntz, server_id string, cpu_usage double").option("maxFilesPerTrigger", 1)\
        .option("recursiveFileLookup", "true").parquet(folder)
    got = D.run_hourly(spark, src, out, ckpt, watermark="12 hours")
    batch = events.groupBy(F.date_trunc("hour", "timestamp").alias("hour"), "server_id").agg(F.count(F.lit(1)).alias("events"))
    assert sorted(map(tuple, got.select("hour", "server_id", "events").collect())) == sorted(map(tuple, batch.collect()))
    names = sorted(os.listdir(out))
    epochs, bases = [n for n in names if n.startswith("epoch=")], [n for n in names if n.startswith("base=")]
    assert len(epochs) <= 2 * D.COMPACT_EVERY + 2 and len(bases) <= 2
    days = {r.day for r in spark.read.parquet(f"{out}/closed").select("day").distinct().collect()}
    assert len(days) >= 4
    # merging again, or after a merge that broke off before its base was complete, changes nothing
    before = sorted(map(tuple, D.read_hourly(spark, out).collect()))
    last = D._epoch_of(epochs[-1])
    D.compact_hourly(spark, out, last, "12 hours")
    shutil.rmtree(f"{out}/{sorted(n for n in os.listdir(out) if n.startswith('base='))[-1]}")
    assert sorted(map(tuple, D.read_hourly(spark, out).collect())) == before
    for _ in range(2):
        D.compact_hourly(spark, out, last, "12 hours")
        assert sorted(map(tuple, D.read_hourly(spark, out).collect())) == before
