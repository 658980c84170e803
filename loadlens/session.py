"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "loadlens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes.

    * UTC session time zone: parsed access-log times and metric timestamps are
      wall-clock values, kept as TIMESTAMP_NTZ.
    * ANSI mode stays on (Spark 4 default); operators use ``try_*`` functions
      on anything that comes from data.
    * AQE with partition coalescing and skew-join splitting.
    * ``master`` and the number of shuffle partitions are left to the cluster's
      configuration unless given; without any configured master it is local.
    """
    builder = SparkSession.builder.appName(app_name)
    if master or not (SparkSession.getActiveSession() or SparkConf().get("spark.master", None)):
        builder = builder.master(master or "local[*]")
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("LOADLENS_DRIVER_MEMORY", "16g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A private temporary folder stands in only on a local master, where driver
    and executors are one process; on a cluster an unset folder is an error."""
    path = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError(f"{_CHECKPOINT_KEY} must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="loadlens-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/loadlens-work/{name}-{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a written folder in whichever store it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def materialize(df):
    """Write ``df`` once to the shared checkpoint folder and continue from the
    files (reliable checkpoint: cuts the lineage, survives executor loss).
    Used for intermediates that several branches of a plan read, so the
    source is scanned once; at most one row per distinct value of the input."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
