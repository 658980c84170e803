"""Reads of loaded tables that open only the files a time range needs.

A table of :func:`loadlens.sources.sinks.create_tables` is partitioned by the day
or month of its timestamp.  :func:`open_table` marks that column in the schema, so
that filters on the timestamp also bound the partition (static pruning) and joins
with time windows are made on it (dynamic pruning).  Files are sorted by the
table's lookup column, so equality on it skips row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.operators.filters import partition_columns, truncated
from loadlens.schemas import TRUNCATES, UNIT
from loadlens.session import scratch_dir
from loadlens.sources.sinks import GRANULARITY

MAX_BROADCAST_WINDOWS = 100_000     # windows (two times and a date each) broadcast at most


def open_table(spark: SparkSession, name: str) -> DataFrame:
    """A loaded table with its partition column, marked as the truncated timestamp."""
    df = spark.table(name)
    parts = {c.name for c in spark.catalog.listColumns(name) if c.isPartition} & set(GRANULARITY.values())
    return df.select(*[F.col(c).alias(c, metadata={TRUNCATES: "timestamp", UNIT: c}) if c in parts else F.col(c) for c in df.columns])


def data_columns(df: DataFrame) -> DataFrame:
    """``df`` without the marked partition columns."""
    return df.drop(*[name for name, _ in partition_columns(df)])


def rows_in_windows(df: DataFrame, windows: DataFrame, start: str = "start", end: str = "end", column: str = "timestamp") -> DataFrame:
    """Rows of ``df`` within the half-open time windows of ``windows(start, end,
    ...)``: a row for each window it lies in, with the window's columns.

    A window is dealt to the days (or months) it touches and joined on them, so a
    partitioned table is read only there.  Windows are written and counted first:
    few are broadcast, and the same broadcast prunes the partitions; more are
    joined.  Rows without a time and windows with a missing or reversed end give
    nothing."""
    marked = dict(partition_columns(df, column))
    part, unit = next(iter(marked.items()), (None, "day"))
    key = F.col(part) if part else truncated(F.col(column), unit)
    step = F.expr(f"INTERVAL 1 {unit.upper()}")
    last = truncated(F.col(end) - F.expr("INTERVAL 1 MICROSECOND"), unit)
    path = scratch_dir(df.sparkSession, "windows")
    windows.where(F.col(start) < F.col(end)).withColumn("_part", F.explode(F.sequence(truncated(F.col(start), unit), last, step))).write.parquet(path)
    # read with a filter, without which the planner sees no use in pruning by this side
    spread = df.sparkSession.read.parquet(path).where(F.col(start) < F.col(end))
    small = spread.count() <= MAX_BROADCAST_WINDOWS
    inside = (key == F.col("_part")) & (F.col(column) >= F.col(start)) & (F.col(column) < F.col(end))
    return df.join(F.broadcast(spread) if small else spread, inside).drop("_part")
