"""Projections, filters and predicates (threshold alerts, range queries,
data-quality validation).  Thresholds are strict, date bounds inclusive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.schemas import TRUNCATES, UNIT

# Default alert thresholds of the reference configuration (fixed values).
CPU_THRESHOLD = 90.0
MEMORY_THRESHOLD = 85.0
ERROR_RATE_THRESHOLD = 5.0
RESPONSE_TIME_THRESHOLD = 500.0


def _preview(df: DataFrame, preview: int | None, order: Sequence[str]) -> DataFrame:
    # The reference prints the first rows of a hit list; the full list is the
    # result, a preview is opt-in and totally ordered so it is deterministic.
    return df.orderBy(*order).limit(preview) if preview else df


def partition_columns(df: DataFrame, column: str = "timestamp") -> list[tuple[str, str]]:
    """Partition columns of a loaded table that truncate ``column``: ``(name, unit)``."""
    return [(f.name, f.metadata[UNIT]) for f in df.schema.fields if f.metadata.get(TRUNCATES) == column]


def truncated(time: Column, unit: str) -> Column:
    """The date that a partition column of ``unit`` holds for a time."""
    return F.to_date(F.date_trunc(unit, time))


def time_range(df: DataFrame, start: Column | None = None, end: Column | None = None, column: str = "timestamp") -> Column:
    """``start <= column <= end`` (each if given).  On a loaded table the partition
    column is bounded too, so files outside the range are not opened."""
    cond = F.lit(True)
    parts = partition_columns(df, column)
    if start is not None:
        cond = cond & (F.col(column) >= start)
        for name, unit in parts:
            cond = cond & (F.col(name) >= truncated(start, unit))
    if end is not None:
        cond = cond & (F.col(column) <= end)
        for name, unit in parts:
            cond = cond & (F.col(name) <= truncated(end, unit))
    return cond


def _time(value) -> Column | None:
    return F.lit(value).cast("timestamp_ntz") if value else None


def metrics_filter(df: DataFrame, server_id: str | None = None, start=None, end=None,
                   ordered: bool = True) -> DataFrame:
    """Optional server / inclusive time-range filter, ordered by time.
    Unset (or falsy) arguments are not applied."""
    cond = time_range(df, _time(start), _time(end))
    if server_id:
        cond = cond & (F.col("server_id") == F.lit(server_id))
    out = df.where(cond)
    return out.orderBy("timestamp", "server_id") if ordered else out


def cpu_peaks(df: DataFrame, threshold: float = CPU_THRESHOLD, preview: int | None = None) -> DataFrame:
    out = df.where(F.col("cpu_usage") > F.lit(threshold)).select("timestamp", "server_id", "cpu_usage")
    return _preview(out, preview, ["timestamp", "server_id", "cpu_usage"])


def error_peaks(df: DataFrame, threshold: float = ERROR_RATE_THRESHOLD,
                preview: int | None = None) -> DataFrame:
    out = df.where(F.col("error_rate") > F.lit(threshold))\
        .select("timestamp", "server_id", "error_rate", "cpu_usage")
    return _preview(out, preview, ["timestamp", "server_id", "error_rate"])


def memory_peaks(df: DataFrame, threshold: float = MEMORY_THRESHOLD,
                 preview: int | None = None) -> DataFrame:
    out = df.where(F.col("memory_usage") > F.lit(threshold))\
        .select("timestamp", "server_id", "memory_usage")
    return _preview(out, preview, ["timestamp", "server_id", "memory_usage"])


def slow_requests(logs: DataFrame, threshold: float = RESPONSE_TIME_THRESHOLD) -> DataFrame:
    return logs.where(F.col("response_time_ms") > F.lit(threshold))


def is_error(code: Column | str = "response_code") -> Column:
    """HTTP error predicate; a NULL code is not an error."""
    code = F.col(code) if isinstance(code, str) else code
    return F.coalesce(code >= F.lit(400), F.lit(False))


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with NULL or NaN in any of ``subset``."""
    cond = F.lit(True)
    for c in subset:
        col = F.col(c)
        t = df.schema[c].dataType.typeName()
        ok = col.isNotNull() & (~F.isnan(col) if t in ("double", "float") else F.lit(True))
        cond = cond & ok
    return df.where(cond)


def retention(df: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Keep the last ``days`` days before ``as_of`` (inclusive).  On a loaded table
    (:func:`loadlens.sources.tables.open_table`) this is a partition filter as well."""
    return df.where(time_range(df, _time(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")))


def validate(df: DataFrame, required_columns: Sequence[str] | None = None,
             check_null: bool = True) -> DataFrame:
    """Data-quality validation as rows ``(check, severity, column, value)``.

    * a missing required column -> ``error`` (the frame is invalid; value 0);
    * an empty frame -> ``warning``;
    * NULL counts for columns with at least one NULL -> ``warning`` (skipped
      on an empty frame);
    * a final ``is_valid`` row (value 1/0).
    The counts come from one aggregation pass over the data.
    """
    spark = df.sparkSession
    missing = [c for c in (required_columns or []) if c not in df.columns]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    if check_null:
        aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null_{i}")
                 for i, c in enumerate(df.columns)]
    stats = df.agg(*aggs)
    rows = [F.struct(F.lit("missing_column").alias("check"), F.lit("error").alias("severity"),
                     F.lit(c).alias("column"), F.lit(0).cast("bigint").alias("value"))
            for c in missing]
    rows.append(F.when(F.col("_rows") == 0, F.struct(
        F.lit("empty").alias("check"), F.lit("warning").alias("severity"),
        F.lit(None).cast("string").alias("column"), F.lit(0).cast("bigint").alias("value"))))
    if check_null:
        for i, c in enumerate(df.columns):
            rows.append(F.when((F.col("_rows") > 0) & (F.col(f"_null_{i}") > 0), F.struct(
                F.lit("null_values").alias("check"), F.lit("warning").alias("severity"),
                F.lit(c).alias("column"), F.col(f"_null_{i}").cast("bigint").alias("value"))))
    rows.append(F.struct(F.lit("is_valid").alias("check"), F.lit("info").alias("severity"),
                         F.lit(None).cast("string").alias("column"),
                         F.lit(0 if missing else 1).cast("bigint").alias("value")))
    return (stats.select(F.explode(F.array_compact(F.array(*rows))).alias("r"))
                 .select("r.*"))
