"""Outlier detection: z-score and IQR rules over the metric columns.

The per-column statistics are one aggregate row (a fixed number of values),
attached to every data row with a broadcast; the test is one OR-ed predicate
per row, and the result is the set of distinct full rows that break any
column's rule (the union-distinct of the per-column hits).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.operators.quantiles import exact_quantiles
from loadlens.schemas import METRIC_COLUMNS


def anomalies_zscore(df: DataFrame, threshold: float = 3.0,
                     columns: Sequence[str] = METRIC_COLUMNS) -> DataFrame:
    """Rows with ``|x - mean| / std > threshold`` in any column (sample std;
    a zero or NULL std flags nothing).  Absent columns are skipped."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df.limit(0)
    stats = df.agg(*[F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)],
                   *[F.stddev_samp(c).alias(f"_s{i}") for i, c in enumerate(cols)])
    hit = F.lit(False)
    for i, c in enumerate(cols):
        z = F.abs(F.try_divide(F.col(c) - F.col(f"_m{i}"), F.col(f"_s{i}")))
        hit = hit | F.coalesce(z > F.lit(threshold), F.lit(False))
    return df.crossJoin(F.broadcast(stats)).where(hit).select(*df.columns).distinct()


def _quartiles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return exact_quantiles(df, cols, [0.25, 0.75], ["q1", "q3"])        # one row


def iqr_fences(df: DataFrame, columns: Sequence[str] = METRIC_COLUMNS, k: float = 1.5) -> DataFrame:
    """Exact (linear) quartiles and Tukey fences per column with a value, long form
    ``(column, q1, q3, iqr, lower, upper)``; all columns share their passes."""
    cols = [c for c in columns if c in df.columns]
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"{c}_q1").alias("q1"), F.col(f"{c}_q3").alias("q3")) for c in cols]
    q = _quartiles(df, cols).select(F.explode(F.array(*entries)).alias("e")).select("e.*").where(F.col("q1").isNotNull())
    return q.select("column", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"))\
        .withColumn("lower", F.col("q1") - F.lit(k) * F.col("iqr"))\
        .withColumn("upper", F.col("q3") + F.lit(k) * F.col("iqr"))


def anomalies_iqr(df: DataFrame, columns: Sequence[str] = METRIC_COLUMNS, k: float = 1.5) -> DataFrame:
    """Rows outside ``[q1 - 1.5 iqr, q3 + 1.5 iqr]`` (strict) in any column."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df.limit(0)
    bounds, hit = [], F.lit(False)
    for i, c in enumerate(cols):
        q1, q3 = F.col(f"{c}_q1"), F.col(f"{c}_q3")
        bounds += [(q1 - F.lit(k) * (q3 - q1)).alias(f"_lo{i}"), (q3 + F.lit(k) * (q3 - q1)).alias(f"_hi{i}")]
        hit = hit | F.coalesce((F.col(c) < F.col(f"_lo{i}")) | (F.col(c) > F.col(f"_hi{i}")), F.lit(False))
    fences = _quartiles(df, cols).select(*bounds)       # one row with two values per column
    return df.crossJoin(F.broadcast(fences)).where(hit).select(*df.columns).distinct()


def detect_anomalies(df: DataFrame, method: str = "zscore", threshold: float = 3.0) -> DataFrame:
    """Dispatch by method; an unknown method gives an empty result."""
    if method == "zscore":
        return anomalies_zscore(df, threshold)
    if method == "iqr":
        return anomalies_iqr(df)
    return df.limit(0)
