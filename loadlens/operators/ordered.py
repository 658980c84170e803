"""Order statistics without a single-partition window.

``Window.orderBy(x)`` with no partition key plans ``Exchange SinglePartition``
and Spark's exact ``percentile`` merges one value->count map per group in a
single task; both put a whole table (or a hot group) into one task.  The
helpers here range-partition the rows by (group, value) into as many ranges as
the input needs, run the window per (group, range), and stitch the ranges
together with a table of their totals.  A hot group spans many ranges, small
groups share one; equal values always share a range, so results are exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.session import materialize

DEFAULT_ROWS_PER_RANGE = 1_000_000  # rows of a range; the number of ranges has no limit


def ranged(df: DataFrame, keys: Sequence[str], order: str,
           rows_per_range: int = DEFAULT_ROWS_PER_RANGE) -> DataFrame:
    """Rows with ``_bkt``, the number of their (keys, order) range, one range per
    ``rows_per_range`` rows.  ``_bkt`` grows with ``order`` within a group.  An
    input of one range takes no shuffle here."""
    ranges = math.ceil(df.count() / rows_per_range)
    if ranges <= 1:
        return df.withColumn("_bkt", F.lit(0))
    # the range number is the partition number, fixed by writing it
    return materialize(df.repartitionByRange(ranges, *keys, order).withColumn("_bkt", F.spark_partition_id()))


def _totals(t: DataFrame, keys: list[str], count_col: str) -> DataFrame:
    """Per (group, range): rows before the range (``_boff``), rows of the range,
    rows of the group (one row for each range of a group)."""
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("_bkt")
    return t.groupBy(*keys, "_bkt").agg(F.sum(count_col).alias("_btot")).select(
        *keys, "_bkt", "_btot",
        F.coalesce(F.sum("_btot").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_boff"),
        F.sum("_btot").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("group_n"))


def _cumulated(t: DataFrame, offsets: DataFrame, keys: list[str], order: str, count_col: str) -> DataFrame:
    local = Window.partitionBy(*keys, "_bkt").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (t.withColumn("_local", F.coalesce(F.sum(count_col).over(local), F.lit(0)))
             .join(offsets, keys + ["_bkt"])
             .withColumn("cum_before", (F.col("_boff") + F.col("_local")).cast("bigint"))
             .withColumn("group_n", F.col("group_n").cast("bigint"))
             .drop("_local", "_boff", "_btot", "_bkt"))


def with_cum_count(counts: DataFrame, keys: Sequence[str], order: str,
                   count_col: str = "cnt", checkpoint: bool = True,
                   rows_per_range: int = DEFAULT_ROWS_PER_RANGE) -> DataFrame:
    """For a table of distinct ``(keys, order)`` rows with a multiplicity
    ``count_col``, add ``cum_before`` (rows of the group strictly before this
    value) and ``group_n`` (rows of the group).  ``checkpoint`` writes the
    input first, as several branches read it."""
    keys = list(keys)
    t = ranged(materialize(counts) if checkpoint else counts, keys, order, rows_per_range)
    return _cumulated(t, _totals(t, keys, count_col), keys, order, count_col)


def with_prev(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str],
              prefix: str = "prev_", checkpoint: bool = True,
              rows_per_range: int = DEFAULT_ROWS_PER_RANGE) -> DataFrame:
    """Add ``prev_<c>`` = value of ``c`` on the previous row of the same group
    in ``order`` (the ``lag`` of a group-wide window).  Rows of equal ``order``
    follow each other by ``cols``, so the result does not depend on how the
    input is partitioned."""
    keys = list(keys)
    t = ranged(materialize(df) if checkpoint else df, keys, order, rows_per_range)
    by = [order, *[c for c in cols if c != order]]
    w = Window.partitionBy(*keys, "_bkt").orderBy(*by)
    t = t.withColumn("_rn", F.row_number().over(w))
    for c in cols:
        t = t.withColumn(f"_lag_{c}", F.lag(c).over(w))
    tails = t.groupBy(*keys, "_bkt").agg(F.max_by(F.struct(*cols), F.struct(*by)).alias("_last"))
    w_b = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("_bkt")
    tails = tails.select(*keys, "_bkt", F.lag("_last").over(w_b).alias("_prev_tail"))
    out = t.join(tails, keys + ["_bkt"], "left")
    for c in cols:
        out = out.withColumn(prefix + c, F.when(F.col("_rn") == 1, F.col("_prev_tail")[c])
                             .otherwise(F.col(f"_lag_{c}")))
    return out.drop("_rn", "_bkt", "_prev_tail", *[f"_lag_{c}" for c in cols])


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct ``(keys, value)`` with multiplicity ``cnt``; NULL values dropped.
    A partial (map-side) aggregation, so hot values cost one row each."""
    return (df.where(F.col(value).isNotNull())
              .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("cnt")))
