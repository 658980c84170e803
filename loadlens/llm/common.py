"""Small helpers shared by the pipeline operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.session import ensure_checkpoint_dir, scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and continue from the
    files: cuts the lineage, keeps column pruning, survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small frame."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fold(doc_id: str | Column, k: int) -> Column:
    """crc32(doc_id as text) mod ``k``; a null id counts as the empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit(""))), F.lit(k))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (in any case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def parts_of(df: DataFrame) -> int:
    """Number of partitions Spark plans for reading ``df`` (no job runs)."""
    return max(1, df.rdd.getNumPartitions())


MAX_BROADCAST_ROWS = 20_000  # rows (of a few hundred bytes) broadcast at most


def join_small(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner", few: bool | None = None,
               most: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``rows`` with their group's figures.  The groups are counted (or known to be
    ``few``): up to ``most`` are broadcast, so that no hot group is dealt to one
    task; more are joined."""
    few = groups.count() <= most if few is None else few
    return rows.join(F.broadcast(groups) if few else groups, keys, how)


MAX_BROADCAST_KEYS = 1_000_000  # rows of a few numbers broadcast at most


def without(rows: DataFrame, gone: DataFrame, on: dict[str, str]) -> DataFrame:
    """``rows`` that match no row of ``gone`` (column of rows -> column of gone,
    nulls equal).  ``gone`` is counted: up to a bound it is broadcast, so the
    rows' texts are not shuffled."""
    cond = None
    for a, b in on.items():
        c = rows[a].eqNullSafe(gone[b])
        cond = c if cond is None else cond & c
    return rows.join(F.broadcast(gone) if gone.count() <= MAX_BROADCAST_KEYS else gone, cond, "left_anti")


def labelled(labels: DataFrame, column: str) -> DataFrame:
    """One row per labelled ``doc_id`` with ``y`` 0/1; repeated rows vote, ties
    count as 1, null labels and null ids are left out."""
    return (labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull())
            .groupBy(F.col("doc_id").alias("doc_id"))
            .agg((F.avg(F.col(column).cast("double")) >= 0.5).cast("int").alias("y")))


_ARROW_ROWS, _ARROW_BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 1 << 22  # bytes of an Arrow batch with whole texts (a longer text goes alone)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of ``rows`` rows and ``BATCH_BYTES`` for the actions run inside:
    with whole texts in them, the default of 10,000 rows is more than a task needs
    to hold, and long texts make a batch of few rows large."""
    most = {_ARROW_ROWS: rows, _ARROW_BYTES: BATCH_BYTES}
    before = {k: spark.conf.get(k) for k in most}
    for k, n in most.items():
        now = before[k].lower().removesuffix("b")
        spark.conf.set(k, str(min(n, int(now)) if now.isdigit() and int(now) > 0 else n))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


STEP_BYTES = 1 << 21   # text that a worker handles at a time


def text_steps(batch, column: int) -> Iterator:
    """Slices of an Arrow batch with about ``STEP_BYTES`` of text each (a longer
    text goes alone), so a worker's memory does not follow the batch size."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + STEP_BYTES, side="right")))
        yield batch.slice(at, end - at)
        at = end


STEP_ROWS = 200        # rows of nested lists that a worker holds as Python objects at a time


CHUNK_BYTES = 1 << 22  # longest piece of one text whose words are held at a time


def word_chunks(raw: bytes, size: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """Words (runs without ASCII white space) of a whole text, a bounded piece
    at a time; a piece never ends inside a word."""
    if len(raw) <= size:
        yield raw.split()
        return
    at, n = 0, len(raw)
    while at < n:
        end = min(at + size, n)
        while end < n and raw[end:end + 1] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield raw[at:end].split()
        at = end
