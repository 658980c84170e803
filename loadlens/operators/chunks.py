"""User functions applied chunk by chunk to a DataFrame.

``mapInPandas`` hands each executor task its partition as Arrow batches, which
are joined to chunks; results stream back as Arrow.  Frame results are concatenated, dict results become one row per
chunk.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


CHUNK_ROWS = 100_000  # rows handed to a user function at a time, at most


def chunk_apply(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame | dict],
                schema: T.StructType | str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Apply ``fn`` to every chunk of at most ``chunk_rows`` rows; ``schema``
    describes its output.  Arrow batches are joined up to the chunk size within
    a task, larger ones are cut."""
    def run(batches):
        held, n = [], 0

        def result():
            out = fn(pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True))
            return pd.DataFrame([out]) if isinstance(out, dict) else out
        for pdf in batches:
            while len(pdf):
                part, pdf = pdf.iloc[:chunk_rows - n], pdf.iloc[chunk_rows - n:]
                held.append(part)
                n += len(part)
                if n == chunk_rows:
                    yield result()
                    held, n = [], 0
        if held:
            yield result()
    return df.mapInPandas(run, schema)


def _summarise(chunk: pd.DataFrame) -> dict:
    mean = lambda c: float(chunk[c].mean()) if c in chunk and chunk[c].count() else 0.0
    return {"rows": len(chunk), "avg_cpu": mean("cpu_usage"),
            "max_response": float(chunk["response_time_ms"].max()) if "response_time_ms" in chunk and chunk["response_time_ms"].count() else 0.0}


def chunk_summaries(df: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Per-chunk ``rows, avg_cpu, max_response`` (0 when a column is absent).
    Chunk boundaries depend on the physical layout."""
    cols = [c for c in ("cpu_usage", "response_time_ms") if c in df.columns]
    return chunk_apply(df.select(*cols) if cols else df.select(F.lit(1).alias("_one")), _summarise,
                       "rows bigint, avg_cpu double, max_response double", chunk_rows)


def chunk_summary(df: DataFrame) -> DataFrame:
    """The same over the whole table, by Spark's own aggregates (an average of
    chunk averages is not the global average); 0 where a column is absent."""
    of = lambda fn, c: F.coalesce(fn(c), F.lit(0.0)) if c in df.columns else F.lit(0.0)
    return df.agg(F.count(F.lit(1)).alias("rows"), of(F.avg, "cpu_usage").alias("avg_cpu"), of(F.max, "response_time_ms").alias("max_response"))


def load_level(df: DataFrame) -> DataFrame:
    """Example per-chunk user function: a pandas ``cut`` of cpu into load
    levels, applied chunk by chunk."""
    schema = T.StructType(df.schema.fields + [T.StructField("load_level", T.StringType())])

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        lvl = pd.cut(pdf["cpu_usage"], bins=[-float("inf"), 30, 70, 90, float("inf")],
                     labels=["low", "normal", "high", "critical"], right=True)
        return pdf.assign(load_level=lvl.astype("object").where(pdf["cpu_usage"].notna(), None))
    return chunk_apply(df, fn, schema)
