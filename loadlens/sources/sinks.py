"""Sinks and table management: CSV / Parquet / JSON writers, compaction,
catalog tables with full-replace loads, storage footprint per format."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.schemas import ACCESS_LOGS, METRICS
from loadlens.session import remove_folder

CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    (df.write.mode(mode).option("header", True).option("timestampNTZFormat", CSV_TIMESTAMP)
       .option("timestampFormat", CSV_TIMESTAMP).csv(path))


def write_parquet(df: DataFrame, path: str, compression: str = "snappy", mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """``(path, length)`` of the data files below ``path``, from the listing
    alone: no file is opened."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")


def folder_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Total size and number of the data files below ``path`` (one row)."""
    return _listed(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("bytes"), F.count(F.lit(1)).alias("files"))


@contextmanager
def _packed_reads(spark: SparkSession, size: int) -> Iterator[None]:
    """Scans whose tasks hold about ``size`` bytes of file each: Spark packs the
    splits of all files, largest first, and cuts larger files at row groups."""
    conf = {"spark.sql.files.maxPartitionBytes": f"{size}b", "spark.sql.files.openCostInBytes": "0b", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def compact(spark: SparkSession, src: str, dest: str, target_file_mb: float = 128,
            compression: str = "snappy", growth: float = 1.0) -> DataFrame:
    """Rewrite a multi-file Parquet dataset as files of about ``target_file_mb``,
    by size and without a shuffle.

    The listed bytes are divided evenly over the number of files nearest to the
    target, and each such share of the input is one task and one file: small files
    are packed together, a large one is cut between its row groups (one row group
    stays whole).  ``growth`` is the expected ratio of written to listed bytes, for
    another codec.  Every row is kept; an empty dataset gives one file without rows."""
    size = folder_bytes(spark, src).first()["bytes"]          # one aggregate row
    files = max(1, round(size * growth / (target_file_mb * 1024 * 1024)))
    for slack in range(0, 20, 2):           # percent: whole files and row groups leave room in a share
        with _packed_reads(spark, max(1, math.ceil(size / files * (1 + slack / 100)))):
            rows = spark.read.parquet(src)
            if slack < 18 and rows.rdd.getNumPartitions() > files:      # planned only
                continue
            write_parquet(rows, dest, compression)
            break
    return spark.read.parquet(dest)


GRANULARITY = {"server_metrics": "month", "access_logs": "day"}
LOOKUP = {"server_metrics": "server_id", "access_logs": "endpoint"}     # equality column: files are sorted by it
TABLE_SCHEMAS = {"server_metrics": METRICS, "access_logs": ACCESS_LOGS}


def create_tables(spark: SparkSession, location: str, database: str | None = None, suffix: str = "") -> dict[str, str]:
    """``server_metrics`` and ``access_logs`` as Parquet tables partitioned by
    month and day.  Returns their full names by kind."""
    prefix = f"{database}." if database else ""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = {}
    for kind, schema in TABLE_SCHEMAS.items():
        part = GRANULARITY[kind]
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields)
        names[kind] = f"{prefix}{kind}{suffix}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {names[kind]} ({cols}, `{part}` date) USING parquet "
                  f"PARTITIONED BY (`{part}`) LOCATION '{location.rstrip('/')}/{kind}'")
    return names


def _required(df: DataFrame, schema) -> DataFrame:
    """``df`` with the schema's columns in order; a NULL in one that must not be
    NULL fails the load."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"NULL in {f.name}")).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def load_table(df: DataFrame, name: str, kind: str) -> None:
    """Full replace of a table made by :func:`create_tables` (idempotent: loading
    the same input twice leaves one copy).  Partitions are registered, so
    ``spark.table(name)`` and :func:`loadlens.sources.tables.open_table` read the
    rows afterwards.  Files are sorted by the lookup column and time: a time index
    becomes partition pruning, an equality index row groups that are skipped."""
    part = GRANULARITY[kind]
    out = _required(df, TABLE_SCHEMAS[kind]).withColumn(part, F.to_date(F.date_trunc(part, "timestamp")))
    # one writer per partition value where possible; AQE's rebalance splits a
    # hot day into several tasks instead of giving it to one
    out.hint("rebalance", part).sortWithinPartitions(part, LOOKUP[kind], "timestamp").write.mode("overwrite").insertInto(name)


SHARES = 8                          # parts at most in which the first copy is written in the other formats
SHARE_BYTES = 32 * 1024 * 1024      # of the first copy in a part at least


def _shares(spark: SparkSession, path: str) -> list[list[str]]:
    """The data files below ``path`` in groups of about equal bytes (whole files)."""
    files = _listed(spark, path).orderBy("path").collect()          # one row per file
    size = sum(f.length for f in files)
    n, groups, before = min(SHARES, max(1, size // SHARE_BYTES)), {}, 0
    for f in files:
        groups.setdefault(before * n // max(1, size), []).append(f.path)
        before += f.length
    return list(groups.values())


def storage_footprint(df: DataFrame, base: str) -> DataFrame:
    """Write ``df`` as CSV, Parquet-snappy, Parquet-gzip and JSON and report
    ``(format, rows, bytes, size_mb, ratio)``: rows read back, and the CSV size
    over this size.  The source is read once; the other formats are written
    from the first Parquet copy.

    All rows are written and read back in every format, but the copies do not lie
    side by side: the text ones are many times the input.  The first copy is gone
    through share by share, and what a share takes in one format is weighed, read
    back and removed before the next is written.  No copy is left at the end."""
    spark = df.sparkSession
    at = lambda name: f"{base.rstrip('/')}/{name}"
    write_parquet(df, at("parquet_snappy"), "snappy")
    schema = spark.read.parquet(at("parquet_snappy")).schema
    formats = {"csv": (write_csv, spark.read.schema(schema).option("header", True).option("timestampNTZFormat", CSV_TIMESTAMP).csv),
               "parquet_snappy": (None, spark.read.parquet),
               "parquet_gzip": (lambda part, path: write_parquet(part, path, "gzip"), spark.read.parquet),
               "json": (write_json, spark.read.schema(schema).json)}
    found = {name: [0, 0] for name in formats}

    def weigh(name):
        rows = formats[name][1](at(name)).agg(F.count(F.lit(1)).alias("rows"))
        s = rows.crossJoin(folder_bytes(spark, at(name)).select("bytes")).first()       # one row each
        found[name] = [found[name][0] + s["rows"], found[name][1] + s["bytes"]]
        remove_folder(spark, at(name))

    for share in _shares(spark, at("parquet_snappy")):
        part = spark.read.schema(schema).parquet(*share)
        for name, (write, _) in formats.items():
            if write:
                write(part, at(name))
                weigh(name)
    weigh("parquet_snappy")
    sizes = spark.createDataFrame([(name, *v) for name, v in found.items()], "format string, rows bigint, bytes bigint")
    return sizes.select(
        "format", "rows", "bytes", F.round(F.col("bytes") / (1024 * 1024), 2).alias("size_mb"),
        F.when(F.col("bytes") > 0, F.round(F.lit(found["csv"][1]) / F.col("bytes"), 2)).otherwise(F.lit(0.0)).alias("ratio"))
