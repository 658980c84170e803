"""Batch sources: metrics / access-log CSV, raw access-log text, Parquet,
host-agent files, multi-source union.  Schemas are explicit, never inferred."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions.logparse import parse_access_log, parse_errors
from loadlens.functions.numeric import normalize_nans
from loadlens.schemas import ACCESS_LOGS, HOST_METRICS, METRICS
from loadlens.session import materialize

#: Names that host agents also use, in lower case.
HOST_ALIASES = {"host": "server_id", "hostname": "server_id", "time": "timestamp", "cpu": "cpu_usage", "memory": "memory_usage", "load1": "load_average"}
_CSV_TS = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def _csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("nullValue", "")
            .option("timestampNTZFormat", _CSV_TS).option("mode", "PERMISSIVE").csv(path))


_RECORD, _FILE = "_record", "_file"
MAX_BROADCAST_FILES = 20_000        # files (a path and a header each) broadcast at most
_TIME_CELL = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,6})?$"


def _cell(name: str, kind: T.DataType) -> Column:
    """A CSV cell as its column's type; NULL where it is none."""
    text = F.col(name)
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return F.when(text.rlike(_TIME_CELL), text.try_cast(kind))
    return text.try_cast(kind)


def _checked(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Cells as text with ``_reasons``, the faults of each record (none: empty)."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(_RECORD, T.StringType())])
    # every column is parsed whatever is selected, or a wrong number of cells would go unseen
    raw = (spark.read.schema(text).option("header", True).option("nullValue", "").option("columnPruning", False)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RECORD).csv(path)
           .select("*", F.col("_metadata.file_path").alias(_FILE)))
    faults = [F.when(F.col(_RECORD).isNotNull(), F.lit("wrong number of cells"))]
    for f in schema.fields:
        if not f.nullable:
            faults.append(F.when(F.col(f.name).isNull(), F.lit(f"no {f.name}")))
        if not isinstance(f.dataType, T.StringType):
            faults.append(F.when(F.col(f.name).isNotNull() & _cell(f.name, f.dataType).isNull(), F.lit(f"bad {f.name}")))
    return raw.withColumn("_reasons", F.array_compact(F.array(*faults)))


def read_csv_rows(spark: SparkSession, path: str | list[str], schema: T.StructType, file_column: str | None = None) -> DataFrame:
    """Typed rows of the records without a fault, NaN cells as NULL; with the file
    they came from in ``file_column`` if named."""
    rows = _checked(spark, path, schema).where(F.size("_reasons") == 0)
    out = [_cell(f.name, f.dataType).alias(f.name) for f in schema.fields]
    return normalize_nans(rows.select(*out, *([F.col(_FILE).alias(file_column)] if file_column else [])))


def read_csv_errors(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """The other records: ``file_path, record, reason``.  A record is rejected if it
    has too few or too many cells, a cell that is not of its column's type, or no
    value where the schema needs one; all its faults are named."""
    rows = _checked(spark, path, schema).where(F.size("_reasons") > 0)
    record = F.coalesce(F.col(_RECORD), F.to_csv(F.struct(*[F.col(f.name) for f in schema.fields])))
    return rows.select(F.col(_FILE).alias("file_path"), record.alias("record"), F.concat_ws(", ", "_reasons").alias("reason"))


def read_metrics_csv(spark: SparkSession, path: str) -> DataFrame:
    """``server_metrics`` CSV (header; extra columns such as ``id`` are not
    expected).  NaN cells become NULL; records with a fault are left to
    :func:`read_csv_errors`."""
    return read_csv_rows(spark, path, METRICS)


def read_access_logs_csv(spark: SparkSession, path: str) -> DataFrame:
    """Parsed ``access_logs`` CSV; an empty referer reads back as NULL, and records
    with a fault are left to :func:`read_csv_errors`."""
    return read_csv_rows(spark, path, ACCESS_LOGS)


def read_host_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Host-agent files (``real_metrics_<server>_<ts>.csv``) of any column order,
    with the file each row came from and its time."""
    return read_files(spark, path, HOST_METRICS, HOST_ALIASES)


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    m = "_metadata."
    return spark.read.text(path).select("value", F.col(m + "file_path").alias(_FILE), F.col(m + "file_modification_time").alias("_time"),
                                        F.col(m + "file_block_start").alias("_start"))


def _headers(lines: DataFrame, aliases: Mapping[str, str] | None) -> DataFrame:
    """Per file its first line and the column names in it, renamed by ``aliases``
    (written: a row per file)."""
    first = lines.where(F.col("_start") == 0).withColumn("_no", F.monotonically_increasing_id())\
        .groupBy(_FILE).agg(F.min_by("value", "_no").alias("_header"), F.max("_time").alias("_time"))
    names = F.transform(F.split("_header", ","), lambda c: F.lower(F.trim(F.regexp_replace(c, '^\ufeff|"', ""))))
    if aliases:
        pairs = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
        names = F.transform(names, lambda c: F.coalesce(F.element_at(pairs, c), c))
    return materialize(first.select(_FILE, "_header", "_time", names.alias("_names")))


def file_layouts(spark: SparkSession, path: str | list[str], schema: T.StructType, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Per file ``source_file, file_time, columns``, and the schema's columns that it
    lacks (``missing``) and its columns that the schema lacks (``unknown``)."""
    want = F.array(*[F.lit(f.name) for f in schema.fields])
    return _headers(_lines(spark, path), aliases).select(
        F.col(_FILE).alias("source_file"), F.col("_time").alias("file_time"), F.col("_names").alias("columns"),
        F.array_except(want, F.col("_names")).alias("missing"), F.array_except("_names", want).alias("unknown"))


def _by_layout(spark: SparkSession, path: str | list[str], schema: T.StructType, aliases: Mapping[str, str] | None) -> DataFrame:
    """Cells of all files as text in the schema's columns, whatever their own order,
    with ``_reasons`` as in :func:`_checked`.  One row per file is joined to the lines,
    broadcast if they are counted few."""
    lines = _lines(spark, path)
    headers = _headers(lines, aliases)
    stats = headers.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.max(F.size("_names")), F.lit(1)).alias("cells")).first()
    small = headers.drop("_time")
    cells = ", ".join(f"c{i} string" for i in range(stats["cells"] + 1))        # one more, to see a record that is too long
    rows = lines.join(F.broadcast(small) if stats["files"] <= MAX_BROADCAST_FILES else small, _FILE)\
        .where((F.col("value") != F.col("_header")) & (F.trim("value") != ""))
    rows = rows.select("value", _FILE, "_time", "_names", F.from_csv("value", cells).alias("_c"))
    values = F.array(*[F.nullif(F.col(f"_c.c{i}"), F.lit("")) for i in range(stats["cells"] + 1)])
    rows = rows.select("value", _FILE, "_time", F.inline(F.array(F.struct(F.col("_names").alias("_names"), values.alias("_v")))))
    at = lambda name: F.array_position("_names", name)
    out = [F.when(at(f.name) > 0, F.get("_v", (at(f.name) - 1).cast("int"))).alias(f.name) for f in schema.fields]
    beyond = F.exists(F.slice("_v", F.size("_names") + 1, F.lit(stats["cells"] + 1)), lambda c: c.isNotNull())
    rows = rows.select("value", _FILE, "_time", beyond.alias("_long"), *out)
    faults = [F.when(F.col("_long"), F.lit("wrong number of cells"))]
    for f in schema.fields:
        if not f.nullable:
            faults.append(F.when(F.col(f.name).isNull(), F.lit(f"no {f.name}")))
        if not isinstance(f.dataType, T.StringType):
            faults.append(F.when(F.col(f.name).isNotNull() & _cell(f.name, f.dataType).isNull(), F.lit(f"bad {f.name}")))
    return rows.withColumn("_reasons", F.array_compact(F.array(*faults)))


def read_files(spark: SparkSession, path: str | list[str], schema: T.StructType, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Typed rows of CSV files of drifting layouts below a glob or list of globs.

    Each file's header says where its columns are: their order does not matter, a
    missing column is NULL, an unknown one is left out (:func:`file_layouts` names
    both), ``aliases`` maps other names (lower case) to the schema's.  A repeated
    header line is no record.  ``source_file`` and ``file_time`` tell where and when a
    row's file was written; faulty records are left to :func:`read_file_errors`."""
    rows = _by_layout(spark, path, schema, aliases).where(F.size("_reasons") == 0)
    return normalize_nans(rows.select(*[_cell(f.name, f.dataType).alias(f.name) for f in schema.fields],
                                      F.col(_FILE).alias("source_file"), F.col("_time").alias("file_time")))


def read_file_errors(spark: SparkSession, path: str | list[str], schema: T.StructType, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """The records that :func:`read_files` leaves out: ``file_path, record, reason``."""
    rows = _by_layout(spark, path, schema, aliases).where(F.size("_reasons") > 0)
    return rows.select(F.col(_FILE).alias("file_path"), F.col("value").alias("record"), F.concat_ws(", ", "_reasons").alias("reason"))


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw access-log text, one row per line, with its file."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file_path"))


def read_access_log_text(spark: SparkSession, path: str, fmt: str = "main") -> DataFrame:
    """Raw access-log text -> typed ``access_logs`` rows."""
    return parse_access_log(read_log_lines(spark, path), fmt)


def read_access_log_errors(spark: SparkSession, path: str, fmt: str = "main") -> DataFrame:
    return parse_errors(read_log_lines(spark, path), fmt, keep_cols=("file_path",))


def load(spark: SparkSession, path: str, fmt: str | None = None,
         schema: T.StructType | None = None) -> DataFrame:
    """Format dispatch by suffix (``.parquet`` / ``.csv``) or explicit ``fmt``;
    anything else raises ValueError.  NaN cells become NULL."""
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet")
                  else "csv" if path.rstrip("/").endswith(".csv") else None)
    if fmt == "parquet":
        return normalize_nans(spark.read.parquet(path))
    if fmt == "csv":
        if schema is None:
            raise ValueError("CSV sources need an explicit schema")
        return normalize_nans(_csv(spark, path, schema))
    if fmt == "json":
        return normalize_nans(spark.read.schema(schema).json(path) if schema else spark.read.json(path))
    raise ValueError(f"Unsupported file format: {path}")


def union_sources(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Multi-source dataset: union by column name (missing columns NULL) with
    a ``source`` label per row."""
    out = None
    for name, df in frames.items():
        df = df.withColumn("source", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def union_files(spark: SparkSession, sources: Mapping[str, tuple]) -> DataFrame:
    """One dataset from files: ``sources`` maps a label to ``(globs, schema)`` or
    ``(globs, schema, aliases)``; every row keeps its source, file and file time."""
    return union_sources({name: read_files(spark, *spec) for name, spec in sources.items()})


def source_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per source of a multi-source dataset (one aggregation)."""
    return union_sources({k: v.select(F.lit(1).alias("_one")) for k, v in frames.items()})\
        .groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
