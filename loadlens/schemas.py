"""Explicit schemas of the tables the operators work on (never inferred)."""

from pyspark.sql import types as T

# The four metrics every statistic of the reference toolkit looks at.
METRIC_COLUMNS = ["cpu_usage", "memory_usage", "response_time_ms", "error_rate"]

# Column metadata of a partition column: the time column that it truncates, and to what.
TRUNCATES, UNIT = "truncates", "unit"

METRICS = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType(), False),
    T.StructField("server_id", T.StringType(), False),
    T.StructField("cpu_usage", T.DoubleType(), True),
    T.StructField("memory_usage", T.DoubleType(), True),
    T.StructField("disk_io", T.DoubleType(), True),
    T.StructField("network_traffic", T.DoubleType(), True),
    T.StructField("request_count", T.LongType(), True),
    T.StructField("error_rate", T.DoubleType(), True),
    T.StructField("response_time_ms", T.DoubleType(), True),
])

ACCESS_LOGS = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType(), False),
    T.StructField("client_ip", T.StringType(), True),
    T.StructField("request_method", T.StringType(), True),
    T.StructField("endpoint", T.StringType(), True),
    T.StructField("response_code", T.IntegerType(), True),
    T.StructField("response_size", T.LongType(), True),
    T.StructField("response_time_ms", T.DoubleType(), True),
    T.StructField("referer", T.StringType(), True),
    T.StructField("user_agent", T.StringType(), True),
])

# Wide 16-column metrics of the big-file tooling (zoned timestamp).
BIGDATA = T.StructType([
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("server_id", T.StringType(), True),
    T.StructField("server_type", T.StringType(), True),
    T.StructField("region", T.StringType(), True),
    T.StructField("cpu_usage", T.DoubleType(), True),
    T.StructField("memory_usage", T.DoubleType(), True),
    T.StructField("disk_io_read_mbps", T.DoubleType(), True),
    T.StructField("disk_io_write_mbps", T.DoubleType(), True),
    T.StructField("network_in_mbps", T.DoubleType(), True),
    T.StructField("network_out_mbps", T.DoubleType(), True),
    T.StructField("response_time_ms", T.DoubleType(), True),
    T.StructField("request_count", T.LongType(), True),
    T.StructField("error_count", T.LongType(), True),
    T.StructField("status_code_2xx", T.LongType(), True),
    T.StructField("status_code_4xx", T.LongType(), True),
    T.StructField("status_code_5xx", T.LongType(), True),
])

# Host-agent metrics files (15 columns).
HOST_METRICS = T.StructType(
    [T.StructField("timestamp", T.TimestampNTZType(), True),
     T.StructField("server_id", T.StringType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in (
        "cpu_usage", "cpu_user", "cpu_system", "memory_usage", "memory_used_gb",
        "memory_available_gb", "swap_usage", "disk_usage", "disk_read_mb",
        "disk_write_mb", "network_sent_mb", "network_recv_mb", "load_average")]
)

# Long-form result of the report composites.
REPORT = T.StructType([
    T.StructField("section", T.StringType(), False),
    T.StructField("subject", T.StringType(), True),
    T.StructField("metric", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("text", T.StringType(), True),
])
