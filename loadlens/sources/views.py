"""Stand-in metric and access-log tables derived from the driver's tables.

No server-metric or access-log table ships with the test data, so the named
queries map columns of ``lineitem`` and ``events`` onto the two reference
schemas.  Each view is a pure projection: Catalyst prunes the unused source
columns; filters on renamed columns (times) reach the Parquet scan, filters on
arithmetic ones do not.
The DuckDB twins of these projections live in ``loadlens.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.schemas import BIGDATA, HOST_METRICS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def metrics_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``server_metrics`` from ``lineitem``: one supplier = one server."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_shipdate").alias("timestamp"),
        F.concat(F.lit("server_"), F.col("l_suppkey").cast("string")).alias("server_id"),
        (F.col("l_quantity") * 2).alias("cpu_usage"),
        (F.col("l_discount") * 1000).alias("memory_usage"),
        (F.col("l_quantity") * F.col("l_tax") * 10).alias("disk_io"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("network_traffic"),
        F.col("l_linenumber").cast("bigint").alias("request_count"),
        (F.col("l_tax") * 100).alias("error_rate"),
        (F.col("l_extendedprice") / 100).alias("response_time_ms"),
    )


def _props_k() -> F.Column:
    return F.nullif(F.regexp_extract(F.col("props"), r'"k": *(-?[0-9]+)', 1), F.lit("")).try_cast("int")


def logs_view(spark: SparkSession, sf_dir: str, with_k: bool = False) -> DataFrame:
    """``access_logs`` from ``events``: one user = one client address."""
    return logs_from(table(spark, sf_dir, "events"), with_k)


def logs_from(ev: DataFrame, with_k: bool = False) -> DataFrame:
    """The ``logs`` projection of an ``events`` frame (batch or streaming)."""
    extra = [_props_k().alias("k")] if with_k else []
    return ev.select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("10.0."), F.floor(F.col("user_id") / 256).cast("string"),
                 F.lit("."), (F.col("user_id") % 256).cast("string")).alias("client_ip"),
        F.when(F.col("event_type").isin("purchase", "signup"), F.lit("POST"))
         .otherwise(F.lit("GET")).alias("request_method"),
        F.concat(F.lit("/api/"), F.col("event_type"), F.lit("/"),
                 (F.col("user_id") % 7).cast("string")).alias("endpoint"),
        F.when(F.col("event_type") == "error", F.lit(500))
         .when(F.col("value") > 200, F.lit(404))
         .when(F.col("event_type") == "signup", F.lit(201))
         .otherwise(F.lit(200)).cast("int").alias("response_code"),
        (F.col("event_id") % 1000).cast("bigint").alias("response_size"),
        (F.col("value") * 10).alias("response_time_ms"),
        F.lit("https://example.com").alias("referer"),
        F.lit("Mozilla/5.0").alias("user_agent"),
        *extra,
    )


def access_log_lines_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw access-log text rendered from the ``logs`` stand-in, one line per
    event (column ``value``), for the parser queries.  The event's ``k``
    property picks the line shape: 0 a named user instead of ``- -``, 1 an
    impossible date (31 Feb), 2 size ``-``, 3 a time without a decimal
    point, 4 the web server's own ``rt=`` layout, 5 a blank line; every
    other event gives a well-formed line of the parser's layout."""
    lg = logs_view(spark, sf_dir, with_k=True)
    # evaluate the props regex once (read by every branch below)
    lg = lg.select(*[c for c in lg.columns if c != "k"], F.inline(F.array(F.struct(F.col("k").alias("k")))))
    k = F.col("k")
    day = F.date_format("timestamp", "dd/MMM/yyyy")
    clock = F.date_format("timestamp", "HH:mm:ss")
    when = F.concat(F.when(k == 1, F.lit("31/Feb/2024")).otherwise(day), F.lit(":"), clock, F.lit(" +0000"))
    ident = F.when(k == 0, F.lit("- alice")).otherwise(F.lit("- -"))
    size = F.when(k == 2, F.lit("-")).otherwise(F.col("response_size").cast("string"))
    secs = F.when(k == 3, F.floor(F.col("response_time_ms") / 1000).cast("string"))\
        .otherwise(F.format_string("%.4f", F.col("response_time_ms") / 1000))
    tail = F.when(k == 4, F.concat(F.lit('"-" rt='), secs)).otherwise(secs)
    line = F.concat(F.col("client_ip"), F.lit(" "), ident, F.lit(" ["), when, F.lit('] "'),
                    F.col("request_method"), F.lit(" "), F.col("endpoint"), F.lit(' HTTP/1.1" '),
                    F.col("response_code").cast("string"), F.lit(" "), size, F.lit(' "'),
                    F.col("referer"), F.lit('" "'), F.col("user_agent"), F.lit('" '), tail)
    return lg.select(F.when(k == 5, F.lit("")).otherwise(line).alias("value"))


def access_log_cells_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``logs`` stand-in as CSV cells (text).  The event's ``k`` property spoils
    a cell: 0 a code that is no number, 1 a time that is none, 2 a size with a unit,
    3 no time at all, 4 both a code and a response time that are no numbers."""
    lg, k = logs_view(spark, sf_dir, with_k=True), F.col("k")
    cell = {f.name: F.col(f.name).cast("string") for f in lg.schema.fields if f.name != "k"}
    cell["timestamp"] = F.when(k == 1, F.lit("yesterday")).when(k == 3, F.lit(None)).otherwise(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    cell["response_code"] = F.when(k.isin(0, 4), F.lit("OK")).otherwise(cell["response_code"])
    cell["response_size"] = F.when(k == 2, F.concat(cell["response_size"], F.lit("B"))).otherwise(cell["response_size"])
    cell["response_time_ms"] = F.when(k == 4, F.lit("fast")).otherwise(cell["response_time_ms"])
    return lg.select(*[c.alias(n) for n, c in cell.items()])


def host_metrics_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host-agent metrics from ``events``, in the ``HOST_METRICS`` columns."""
    ev, value, user = table(spark, sf_dir, "events"), F.col("value"), F.col("user_id")
    cols = {"timestamp": F.col("ts"), "server_id": F.col("event_type"), "cpu_usage": value, "cpu_user": value * 0.75, "cpu_system": value * 0.25,
            "memory_usage": (user % 100).cast("double"), "swap_usage": (user % 3).cast("double"), "load_average": value / 8}
    return ev.select(*[(cols.get(f.name, (user % 11).cast("double"))).cast(f.dataType).alias(f.name) for f in HOST_METRICS.fields])


def metrics_ev_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second metrics stand-in from ``events`` with five large groups
    (``event_type`` as the server) and a long-tailed ``cpu_usage``; used by
    the anomaly and inference operators."""
    return metrics_ev_from(table(spark, sf_dir, "events"))


def metrics_ev_from(ev: DataFrame) -> DataFrame:
    """The ``metrics_ev`` projection of an ``events`` frame (batch or streaming)."""
    k = F.regexp_extract(F.col("props"), r'"k": *(-?[0-9.]+)', 1)
    return ev.select(
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("server_id"),
        F.col("value").alias("cpu_usage"),
        F.nullif(k, F.lit("")).try_cast("double").alias("memory_usage"),
        (F.col("user_id") % 50 * 3 + F.col("value")).cast("double").alias("response_time_ms"),
        ((F.col("user_id") % 10) / 2).cast("double").alias("error_rate"),
        F.col("event_id").alias("seq"),
    )


def forecast_pairs_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted vs actual pairs, in thousands: an order's total price
    predicted from its line items (price x (1 - discount) x (1 + tax)) vs
    the recorded total.  Orders without lines have no prediction (NULL)."""
    lines = (table(spark, sf_dir, "lineitem")
             .groupBy("l_orderkey")
             .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")))
                  .alias("_pred")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select(
        F.col("o_orderkey").alias("seq"), (F.col("_pred") / 1000).alias("predicted"),
        (F.col("o_totalprice") / 1000).alias("actual"))


def bigdata_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 16-column wide metrics from ``events``, in the ``BIGDATA`` schema."""
    ev = table(spark, sf_dir, "events")
    user, value = F.col("user_id"), F.col("value")
    values = {
        "timestamp": F.col("ts"), "server_id": F.concat(F.lit("server_"), (user % 50).cast("string")), "server_type": F.col("event_type"),
        "region": F.concat(F.lit("region_"), (user % 5).cast("string")), "cpu_usage": value, "memory_usage": value * 0.7 + user % 13,
        "disk_io_read_mbps": value * 1.3, "disk_io_write_mbps": value * 0.9, "network_in_mbps": value + user % 7, "network_out_mbps": value + user % 11,
        "response_time_ms": value * 10, "request_count": F.col("event_id") % 1000, "error_count": user % 4,
        "status_code_2xx": F.col("event_id") % 900, "status_code_4xx": user % 9, "status_code_5xx": user % 3}
    return ev.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in BIGDATA.fields])
