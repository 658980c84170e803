"""Group-by, top-k and summary operators over ``server_metrics`` and
``access_logs``.

Conventions (pinned to the reference's pandas behaviour):
* pandas drops NULL group keys (``groupby``/``value_counts``), SQL keeps them
  (the top-endpoints query) — each operator says which;
* std is the sample std (NULL for a one-row group);
* outputs are named ``{metric}_{agg}`` and rounded NumPy-style.
Every operator is a single partial/final hash aggregation (map-side combine),
so a hot group costs one partial row per input partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions.numeric import np_round, pearson
from loadlens.operators.filters import ERROR_RATE_THRESHOLD, RESPONSE_TIME_THRESHOLD, is_error, time_range
from loadlens.operators.quantiles import exact_quantiles
from loadlens.schemas import METRIC_COLUMNS
from loadlens.session import materialize


MAX_BROADCAST_GROUPS = 100_000  # groups (a key and two doubles) broadcast at most


def _keyed(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def server_stats(df: DataFrame, ndigits: int = 2) -> DataFrame:
    """Per-server mean/max/std of cpu, memory, response time; mean/max of
    error rate (11 measures)."""
    spec = {"cpu_usage": ("mean", "max", "std"), "memory_usage": ("mean", "max", "std"),
            "response_time_ms": ("mean", "max", "std"), "error_rate": ("mean", "max")}
    fn = {"mean": F.avg, "max": F.max, "std": F.stddev_samp}
    aggs = [np_round(fn[a](c), ndigits).alias(f"{c}_{a}") for c, ags in spec.items() for a in ags]
    return _keyed(df, "server_id").groupBy("server_id").agg(*aggs)


def server_mean_std(df: DataFrame) -> DataFrame:
    """Per-server cpu mean/std and response-time mean."""
    return _keyed(df, "server_id").groupBy("server_id").agg(
        np_round(F.avg("cpu_usage"), 2).alias("cpu_usage_mean"),
        np_round(F.stddev_samp("cpu_usage"), 2).alias("cpu_usage_std"),
        np_round(F.avg("response_time_ms"), 2).alias("response_time_ms_mean"))


def hourly_stats(df: DataFrame) -> DataFrame:
    """Hour-of-day profile (0-23 over all dates): mean cpu, total requests,
    mean error rate, mean response time."""
    return (df.where(F.col("timestamp").isNotNull())
              .groupBy(F.hour("timestamp").cast("bigint").alias("hour"))
              .agg(np_round(F.avg("cpu_usage"), 2).alias("cpu_usage_mean"),
                   F.coalesce(F.sum("request_count"), F.lit(0)).cast("bigint").alias("request_count_sum"),
                   np_round(F.avg("error_rate"), 2).alias("error_rate_mean"),
                   np_round(F.avg("response_time_ms"), 2).alias("response_time_ms_mean")))


def hourly_log_stats(logs: DataFrame) -> DataFrame:
    """Hour-of-day profile of the access log: mean response time and the
    number of (non-NULL) response codes."""
    return (logs.where(F.col("timestamp").isNotNull())
                .groupBy(F.hour("timestamp").cast("bigint").alias("hour"))
                .agg(np_round(F.avg("response_time_ms"), 2).alias("response_time_ms_mean"),
                     F.count("response_code").alias("response_code_count")))


def log_overview(logs: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, distinct clients, distinct endpoints and mean response time."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return logs.agg(F.count(F.lit(1)).alias("total_requests"),
                    distinct("client_ip").alias("unique_clients"),
                    distinct("endpoint").alias("unique_endpoints"),
                    np_round(F.avg("response_time_ms"), 2).alias("response_time_ms_mean"))


def metrics_overview(df: DataFrame) -> DataFrame:
    """Rows, covered period and number of distinct servers."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.min("timestamp").alias("first_timestamp"),
                  F.max("timestamp").alias("last_timestamp"),
                  F.count_distinct("server_id").alias("servers"))


def server_list(df: DataFrame) -> DataFrame:
    """Distinct server ids (the ``unique()`` listing), one row each."""
    return _keyed(df, "server_id").select("server_id").distinct()


def value_frequency(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """``value_counts``: NULL dropped, descending count, ties by value."""
    out = _keyed(df, column).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(F.desc("count"), F.asc(column)).limit(limit) if limit else out


def status_counts(logs: DataFrame) -> DataFrame:
    return value_frequency(logs, "response_code")


def method_counts(logs: DataFrame) -> DataFrame:
    return value_frequency(logs, "request_method")


def top5_endpoints(logs: DataFrame, limit: int = 5) -> DataFrame:
    return value_frequency(logs, "endpoint", limit)


def describe_response(logs: DataFrame, column: str = "response_time_ms") -> DataFrame:
    """``describe()``: count, mean, std, min, exact 25/50/75 % (linear), max."""
    basic = logs.agg(F.count(column).alias("count"),
                     np_round(F.avg(column), 4).alias("mean"),
                     np_round(F.stddev_samp(column), 4).alias("std"),
                     F.min(column).alias("min"), F.max(column).alias("max"))
    q = exact_quantiles(logs, [column], [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    q = q.select(*[np_round(f"{column}_{c}", 4).alias(c) for c in ("p25", "p50", "p75")])
    return basic.crossJoin(q)   # one row x one row


def access_log_stats(logs: DataFrame, as_of, hours: int = 24, approximate: bool = False) -> DataFrame:
    """Stats of the window ``[as_of - hours, as_of]``; always one row (zeros
    and a NULL mean on an empty window).  ``approximate`` counts distinct
    clients and endpoints by sketches (5 % standard error), one pass."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    end = F.lit(as_of).cast("timestamp_ntz")
    start = end - F.expr(f"INTERVAL {int(hours)} HOURS")
    w = logs.where(time_range(logs, start, end))
    agg = w.agg(F.count(F.lit(1)).alias("total_requests"),
                np_round(F.avg("response_time_ms"), 2).alias("avg_response_time"),
                F.count_if(is_error()).alias("error_count"),
                distinct("client_ip").alias("unique_ips"),
                distinct("endpoint").alias("unique_endpoints"))
    return agg.select(
        "total_requests", "avg_response_time", "error_count",
        F.when(F.col("total_requests") > 0,
               np_round(F.col("error_count") / F.col("total_requests") * 100, 2))
         .otherwise(F.lit(0.0)).alias("error_rate"),
        "unique_ips", "unique_endpoints")


def top_endpoints(logs: DataFrame, limit: int = 10) -> DataFrame:
    """SQL-style top endpoints: NULL endpoint is a group; ties by endpoint."""
    return (logs.groupBy("endpoint")
                .agg(F.count(F.lit(1)).alias("request_count"),
                     np_round(F.avg("response_time_ms"), 4).alias("avg_response_time"),
                     F.count_if(is_error()).alias("error_count"))
                .orderBy(F.desc("request_count"), F.asc_nulls_first("endpoint"))
                .limit(limit))


def slowest_endpoints(logs: DataFrame, threshold: float = RESPONSE_TIME_THRESHOLD,
                      limit: int = 3) -> DataFrame:
    """Among slow requests: mean response time per endpoint, top ``limit``."""
    return (_keyed(logs.where(F.col("response_time_ms") > F.lit(threshold)), "endpoint")
            .groupBy("endpoint")
            .agg(F.avg("response_time_ms").alias("_m"))
            .orderBy(F.desc("_m"), F.asc("endpoint")).limit(limit)
            .select("endpoint", np_round("_m", 2).alias("response_time_ms_mean")))


def busiest_server(df: DataFrame) -> DataFrame:
    """Server with the highest mean cpu (ties -> smallest id)."""
    return (_keyed(df, "server_id").groupBy("server_id")
            .agg(F.avg("cpu_usage").alias("_m"))
            .where(F.col("_m").isNotNull())
            .orderBy(F.desc("_m"), F.asc("server_id")).limit(1)
            .select("server_id", np_round("_m", 2).alias("cpu_usage_mean")))


def peak_hour(df: DataFrame) -> DataFrame:
    """Hour of day with the most requests (ties -> smallest hour)."""
    return (df.where(F.col("timestamp").isNotNull())
              .groupBy(F.hour("timestamp").cast("bigint").alias("hour"))
              .agg(F.coalesce(F.sum("request_count"), F.lit(0)).cast("bigint").alias("request_count_sum"))
              .orderBy(F.desc("request_count_sum"), F.asc("hour")).limit(1))


def server_features(df: DataFrame, ndigits: int = 3) -> DataFrame:
    """The 8 clustering features per server."""
    spec = [("cpu_usage", "mean"), ("cpu_usage", "std"), ("cpu_usage", "max"),
            ("memory_usage", "mean"), ("memory_usage", "std"),
            ("response_time_ms", "mean"), ("response_time_ms", "max"), ("error_rate", "mean")]
    fn = {"mean": F.avg, "max": F.max, "std": F.stddev_samp}
    return _keyed(df, "server_id").groupBy("server_id").agg(
        *[np_round(fn[a](c), ndigits).alias(f"{c}_{a}") for c, a in spec])


def server_recommendations(df: DataFrame) -> DataFrame:
    """Per-server rules on stats rounded to 2 decimals: mean cpu > 70 ->
    ``scale``, else max cpu > 90 -> ``cpu_spikes``; independently mean
    response > 200 -> ``slow_response``.  0-2 rows per server."""
    s = _keyed(df, "server_id").groupBy("server_id").agg(
        np_round(F.avg("cpu_usage"), 2).alias("a_cpu"),
        np_round(F.max("cpu_usage"), 2).alias("m_cpu"),
        np_round(F.avg("response_time_ms"), 2).alias("a_resp"))
    rule = lambda name, v: F.struct(F.lit(name).alias("rule"), v.alias("value"))
    rules = F.array_compact(F.array(
        F.when(F.col("a_cpu") > 70, rule("scale", F.col("a_cpu")))
         .when(F.col("m_cpu") > 90, rule("cpu_spikes", F.col("m_cpu"))),
        F.when(F.col("a_resp") > 200, rule("slow_response", F.col("a_resp")))))
    return s.select("server_id", F.explode(rules).alias("r")).select("server_id", "r.rule", "r.value")


def fleet_stats(df: DataFrame, error_threshold: float = ERROR_RATE_THRESHOLD) -> DataFrame:
    """One pass: cpu/response correlation, count of high-error rows, mean
    response time (inputs of the fleet rules)."""
    return df.agg(pearson("cpu_usage", "response_time_ms").alias("cpu_response_corr"),
                  F.count_if(F.col("error_rate") > F.lit(error_threshold)).alias("high_error_rows"),
                  F.avg("response_time_ms").alias("response_time_ms_mean"))


def fleet_recommendations(df: DataFrame) -> DataFrame:
    """Fleet rules: corr(cpu, response) > 0.7; more than 10 rows with error
    rate > 5; mean response > 200.  One row per fired rule."""
    s = fleet_stats(df)
    rule = lambda name, v: F.struct(F.lit(name).alias("rule"), v.cast("double").alias("value"))
    rules = F.array_compact(F.array(
        F.when(F.col("cpu_response_corr") > 0.7, rule("optimize_compute", np_round("cpu_response_corr", 4))),
        F.when(F.col("high_error_rows") > 10, rule("investigate_errors", F.col("high_error_rows"))),
        F.when(F.col("response_time_ms_mean") > 200, rule("optimize_latency", np_round("response_time_ms_mean", 4)))))
    return s.select(F.explode(rules).alias("r")).select("r.rule", "r.value")


def correlation_matrix(df: DataFrame, columns=METRIC_COLUMNS, ndigits: int = 3) -> DataFrame:
    """Pearson matrix in long form ``(x, y, r)`` from one aggregation pass
    (pairwise-complete rows; NULL for a constant column)."""
    cols = [c for c in columns if c in df.columns]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = df.agg(*[pearson(a, b).alias(f"{a}|{b}") for a, b in pairs])
    entries = []
    for a in cols:
        for b in cols:
            if a == b:
                v = F.lit(1.0)
            else:
                key = f"{a}|{b}" if (a, b) in pairs else f"{b}|{a}"
                v = np_round(F.col(f"`{key}`"), ndigits)
            entries.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), v.alias("r")))
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def cpu_response_corr(df: DataFrame, ndigits: int = 3) -> DataFrame:
    return df.agg(np_round(pearson("cpu_usage", "response_time_ms"), ndigits).alias("cpu_response_corr"))


def response_histogram(df: DataFrame, column: str = "response_time_ms", bins: int = 20,
                       key: str = "server_id") -> DataFrame:
    """Per-group equal-width histogram (edges from the group's min/max, last
    bin right-closed; a constant group uses ``[x-0.5, x+0.5]``).  Returns
    ``(key, bin, lo, hi, count)`` for non-empty bins.  Two scans: the groups'
    edges, then the bins.  The edges (a row per group) are counted and, if
    few, broadcast, so a row is binned before any shuffle."""
    data = df.where(F.col(key).isNotNull() & F.col(column).isNotNull()).select(key, column)
    rng = data.groupBy(key).agg(F.min(column).alias("_mn"), F.max(column).alias("_mx"))
    rng = materialize(rng.select(
        key, F.when(F.col("_mx") > F.col("_mn"), F.col("_mn")).otherwise(F.col("_mn") - 0.5).alias("_lo"),
        F.when(F.col("_mx") > F.col("_mn"), F.col("_mx")).otherwise(F.col("_mx") + 0.5).alias("_hi")))
    edges = F.broadcast(rng) if rng.count() <= MAX_BROADCAST_GROUPS else rng
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    b = F.least(F.floor((F.col(column) - F.col("_lo")) / width), F.lit(bins - 1)).cast("int")
    return (data.join(edges, key)
              .groupBy(key, b.alias("bin"), "_lo", "_hi")
              .agg(F.count(F.lit(1)).alias("count"))
              .select(key, "bin",
                      np_round(F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("bin") / bins, 6).alias("lo"),
                      np_round(F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("bin") + 1) / bins, 6).alias("hi"),
                      "count"))


def null_profile(df: DataFrame, by=("server_id",), columns=None) -> DataFrame:
    """Missing-value profile: NULL count per column and group, long form
    ``(*by, column, nulls, rows)``.  NaN should be normalised to NULL first."""
    cols = [c for c in (columns or df.columns) if c not in by]
    agg = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"),
                              *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls"))
                        for i, c in enumerate(cols)])
    return agg.select(*by, "rows", F.explode(entries).alias("e")).select(*by, "e.column", "e.nulls", "rows")


def cpu_trend(df: DataFrame) -> DataFrame:
    """Per-server (timestamp, cpu) series, ordered — the trend-chart input."""
    return df.select("server_id", "timestamp", "cpu_usage").orderBy("server_id", "timestamp")


def kde_curve(df: DataFrame, column: str = "cpu_usage", key: str = "server_id",
              grid: int = 200) -> DataFrame:
    """Gaussian density per group on ``grid`` points from min to max, with
    Scott's bandwidth ``h = std * n^(-1/5)``.

    The curve is a vector of ``grid`` sums: each row adds its kernel to all of them
    in one partial aggregation, so what leaves a task is one vector per group and
    no row is expanded or shuffled.  Two scans: the groups' figures (counted and,
    if few, broadcast), then the sums.  A constant group has no curve."""
    data = df.where(F.col(key).isNotNull() & F.col(column).isNotNull()).select(F.col(key).alias("_key"), F.col(column).cast("double").alias("_v"))
    st = data.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp("_v").alias("_sd"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx"))
    st = materialize(st.where((F.col("_mx") > F.col("_mn")) & (F.col("_sd") > 0))
                     .select("_key", "_n", "_mn", "_mx", (F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))).alias("_h")))
    small = st.count() <= MAX_BROADCAST_GROUPS
    # in bandwidths: the row's place (_u) and the grid's first point and step
    rows = data.join(F.broadcast(st) if small else st, "_key").select(
        "_key", ((F.col("_v") - F.col("_mn")) / F.col("_h")).alias("_u"), ((F.col("_mx") - F.col("_mn")) / F.col("_h") / F.lit(float(grid - 1))).alias("_step"))
    kernels = [F.expr(f"sum(exp(-0.5D * (_step * {g} - _u) * (_step * {g} - _u)))") for g in range(grid)]
    sums = rows.groupBy("_key").agg(F.array(*kernels).alias("_sums"))
    x = F.col("_mn") + (F.col("_mx") - F.col("_mn")) * F.col("point") / F.lit(float(grid - 1))
    norm = F.col("_n") * F.col("_h") * F.lit((2 * 3.141592653589793) ** 0.5)
    return (st.join(sums, "_key").select("_key", "_n", "_h", "_mn", "_mx", F.posexplode("_sums").alias("point", "_s"))
              .select(F.col("_key").alias(key), "point", np_round(x, 6).alias("x"), np_round(F.col("_s") / norm, 8).alias("density")))


def heavy_endpoints(logs: DataFrame) -> DataFrame:
    """Endpoints by bytes served and time spent."""
    return (_keyed(logs, "endpoint").groupBy("endpoint")
            .agg(F.count(F.lit(1)).alias("requests"),
                 F.coalesce(F.sum("response_size"), F.lit(0)).cast("bigint").alias("total_bytes"),
                 np_round(F.avg("response_time_ms"), 2).alias("response_time_ms_mean"),
                 np_round(F.sum("response_time_ms"), 2).alias("response_time_ms_sum")))


def status_class_share(logs: DataFrame) -> DataFrame:
    """Share of 1xx..5xx classes among requests with a code (percent)."""
    c = logs.where(F.col("response_code").isNotNull())\
        .groupBy(F.concat(F.floor(F.col("response_code") / 100).cast("string"), F.lit("xx")).alias("status_class"))\
        .agg(F.count(F.lit(1)).alias("requests"))
    total = F.sum("requests").over(Window.partitionBy())  # over <= 10 class rows
    return c.select("status_class", "requests", np_round(F.col("requests") / total * 100, 2).alias("share_pct"))


def suspicious_clients(logs: DataFrame, min_endpoints: int = 20, min_error_share: float = 0.5,
                       min_requests: int = 1) -> DataFrame:
    """Clients that look like scanners: many distinct endpoints or a high
    share of error responses."""
    s = _keyed(logs, "client_ip").groupBy("client_ip").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_distinct("endpoint").alias("distinct_endpoints"),
        F.count_if(is_error()).alias("errors"))
    s = s.withColumn("error_share", np_round(F.col("errors") / F.col("requests"), 4))
    return s.where((F.col("requests") >= min_requests) &
                   ((F.col("distinct_endpoints") >= min_endpoints) | (F.col("error_share") >= min_error_share)))
