"""DuckDB twins of the named queries (the correctness oracle).

Each string runs on the driver's pre-registered views (``lineitem``,
``events`` ...) and is written independently of the Spark code: the stand-in
projections are repeated here as CTEs.  NumPy-style rounding is
``round_even(x * 10^n, 0) / 10^n``.
"""

from __future__ import annotations

METRICS = """metrics AS (
  SELECT l_shipdate AS "timestamp",
         'server_' || CAST(l_suppkey AS VARCHAR) AS server_id,
         l_quantity * 2 AS cpu_usage,
         l_discount * 1000 AS memory_usage,
         l_quantity * l_tax * 10 AS disk_io,
         l_extendedprice * l_discount AS network_traffic,
         CAST(l_linenumber AS BIGINT) AS request_count,
         l_tax * 100 AS error_rate,
         l_extendedprice / 100 AS response_time_ms
  FROM lineitem)"""

LOGS = """logs AS (
  SELECT ts AS "timestamp",
         '10.0.' || CAST(CAST(floor(user_id / 256) AS BIGINT) AS VARCHAR) || '.'
                 || CAST(user_id % 256 AS VARCHAR) AS client_ip,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS request_method,
         '/api/' || event_type || '/' || CAST(user_id % 7 AS VARCHAR) AS endpoint,
         CAST(CASE WHEN event_type = 'error' THEN 500 WHEN value > 200 THEN 404
                   WHEN event_type = 'signup' THEN 201 ELSE 200 END AS INTEGER) AS response_code,
         CAST(event_id % 1000 AS BIGINT) AS response_size,
         value * 10 AS response_time_ms,
         'https://example.com' AS referer,
         'Mozilla/5.0' AS user_agent
  FROM events)"""

# logs plus the event's ``k`` property, which picks the rendered line shape
LOGS_K = LOGS.replace("logs AS (", "logs_k AS (").replace(
    "'Mozilla/5.0' AS user_agent",
    "'Mozilla/5.0' AS user_agent,\n         TRY_CAST(regexp_extract(props, '\"k\": *(-?[0-9]+)', 1) AS INTEGER) AS k")

METRICS_EV = """metrics_ev AS (
  SELECT ts AS "timestamp", event_type AS server_id, value AS cpu_usage,
         TRY_CAST(NULLIF(regexp_extract(props, '"k": *(-?[0-9.]+)', 1), '') AS DOUBLE) AS memory_usage,
         CAST((user_id % 50) * 3 + value AS DOUBLE) AS response_time_ms,
         CAST((user_id % 10) / 2 AS DOUBLE) AS error_rate,
         event_id AS seq
  FROM events)"""


def r(expr: str, n: int) -> str:
    """NumPy rounding in DuckDB."""
    return f"(round_even(({expr}) * {10.0 ** n!r}, 0) / {10.0 ** n!r})"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE: dict[str, str] = {}


def oracle(name: str):
    def deco(fn):
        ORACLE[name] = fn()
        return fn
    return deco


# ---------------------------------------------------------------- filters
@oracle("metrics_filter")
def _():
    return with_(METRICS) + """SELECT * FROM metrics
WHERE server_id = 'server_7' AND "timestamp" >= TIMESTAMP '1995-01-01'
  AND "timestamp" <= TIMESTAMP '1998-12-31'"""


@oracle("cpu_peaks")
def _():
    return with_(METRICS) + 'SELECT "timestamp", server_id, cpu_usage FROM metrics WHERE cpu_usage > 90'


@oracle("error_peaks")
def _():
    return with_(METRICS) + ('SELECT "timestamp", server_id, error_rate, cpu_usage FROM metrics '
                             'WHERE error_rate > 5')


@oracle("memory_peaks")
def _():
    return with_(METRICS) + 'SELECT "timestamp", server_id, memory_usage FROM metrics WHERE memory_usage > 85'


@oracle("slow_requests")
def _():
    return with_(LOGS) + "SELECT * FROM logs WHERE response_time_ms > 500"


@oracle("retention")
def _():
    return with_(LOGS) + """SELECT * FROM logs
WHERE "timestamp" >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 30 DAY"""


@oracle("validate")
def _():
    cols = ["timestamp", "server_id", "cpu_usage", "memory_usage", "disk_io", "network_traffic",
            "request_count", "error_rate", "response_time_ms"]
    parts = ["SELECT 'missing_column' AS \"check\", 'error' AS severity, 'host' AS \"column\", "
             "CAST(0 AS BIGINT) AS value"]
    for c in cols:
        parts.append(f"SELECT 'null_values', 'warning', '{c}', CAST(count(*) - count(\"{c}\") AS BIGINT) "
                     f"FROM metrics HAVING count(*) - count(\"{c}\") > 0")
    parts.append("SELECT 'empty', 'warning', NULL, CAST(0 AS BIGINT) FROM metrics HAVING count(*) = 0")
    parts.append("SELECT 'is_valid', 'info', NULL, CAST(0 AS BIGINT)")
    return with_(METRICS) + "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------- aggregations
@oracle("server_stats")
def _():
    return with_(METRICS) + f"""SELECT server_id,
  {r('avg(cpu_usage)', 2)} AS cpu_usage_mean, {r('max(cpu_usage)', 2)} AS cpu_usage_max,
  {r('stddev_samp(cpu_usage)', 2)} AS cpu_usage_std,
  {r('avg(memory_usage)', 2)} AS memory_usage_mean, {r('max(memory_usage)', 2)} AS memory_usage_max,
  {r('stddev_samp(memory_usage)', 2)} AS memory_usage_std,
  {r('avg(response_time_ms)', 2)} AS response_time_ms_mean, {r('max(response_time_ms)', 2)} AS response_time_ms_max,
  {r('stddev_samp(response_time_ms)', 2)} AS response_time_ms_std,
  {r('avg(error_rate)', 2)} AS error_rate_mean, {r('max(error_rate)', 2)} AS error_rate_max
FROM metrics WHERE server_id IS NOT NULL GROUP BY server_id"""


@oracle("server_mean_std")
def _():
    return with_(METRICS) + f"""SELECT server_id, {r('avg(cpu_usage)', 2)} AS cpu_usage_mean,
  {r('stddev_samp(cpu_usage)', 2)} AS cpu_usage_std, {r('avg(response_time_ms)', 2)} AS response_time_ms_mean
FROM metrics WHERE server_id IS NOT NULL GROUP BY server_id"""


@oracle("hourly_stats")
def _():
    return with_(METRICS) + f"""SELECT CAST(hour("timestamp") AS BIGINT) AS hour,
  {r('avg(cpu_usage)', 2)} AS cpu_usage_mean,
  CAST(coalesce(sum(request_count), 0) AS BIGINT) AS request_count_sum,
  {r('avg(error_rate)', 2)} AS error_rate_mean, {r('avg(response_time_ms)', 2)} AS response_time_ms_mean
FROM metrics WHERE "timestamp" IS NOT NULL GROUP BY 1"""


@oracle("hourly_log_stats")
def _():
    return with_(LOGS) + f"""SELECT CAST(hour("timestamp") AS BIGINT) AS hour,
  {r('avg(response_time_ms)', 2)} AS response_time_ms_mean, count(response_code) AS response_code_count
FROM logs WHERE "timestamp" IS NOT NULL GROUP BY 1"""


@oracle("log_overview")
def _():
    return with_(LOGS) + f"""SELECT count(*) AS total_requests, count(DISTINCT client_ip) AS unique_clients,
  count(DISTINCT endpoint) AS unique_endpoints, {r('avg(response_time_ms)', 2)} AS response_time_ms_mean
FROM logs"""


@oracle("metrics_overview")
def _():
    return with_(METRICS) + """SELECT count(*) AS "rows", min("timestamp") AS first_timestamp,
  max("timestamp") AS last_timestamp, count(DISTINCT server_id) AS servers FROM metrics"""


@oracle("server_list")
def _():
    return with_(METRICS) + "SELECT DISTINCT server_id FROM metrics WHERE server_id IS NOT NULL"


@oracle("status_counts")
def _():
    return with_(LOGS) + ('SELECT response_code, count(*) AS "count" FROM logs '
                          'WHERE response_code IS NOT NULL GROUP BY 1')


@oracle("method_counts")
def _():
    return with_(LOGS) + ('SELECT request_method, count(*) AS "count" FROM logs '
                          'WHERE request_method IS NOT NULL GROUP BY 1')


@oracle("top5_endpoints")
def _():
    return with_(LOGS) + ('SELECT endpoint, count(*) AS "count" FROM logs WHERE endpoint IS NOT NULL '
                          'GROUP BY 1 ORDER BY 2 DESC, 1 ASC LIMIT 5')


@oracle("describe_response")
def _():
    q = lambda p: r(f"quantile_cont(response_time_ms, {p})", 4)
    return with_(LOGS) + f"""SELECT count(response_time_ms) AS "count", {r('avg(response_time_ms)', 4)} AS mean,
  {r('stddev_samp(response_time_ms)', 4)} AS std, min(response_time_ms) AS "min",
  max(response_time_ms) AS "max", {q(0.25)} AS p25, {q(0.5)} AS p50, {q(0.75)} AS p75 FROM logs"""


@oracle("access_log_stats")
def _():
    return with_(LOGS) + f""", w AS (
  SELECT count(*) AS total_requests, avg(response_time_ms) AS a,
         count(CASE WHEN response_code >= 400 THEN 1 END) AS error_count,
         count(DISTINCT client_ip) AS unique_ips, count(DISTINCT endpoint) AS unique_endpoints
  FROM logs WHERE "timestamp" BETWEEN TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 168 HOUR
                                  AND TIMESTAMP '2024-01-31 00:00:00')
SELECT total_requests, {r('a', 2)} AS avg_response_time, error_count,
  CASE WHEN total_requests > 0 THEN {r('error_count / total_requests * 100', 2)} ELSE 0.0 END AS error_rate,
  unique_ips, unique_endpoints FROM w""".replace("WITH logs", "WITH logs", 1)


@oracle("top_endpoints")
def _():
    return with_(LOGS) + f"""SELECT endpoint, count(*) AS request_count,
  {r('avg(response_time_ms)', 4)} AS avg_response_time,
  count(CASE WHEN response_code >= 400 THEN 1 END) AS error_count
FROM logs GROUP BY endpoint ORDER BY request_count DESC, endpoint ASC NULLS FIRST LIMIT 10"""


@oracle("slowest_endpoints")
def _():
    return with_(LOGS) + f"""SELECT endpoint, {r('m', 2)} AS response_time_ms_mean FROM (
  SELECT endpoint, avg(response_time_ms) AS m FROM logs WHERE response_time_ms > 500 AND endpoint IS NOT NULL
  GROUP BY endpoint) ORDER BY m DESC, endpoint ASC LIMIT 3"""


@oracle("busiest_server")
def _():
    return with_(METRICS) + f"""SELECT server_id, {r('m', 2)} AS cpu_usage_mean FROM (
  SELECT server_id, avg(cpu_usage) AS m FROM metrics WHERE server_id IS NOT NULL GROUP BY 1)
WHERE m IS NOT NULL ORDER BY m DESC, server_id ASC LIMIT 1"""


@oracle("peak_hour")
def _():
    return with_(METRICS) + """SELECT CAST(hour("timestamp") AS BIGINT) AS hour,
  CAST(coalesce(sum(request_count), 0) AS BIGINT) AS request_count_sum
FROM metrics WHERE "timestamp" IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 ASC LIMIT 1"""


@oracle("server_features")
def _():
    return with_(METRICS) + f"""SELECT server_id,
  {r('avg(cpu_usage)', 3)} AS cpu_usage_mean, {r('stddev_samp(cpu_usage)', 3)} AS cpu_usage_std,
  {r('max(cpu_usage)', 3)} AS cpu_usage_max, {r('avg(memory_usage)', 3)} AS memory_usage_mean,
  {r('stddev_samp(memory_usage)', 3)} AS memory_usage_std, {r('avg(response_time_ms)', 3)} AS response_time_ms_mean,
  {r('max(response_time_ms)', 3)} AS response_time_ms_max, {r('avg(error_rate)', 3)} AS error_rate_mean
FROM metrics WHERE server_id IS NOT NULL GROUP BY server_id"""


@oracle("server_recommendations")
def _():
    return with_(METRICS) + f""", s AS (
  SELECT server_id, {r('avg(cpu_usage)', 2)} AS a_cpu, {r('max(cpu_usage)', 2)} AS m_cpu,
         {r('avg(response_time_ms)', 2)} AS a_resp
  FROM metrics WHERE server_id IS NOT NULL GROUP BY server_id)
SELECT server_id, 'scale' AS rule, a_cpu AS value FROM s WHERE a_cpu > 70
UNION ALL SELECT server_id, 'cpu_spikes', m_cpu FROM s WHERE NOT (a_cpu > 70) AND m_cpu > 90
UNION ALL SELECT server_id, 'slow_response', a_resp FROM s WHERE a_resp > 200"""


def _pearson(x: str, y: str, src: str) -> str:
    xs = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN {x} END"
    ys = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN {y} END"
    return (f"(SELECT CASE WHEN stddev_samp({xs}) * stddev_samp({ys}) <> 0 "
            f"THEN covar_samp({xs}, {ys}) / (stddev_samp({xs}) * stddev_samp({ys})) END FROM {src})")


@oracle("fleet_recommendations")
def _():
    return with_(METRICS) + f""", s AS (
  SELECT {_pearson('cpu_usage', 'response_time_ms', 'metrics')} AS c,
         (SELECT count(*) FROM metrics WHERE error_rate > 5) AS e,
         (SELECT avg(response_time_ms) FROM metrics) AS a)
SELECT 'optimize_compute' AS rule, {r('c', 4)} AS value FROM s WHERE c > 0.7
UNION ALL SELECT 'investigate_errors', CAST(e AS DOUBLE) FROM s WHERE e > 10
UNION ALL SELECT 'optimize_latency', {r('a', 4)} FROM s WHERE a > 200"""


@oracle("correlation_matrix")
def _():
    cols = ["cpu_usage", "memory_usage", "response_time_ms", "error_rate"]
    parts = []
    for a in cols:
        for b in cols:
            v = "1.0" if a == b else r(_pearson(a, b, "metrics"), 3)
            parts.append(f"SELECT '{a}' AS x, '{b}' AS y, {v} AS r")
    return with_(METRICS) + "\nUNION ALL\n".join(parts)


@oracle("cpu_response_corr")
def _():
    return with_(METRICS) + f"SELECT {r(_pearson('cpu_usage', 'response_time_ms', 'metrics'), 3)} AS cpu_response_corr"


@oracle("response_histogram")
def _():
    return with_(METRICS) + f""", d AS (SELECT server_id, response_time_ms AS v FROM metrics
                WHERE server_id IS NOT NULL AND response_time_ms IS NOT NULL),
g AS (SELECT server_id, min(v) AS mn, max(v) AS mx FROM d GROUP BY 1),
e AS (SELECT server_id, CASE WHEN mx > mn THEN mn ELSE mn - 0.5 END AS lo,
                        CASE WHEN mx > mn THEN mx ELSE mx + 0.5 END AS hi FROM g),
b AS (SELECT d.server_id, e.lo, e.hi,
             CAST(least(floor((v - e.lo) / ((e.hi - e.lo) / 20.0)), 19) AS INTEGER) AS bin
      FROM d JOIN e USING (server_id))
SELECT server_id, bin, {r('lo + (hi - lo) * bin / 20', 6)} AS lo,
       {r('lo + (hi - lo) * (bin + 1) / 20', 6)} AS hi, count(*) AS "count"
FROM b GROUP BY server_id, bin, b.lo, b.hi"""


@oracle("null_profile")
def _():
    cols = ["timestamp", "cpu_usage", "memory_usage", "disk_io", "network_traffic",
            "request_count", "error_rate", "response_time_ms"]
    parts = [f"SELECT server_id, '{c}' AS \"column\", count(*) - count(\"{c}\") AS nulls, count(*) AS \"rows\" "
             f"FROM metrics GROUP BY server_id" for c in cols]
    return with_(METRICS) + "\nUNION ALL\n".join(parts)


@oracle("cpu_trend")
def _():
    return with_(METRICS) + 'SELECT server_id, "timestamp", cpu_usage FROM metrics ORDER BY 1, 2'


@oracle("kde_curve")
def _():
    return with_(METRICS_EV) + f""", d AS (SELECT server_id, cpu_usage AS v FROM metrics_ev
                WHERE server_id IS NOT NULL AND cpu_usage IS NOT NULL),
st AS (SELECT server_id, count(*) AS n, stddev_samp(v) AS sd, min(v) AS mn, max(v) AS mx FROM d GROUP BY 1
       HAVING max(v) > min(v) AND stddev_samp(v) > 0),
h AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw FROM st),
vc AS (SELECT server_id, v, count(*) AS c FROM d GROUP BY 1, 2),
gr AS (SELECT h.*, g.range AS p, mn + (mx - mn) * g.range / 199.0 AS x FROM h, range(0, 200) g)
SELECT gr.server_id, CAST(gr.p AS INTEGER) AS point, {r('gr.x', 6)} AS x,
       {r('sum(vc.c * exp(-0.5 * ((gr.x - vc.v) / gr.bw) * ((gr.x - vc.v) / gr.bw))) / (gr.n * gr.bw * sqrt(2 * pi()))', 8)} AS density
FROM gr JOIN vc ON gr.server_id = vc.server_id
GROUP BY gr.server_id, gr.p, gr.x, gr.n, gr.bw"""


@oracle("heavy_endpoints")
def _():
    return with_(LOGS) + f"""SELECT endpoint, count(*) AS requests,
  CAST(coalesce(sum(response_size), 0) AS BIGINT) AS total_bytes,
  {r('avg(response_time_ms)', 2)} AS response_time_ms_mean, {r('sum(response_time_ms)', 2)} AS response_time_ms_sum
FROM logs WHERE endpoint IS NOT NULL GROUP BY endpoint"""


@oracle("status_class_share")
def _():
    return with_(LOGS) + f""", c AS (
  SELECT CAST(CAST(floor(response_code / 100) AS BIGINT) AS VARCHAR) || 'xx' AS status_class, count(*) AS requests
  FROM logs WHERE response_code IS NOT NULL GROUP BY 1)
SELECT status_class, requests, {r('requests / (SELECT sum(requests) FROM c) * 100', 2)} AS share_pct FROM c"""


@oracle("suspicious_clients")
def _():
    return with_(LOGS) + f""", s AS (
  SELECT client_ip, count(*) AS requests, count(DISTINCT endpoint) AS distinct_endpoints,
         count(CASE WHEN response_code >= 400 THEN 1 END) AS errors
  FROM logs WHERE client_ip IS NOT NULL GROUP BY client_ip)
SELECT client_ip, requests, distinct_endpoints, errors, {r('errors / requests', 4)} AS error_share
FROM s WHERE requests >= 1 AND (distinct_endpoints >= 7 OR {r('errors / requests', 4)} >= 0.25)"""


# ---------------------------------------------------------------- log parsing
PARSED = f"""SELECT date_trunc('second', "timestamp") AS "timestamp", client_ip, request_method, endpoint,
  response_code, response_size, {r('response_time_ms', 2)} AS response_time_ms, referer, user_agent"""


@oracle("parse_access_log")
def _():
    return with_(LOGS_K) + PARSED + " FROM logs_k WHERE k NOT IN (0, 1, 2, 3, 4, 5)"


@oracle("parse_errors")
def _():
    return with_(LOGS_K) + """SELECT CASE WHEN k = 1 THEN 'bad_timestamp' ELSE 'no_match' END AS reason,
  count(*) AS lines FROM logs_k WHERE k IN (0, 1, 2, 3, 4) GROUP BY 1"""


@oracle("parse_nginx_rt")
def _():
    return (with_(LOGS_K) + PARSED + ", CAST(NULL AS VARCHAR) AS remote_user, "
            "CAST(NULL AS VARCHAR) AS x_forwarded_for FROM logs_k WHERE k = 4")


# ---------------------------------------------------------------- time series
HOURLY_EV = """h AS (SELECT date_trunc('hour', "timestamp") AS hour, avg(cpu_usage) AS m
      FROM metrics_ev WHERE "timestamp" IS NOT NULL GROUP BY 1)"""


@oracle("hourly_resample")
def _():
    return with_(METRICS_EV, HOURLY_EV) + f""", s AS (
  SELECT unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM h)
SELECT s.hour, {r('h.m', 6)} AS cpu_usage_mean FROM s LEFT JOIN h USING (hour)"""


@oracle("forecast_load")
def _():
    return with_(METRICS_EV, HOURLY_EV) + f""",
b AS (SELECT min(hour) AS lo, max(hour) AS hi FROM h),
s AS (SELECT unnest(generate_series(greatest(lo, hi - INTERVAL 7 HOUR), hi, INTERVAL 1 HOUR)) AS hour FROM b),
j AS (SELECT s.hour, h.m FROM s LEFT JOIN h USING (hour)),
w AS (SELECT hour, count(m) OVER (ORDER BY hour ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c,
             avg(m) OVER (ORDER BY hour ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS a,
             row_number() OVER (ORDER BY hour DESC) AS pos FROM j)
SELECT hour, CASE WHEN c = 3 THEN {r('a', 6)} END AS forecast FROM w WHERE pos <= 6"""


def _intervals(src: str, key: str | None) -> str:
    k = f"{key}, " if key else ""
    part = f"PARTITION BY {key} " if key else ""
    notnull = f" AND {key} IS NOT NULL" if key else ""
    grp = f"GROUP BY {key}" if key else ""
    join_on = f"USING ({key})" if key else "ON TRUE"
    return f"""d AS (SELECT {k}"timestamp" AS t, lag("timestamp") OVER ({part}ORDER BY "timestamp") AS p
      FROM {src} WHERE "timestamp" IS NOT NULL{notnull}),
c AS (SELECT {k}epoch_us(t) - epoch_us(p) AS diff_us, count(*) AS cnt FROM d WHERE p IS NOT NULL
      GROUP BY {k}epoch_us(t) - epoch_us(p)),
m AS (SELECT {k}diff_us AS mode_us FROM (
        SELECT {k}diff_us, row_number() OVER ({part}ORDER BY cnt DESC, diff_us ASC) AS rn FROM c) WHERE rn = 1),
st AS (SELECT {k}count(*) AS n, min(t) AS f, max(t) AS l FROM d {grp}),
sm AS (SELECT st.*, m.mode_us FROM st LEFT JOIN m {join_on}),
e AS (SELECT {k}n, CAST(CASE WHEN n < 2 THEN n WHEN mode_us IS NULL OR mode_us <= 0 THEN n
                  ELSE floor((epoch_us(l) - epoch_us(f)) / mode_us + 1) END AS BIGINT) AS expected FROM sm)"""


@oracle("modal_interval")
def _():
    return with_(METRICS, _intervals("metrics", "server_id")) + \
        "SELECT server_id, mode_us / 1000000 AS mode_seconds FROM sm"


def _completeness_sql(key):
    k = f"{key}, " if key else ""
    return f"""SELECT {k}expected, n AS actual,
  CASE WHEN expected > 0 THEN {r('n / expected * 100', 2)} ELSE 0.0 END AS completeness_pct FROM e"""


@oracle("completeness_by_server")
def _():
    return with_(METRICS, _intervals("metrics", "server_id")) + _completeness_sql("server_id")


@oracle("completeness_total")
def _():
    return with_(METRICS, _intervals("metrics", None)) + _completeness_sql(None)


@oracle("client_completeness")
def _():
    return with_(LOGS, _intervals("logs", "client_ip")) + _completeness_sql("client_ip")


# ---------------------------------------------------------------- anomalies
EV_COLS = ["cpu_usage", "memory_usage", "response_time_ms", "error_rate"]


@oracle("anomalies_zscore")
def _():
    stats = ", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS s{i}" for i, c in enumerate(EV_COLS))
    hit = " OR ".join(f"coalesce(CASE WHEN s{i} <> 0 THEN abs(({c} - m{i}) / s{i}) END > 3, false)"
                      for i, c in enumerate(EV_COLS))
    return with_(METRICS_EV) + f""", s AS (SELECT {stats} FROM metrics_ev)
SELECT DISTINCT metrics_ev.* FROM metrics_ev, s WHERE {hit}"""


def _quartiles():
    return ", ".join(f"quantile_cont({c}, 0.25) AS q1_{i}, quantile_cont({c}, 0.75) AS q3_{i}"
                     for i, c in enumerate(EV_COLS))


@oracle("anomalies_iqr")
def _():
    hit = " OR ".join(
        f"coalesce({c} < q1_{i} - 1.5 * (q3_{i} - q1_{i}) OR {c} > q3_{i} + 1.5 * (q3_{i} - q1_{i}), false)"
        for i, c in enumerate(EV_COLS))
    return with_(METRICS_EV) + f""", q AS (SELECT {_quartiles()} FROM metrics_ev)
SELECT DISTINCT metrics_ev.* FROM metrics_ev, q WHERE {hit}"""


@oracle("iqr_fences")
def _():
    parts = [f"""SELECT '{c}' AS "column", q1_{i} AS q1, q3_{i} AS q3, q3_{i} - q1_{i} AS iqr,
  q1_{i} - 1.5 * (q3_{i} - q1_{i}) AS lower, q3_{i} + 1.5 * (q3_{i} - q1_{i}) AS upper FROM q"""
             for i, c in enumerate(EV_COLS)]
    return with_(METRICS_EV) + f", q AS (SELECT {_quartiles()} FROM metrics_ev)\n" + "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------- inference
@oracle("anova")
def _():
    # F(4, d2) survival function in closed form (k = 5 groups):
    #   x = d2 / (d2 + 4F), a = d2 / 2, sf = x^a (1 + a (1 - x))
    return with_(METRICS_EV) + f""", g AS (
  SELECT server_id, count(*) AS n, avg(cpu_usage) AS m, var_samp(cpu_usage) AS v
  FROM metrics_ev WHERE server_id IS NOT NULL AND cpu_usage IS NOT NULL GROUP BY 1),
t AS (SELECT count(*) AS k, sum(n) AS N, sum(n * m) / sum(n) AS gm FROM g),
f AS (SELECT k, N, (SELECT sum(n * (m - gm) * (m - gm)) FROM g) / (k - 1)
                 / ((SELECT sum((n - 1) * v) FROM g) / (N - k)) AS fs FROM t),
x AS (SELECT *, (N - k) / ((N - k) + 4 * fs) AS xx, (N - k) / 2.0 AS a FROM f)
SELECT {r('fs', 4)} AS f_statistic, {r('pow(xx, a) * (1 + a * (1 - xx))', 4)} AS p_value,
  pow(xx, a) * (1 + a * (1 - xx)) > 0.05 AS homogeneous,
  CAST(k - 1 AS BIGINT) AS df_between, CAST(N - k AS BIGINT) AS df_within FROM x WHERE k = 5"""


@oracle("kruskal_wallis")
def _():
    # chi-square(4) survival function in closed form: exp(-h/2) (1 + h/2)
    return with_(METRICS_EV) + f""", d AS (
  SELECT server_id, cpu_usage AS v FROM metrics_ev WHERE server_id IS NOT NULL AND cpu_usage IS NOT NULL),
rk AS (SELECT server_id, v, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rnk FROM d),
g AS (SELECT server_id, sum(rnk) AS R, count(*) AS n FROM rk GROUP BY 1),
ties AS (SELECT sum(pow(c, 3) - c) AS tt FROM (SELECT count(*) AS c FROM d GROUP BY v)),
tot AS (SELECT CAST(count(*) AS DOUBLE) AS N FROM d),
h AS (SELECT (12.0 / (N * (N + 1)) * (SELECT sum(R * R / n) FROM g) - 3 * (N + 1))
             / (1 - (SELECT tt FROM ties) / (N * N * N - N)) AS h,
             (SELECT count(*) FROM g) AS k FROM tot)
SELECT {r('h', 4)} AS h_statistic, {r('exp(-h / 2) * (1 + h / 2)', 4)} AS p_value,
  exp(-h / 2) * (1 + h / 2) > 0.05 AS homogeneous, CAST(k - 1 AS BIGINT) AS df FROM h WHERE k = 5"""


@oracle("confidence_intervals")
def _():
    # Student-t 0.975 quantile by the Cornish-Fisher expansion around the
    # normal quantile z (accurate to ~1e-10 for the ~1e4 degrees of freedom here)
    z = "CAST(1.959963984540054 AS DOUBLE)"
    t = (f"({z} + ({z}^3 + {z}) / (4 * nu) + (5 * {z}^5 + 16 * {z}^3 + 3 * {z}) / (96 * nu^2)"
         f" + (3 * {z}^7 + 19 * {z}^5 + 17 * {z}^3 - 15 * {z}) / (384 * nu^3)"
         f" + (79 * {z}^9 + 776 * {z}^7 + 1482 * {z}^5 - 1920 * {z}^3 - 945 * {z}) / (92160 * nu^4))")
    parts = [f"SELECT '{c}' AS metric, count({c}) AS n, avg({c}) AS m, stddev_samp({c}) AS s FROM metrics_ev"
             for c in EV_COLS]
    return with_(METRICS_EV) + f""", a AS ({" UNION ALL ".join(parts)}),
b AS (SELECT *, CAST(n - 1 AS DOUBLE) AS nu FROM a WHERE n >= 2),
c AS (SELECT *, {t} AS t, s / sqrt(n) AS se FROM b),
d AS (SELECT *, t * se AS moe FROM c)
SELECT metric, {r('m', 4)} AS mean, {r('s', 4)} AS std_dev, CAST(n AS BIGINT) AS sample_size,
  0.95 AS confidence_level, {r('t', 4)} AS t_critical, {r('se', 4)} AS standard_error,
  {r('moe', 4)} AS margin_of_error, {r('m - moe', 4)} AS ci_lower, {r('m + moe', 4)} AS ci_upper,
  {r('CASE WHEN m <> 0 THEN moe / m * 100 ELSE 0.0 END', 2)} AS relative_error_percent FROM d"""


PAIRS = """pairs AS (
  SELECT o.o_orderkey AS seq, l.p / 1000 AS predicted, o.o_totalprice / 1000 AS actual
  FROM orders o LEFT JOIN (
    SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS p
    FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey)"""


@oracle("error_metrics")
def _():
    return with_(PAIRS) + f""", e AS (
  SELECT seq, predicted - actual AS e, actual AS a FROM pairs
  WHERE predicted IS NOT NULL AND actual IS NOT NULL AND NOT isnan(predicted) AND NOT isnan(actual)),
l AS (SELECT *, lag(e) OVER (ORDER BY seq) AS pe FROM e)
SELECT count(*) AS n, {r('avg(abs(e))', 4)} AS mae, {r('avg(e * e)', 4)} AS mse,
  {r('sqrt(avg(e * e))', 4)} AS rmse,
  {r('avg(CASE WHEN a <> 0 THEN abs(e / a) END) * 100', 4)} AS mape,
  {r('CASE WHEN var_pop(a) * count(a) <> 0 THEN 1 - sum(e * e) / (var_pop(a) * count(a)) END', 4)} AS r_squared,
  {r('CASE WHEN count(*) > 1 AND sum(e * e) <> 0 THEN sum((e - pe) * (e - pe)) / sum(e * e) END', 4)} AS durbin_watson
FROM l HAVING count(*) > 0"""


# ---------------------------------------------------------------- composites
def long_sql(inner: str, section: str, subject: str | None, metrics: list[str]) -> str:
    subj = "CAST(NULL AS VARCHAR)" if subject is None else f"CAST({subject} AS VARCHAR)"
    return "\nUNION ALL\n".join(
        f"SELECT '{section}' AS section, {subj} AS subject, '{m}' AS metric, "
        f"CAST(x.{m} AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM ({inner}) AS x"
        for m in metrics)


@oracle("basic_report")
def _():
    fleet = ORACLE["fleet_recommendations"]
    return "\nUNION ALL\n".join([
        long_sql(ORACLE["busiest_server"], "busiest_server", "server_id", ["cpu_usage_mean"]),
        long_sql(ORACLE["peak_hour"], "peak_hour", None, ["hour", "request_count_sum"]),
        long_sql(ORACLE["cpu_response_corr"], "correlation", None, ["cpu_response_corr"]),
        f"SELECT 'recommendation' AS section, CAST(NULL AS VARCHAR) AS subject, rule AS metric, "
        f"CAST(value AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM ({fleet}) AS f"])


@oracle("stat_report")
def _():
    ci = ["mean", "std_dev", "sample_size", "confidence_level", "t_critical", "standard_error",
          "margin_of_error", "ci_lower", "ci_upper", "relative_error_percent"]
    comp = ["expected", "actual", "completeness_pct"]
    total = with_(METRICS_EV, _intervals("metrics_ev", None)) + _completeness_sql(None)
    by = with_(METRICS_EV, _intervals("metrics_ev", "server_id")) + _completeness_sql("server_id")
    return "\nUNION ALL\n".join([
        long_sql(total, "completeness", "'all'", comp),
        long_sql(by, "completeness", "server_id", comp),
        long_sql(ORACLE["kruskal_wallis"], "homogeneity", None, ["h_statistic", "p_value", "homogeneous"]),
        long_sql(ORACLE["confidence_intervals"], "confidence_intervals", "metric", ci),
        long_sql(ORACLE["error_metrics"], "error_metrics", None,
                 ["mae", "mse", "rmse", "mape", "r_squared", "durbin_watson"])])


# ---------------------------------------------------------------- sources and sinks
@oracle("compact")
def _():
    return with_(METRICS) + "SELECT * FROM metrics"


@oracle("load_metrics")
def _():
    return with_(METRICS) + "SELECT * FROM metrics"


@oracle("load_logs")
def _():
    return with_(LOGS) + "SELECT * FROM logs"


@oracle("table_filter")
def _():
    return ORACLE["metrics_filter"]


@oracle("table_retention")
def _():
    return with_(LOGS) + """SELECT * FROM logs WHERE "timestamp" >= TIMESTAMP '2024-01-24 00:00:00'"""


@oracle("table_log_stats")
def _():
    return ORACLE["access_log_stats"]


@oracle("error_hours")
def _():
    return with_(LOGS) + """, worst AS (SELECT date_trunc('hour', "timestamp") AS h FROM logs WHERE response_code >= 400
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3)
SELECT h AS "hour", endpoint, count(*) AS requests, count(CASE WHEN response_code >= 400 THEN 1 END) AS errors
FROM logs JOIN worst ON date_trunc('hour', "timestamp") = h GROUP BY 1, 2"""


@oracle("csv_roundtrip")
def _():
    return with_(METRICS) + "SELECT * FROM metrics"


@oracle("hybrid_sources")
def _():
    return with_(METRICS, METRICS_EV) + """SELECT 'metrics' AS source, count(*) AS "rows" FROM metrics
UNION ALL SELECT 'metrics_ev', count(*) FROM metrics_ev"""


@oracle("chunk_summary")
def _():
    return with_(METRICS) + f"""SELECT CAST(count(*) AS BIGINT) AS "rows", {r('avg(cpu_usage)', 6)} AS avg_cpu,
  max(response_time_ms) AS max_response FROM metrics"""


@oracle("chunk_apply")
def _():
    return with_(METRICS) + """SELECT *, CASE WHEN cpu_usage IS NULL THEN NULL WHEN cpu_usage <= 30 THEN 'low'
  WHEN cpu_usage <= 70 THEN 'normal' WHEN cpu_usage <= 90 THEN 'high' ELSE 'critical' END AS load_level
FROM metrics"""


@oracle("logs_metrics_join")
def _():
    return with_(LOGS, METRICS_EV) + f""", lg AS (
  SELECT date_trunc('hour', "timestamp") AS bucket, count(*) AS requests,
         count(CASE WHEN response_code >= 400 THEN 1 END) AS errors,
         {r('avg(response_time_ms)', 4)} AS response_time_ms_mean
  FROM logs WHERE "timestamp" IS NOT NULL GROUP BY 1),
mt AS (SELECT date_trunc('hour', "timestamp") AS bucket, {r('avg(cpu_usage)', 4)} AS cpu_usage_mean,
              max(cpu_usage) AS cpu_usage_max FROM metrics_ev WHERE "timestamp" IS NOT NULL GROUP BY 1)
SELECT * FROM lg JOIN mt USING (bucket)"""


# ---------------------------------------------------------------- streaming
@oracle("stream_alerts")
def _():
    return with_(METRICS_EV) + """SELECT "timestamp", server_id, 'cpu' AS rule, cpu_usage AS value FROM metrics_ev
WHERE cpu_usage > 90
UNION ALL SELECT "timestamp", server_id, 'error_rate', error_rate FROM metrics_ev WHERE error_rate > 5
UNION ALL SELECT "timestamp", server_id, 'response_time', response_time_ms FROM metrics_ev
WHERE response_time_ms > 500"""


@oracle("stream_hourly")
def _():
    return with_(METRICS_EV) + f"""SELECT date_trunc('hour', "timestamp") AS hour, server_id, count(*) AS events,
  {r('avg(cpu_usage)', 6)} AS cpu_usage_mean, max(cpu_usage) AS cpu_usage_max
FROM metrics_ev WHERE "timestamp" IS NOT NULL GROUP BY 1, 2"""


# ---------------------------------------------------------------- rows that tell right from wrong
EV_REQUESTS = "ev_r AS (SELECT *, seq % 10 AS request_count FROM metrics_ev)"


@oracle("retention_recent")
def _():
    return with_(LOGS) + """SELECT * FROM logs
WHERE "timestamp" >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY"""


@oracle("validate_events")
def _():
    return with_(METRICS_EV) + "\nUNION ALL\n".join(
        [f"SELECT 'null_values' AS \"check\", 'warning' AS severity, '{c}' AS \"column\", CAST(count(*) - count(\"{c}\") AS BIGINT) AS value "
         f"FROM metrics_ev HAVING count(*) - count(\"{c}\") > 0" for c in ("timestamp", "server_id", "cpu_usage", "memory_usage")]
        + ["SELECT 'is_valid', 'info', NULL, CAST(1 AS BIGINT)"])


@oracle("hourly_stats_events")
def _():
    return with_(METRICS_EV, EV_REQUESTS) + f"""SELECT CAST(hour("timestamp") AS BIGINT) AS hour, {r('avg(cpu_usage)', 2)} AS cpu_usage_mean,
  CAST(coalesce(sum(request_count), 0) AS BIGINT) AS request_count_sum,
  {r('avg(error_rate)', 2)} AS error_rate_mean, {r('avg(response_time_ms)', 2)} AS response_time_ms_mean
FROM ev_r GROUP BY 1"""


@oracle("peak_hour_events")
def _():
    return with_(METRICS_EV, EV_REQUESTS) + """SELECT CAST(hour("timestamp") AS BIGINT) AS hour,
  CAST(sum(request_count) AS BIGINT) AS request_count_sum FROM ev_r GROUP BY 1 ORDER BY 2 DESC, 1 ASC LIMIT 1"""


@oracle("null_profile_hourly")
def _():
    return with_(METRICS_EV) + "\nUNION ALL\n".join(
        f"SELECT server_id, CAST(hour(\"timestamp\") AS BIGINT) AS hour, '{c}' AS \"column\", count(*) - count({c}) AS nulls, count(*) AS \"rows\" "
        f"FROM metrics_ev GROUP BY 1, 2" for c in ("cpu_usage", "memory_usage"))


@oracle("parse_log_files")
def _():
    return ORACLE["parse_access_log"]


@oracle("parse_log_file_errors")
def _():
    return f"SELECT reason, lines, lines AS with_file FROM ({ORACLE['parse_errors']})"


@oracle("hybrid_union")
def _():
    return with_(METRICS, METRICS_EV, LOGS) + """SELECT *, 'metrics' AS source FROM metrics
UNION ALL BY NAME SELECT *, 'metrics_ev' AS source FROM metrics_ev
UNION ALL BY NAME SELECT *, 'access_logs' AS source FROM logs"""


@oracle("storage_footprint")
def _():
    return "\nUNION ALL\n".join(f"SELECT '{f}' AS format, count(*) AS \"rows\", true AS has_bytes, {below} AS below_csv FROM lineitem"
                               for f, below in (("csv", "false"), ("parquet_snappy", "true"), ("parquet_gzip", "true"), ("json", "false")))


@oracle("anova_offset")
def _():
    return ORACLE["anova"].replace("value AS cpu_usage", "value / 1000 + 1e7 AS cpu_usage")


@oracle("advanced_report_sections")
def _():
    cols = EV_COLS
    first = f"""SELECT strftime("timestamp", '%Y-%m-%d %H:%M:%S') || ' ' || server_id AS subject, {", ".join(cols)}
FROM ({ORACLE["anomalies_zscore"]}) ORDER BY "timestamp", server_id, {", ".join(f"{c} NULLS FIRST" for c in cols)} LIMIT 5"""
    forecast = f"SELECT strftime(hour, '%Y-%m-%d %H:%M') AS subject, forecast FROM ({ORACLE['forecast_load']})"
    recommended = f"""{with_(METRICS_EV)}, s AS (SELECT server_id, {r('avg(cpu_usage)', 2)} AS a_cpu, {r('max(cpu_usage)', 2)} AS m_cpu,
  {r('avg(response_time_ms)', 2)} AS a_resp FROM metrics_ev WHERE server_id IS NOT NULL GROUP BY 1)
SELECT server_id, CASE WHEN a_cpu > 70 THEN 'scale' ELSE 'cpu_spikes' END AS rule, CASE WHEN a_cpu > 70 THEN a_cpu ELSE m_cpu END AS value
FROM s WHERE a_cpu > 70 OR m_cpu > 90
UNION ALL SELECT server_id, 'slow_response', a_resp FROM s WHERE a_resp > 200"""
    return "\nUNION ALL\n".join([
        long_sql(f"SELECT count(*) AS anomalous_rows FROM ({ORACLE['anomalies_zscore']})", "anomalies", None, ["anomalous_rows"]),
        long_sql(first, "anomaly_rows", "subject", cols), long_sql(forecast, "forecast", "subject", ["forecast"]),
        f"SELECT 'recommendation' AS section, server_id AS subject, rule AS metric, CAST(value AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM ({recommended})"])


# ---------------------------------------------------------------- normality
def _poly_sql(c: list[float], x: str) -> str:
    out = "0.0"
    for v in reversed(c):
        out = f"({out} * ({x}) + ({v!r}))"
    return out


# Acklam's rational approximation of the normal quantile (relative
# error 1.2e-9; the Spark form uses another one), highest power first.
_QA = [-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239]
_QB = [-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0]
_QC = [-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783]
_QD = [0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0]


def _quantile(p: str) -> str:
    centre = f"({p} - 0.5) * {_poly_sql(_QA[::-1], f'({p} - 0.5) * ({p} - 0.5)')} / {_poly_sql(_QB[::-1], f'({p} - 0.5) * ({p} - 0.5)')}"
    tail = lambda q: f"{_poly_sql(_QC[::-1], f'sqrt(-2 * ln({q}))')} / {_poly_sql(_QD[::-1], f'sqrt(-2 * ln({q}))')}"
    return f"(CASE WHEN {p} < 0.02425 THEN {tail(p)} WHEN {p} > 1 - 0.02425 THEN -({tail(f'(1 - {p})')}) ELSE {centre} END)"


def _normal_tail(z: str) -> str:
    """Upper tail of the normal distribution (Abramowitz and Stegun 26.2.17)."""
    t = f"(1 / (1 + 0.2316419 * abs({z})))"
    upper = f"exp(-({z}) * ({z}) / 2) / sqrt(2 * pi()) * {t} * {_poly_sql([0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429], t)}"
    return f"(CASE WHEN {z} >= 0 THEN {upper} ELSE 1 - {upper} END)"


def normality_sql(source: str) -> str:
    """Shapiro-Wilk (AS R94, groups above 11 values) of ``source(server_id, v)``."""
    c1, c2 = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056], [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
    mu, sd = [-1.5861, -0.31082, -0.083751, 0.0038915], [-0.4803, -0.082676, 0.0030302]
    z = f"((ln(1 - w) - {_poly_sql(mu, 'ln(n)')}) / exp({_poly_sql(sd, 'ln(n)')}))"
    return f"""n_d AS (SELECT server_id, v, row_number() OVER (PARTITION BY server_id ORDER BY v) AS i, count(*) OVER (PARTITION BY server_id) AS n
  FROM {source} WHERE server_id IS NOT NULL AND v IS NOT NULL),
n_m AS (SELECT *, {_quantile('((i - 0.375) / (n + 0.25))')} AS m FROM n_d),
n_s AS (SELECT server_id, CAST(max(n) AS DOUBLE) AS n, sqrt(sum(m * m)) AS root, max(CASE WHEN i = 1 THEN m END) AS m1, max(CASE WHEN i = 2 THEN m END) AS m2,
  sum(m * m) AS mm, var_pop(v) * max(n) AS ss, avg(v) AS mean FROM n_m GROUP BY 1 HAVING max(n) > 11),
n_a AS (SELECT *, {_poly_sql(c1, '1 / sqrt(n)')} - m1 / root AS a1, {_poly_sql(c2, '1 / sqrt(n)')} - m2 / root AS a2 FROM n_s),
n_f AS (SELECT *, sqrt((mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2)) AS fac FROM n_a),
n_w AS (SELECT server_id, n_f.n AS n, pow(sum((CASE WHEN i = 1 THEN -a1 WHEN i = 2 THEN -a2 WHEN i = n_m.n - 1 THEN a2 WHEN i = n_m.n THEN a1 ELSE m / fac END) * (v - mean)), 2) / any_value(ss) AS w
  FROM n_m JOIN n_f USING (server_id) GROUP BY 1, 2),
n_b AS (SELECT server_id, avg(v) AS mean, var_pop(v) AS var FROM n_d GROUP BY 1),
n_k AS (SELECT server_id, avg(pow(v - mean, 3)) / pow(any_value(var), 1.5) AS sk, avg(pow(v - mean, 4)) / pow(any_value(var), 2) - 3 AS ku
  FROM n_d JOIN n_b USING (server_id) GROUP BY 1),
n_p AS (SELECT server_id, CAST(n AS BIGINT) AS n, w, CASE WHEN n <= 5000 THEN {_normal_tail(z)} END AS p, sk, ku,
  exp(-n / 12 * (sk * sk + ku * ku / 4)) AS jb FROM n_w JOIN n_k USING (server_id))"""


def _log_cdf(z: str) -> str:
    """Logarithm of the normal distribution function: a series in the middle, a
    continued fraction beyond 4 (the Spark form uses rational approximations)."""
    def beyond(x: str) -> str:
        fraction = x
        for i in range(60, 0, -1):
            fraction = f"({x} + {i} / {fraction})"
        return f"(-{x} * {x} / 2 - ln(2 * pi()) / 2 - ln({fraction}))"
    square = f"greatest({z} * {z}, 1e-300)"
    series = f"list_sum(list_transform(range(0, 80), lambda k: exp(k * ln({square}) - lgamma(2 * k + 2) + k * ln(2) + lgamma(k + 1))))"
    return (f"(CASE WHEN {z} < -4 THEN {beyond(f'(-{z})')} WHEN {z} > 4 THEN ln(1 - exp({beyond(z)})) "
            f"ELSE ln(0.5 + exp(-{z} * {z} / 2) / sqrt(2 * pi()) * {z} * {series}) END)")


def anderson_sql(source: str) -> str:
    """Anderson-Darling of ``source(server_id, v)``, with every rank a row."""
    p = {"large": "exp(1.2937 - 5.709 * A + 0.0186 * A * A)", "middle": "exp(0.9177 - 4.279 * A - 1.38 * A * A)",
         "small": "1 - exp(-8.318 + 42.796 * A - 59.938 * A * A)", "least": "1 - exp(-13.436 + 101.14 * A - 223.73 * A * A)"}
    return f"""a_m AS (SELECT server_id, avg(v) AS mean, stddev_samp(v) AS sd FROM {source} WHERE server_id IS NOT NULL AND v IS NOT NULL GROUP BY 1),
a_z AS (SELECT server_id, CAST((v - mean) / sd AS DOUBLE) AS z, row_number() OVER (PARTITION BY server_id ORDER BY v) AS i, count(*) OVER (PARTITION BY server_id) AS n
  FROM {source} JOIN a_m USING (server_id) WHERE v IS NOT NULL),
a_l AS (SELECT server_id, i, n, {_log_cdf('z')} AS lower, {_log_cdf('(-z)')} AS upper FROM a_z),
a_s AS (SELECT server_id, n, -n - sum((2 * i - 1) * lower + (2 * (n - i) + 1) * upper) / n AS raw FROM a_l GROUP BY 1, 2),
a_c AS (SELECT server_id, n, raw * (1 + 0.75 / n + 2.25 / (n * n)) AS A FROM a_s),
a_p AS (SELECT server_id, n, A, CASE WHEN A >= 13 THEN 0.0 WHEN A >= 0.6 THEN {p['large']} WHEN A > 0.34 THEN {p['middle']}
  WHEN A > 0.2 THEN {p['small']} ELSE {p['least']} END AS p FROM a_c)"""


_ANDERSON = f"SELECT server_id, n, {r('A', 4)} AS statistic, {r('p', 4)} AS p_value, p > 0.05 AS is_normal FROM a_p"


_NORMALITY = (f"SELECT server_id, n, {r('w', 4)} AS statistic, {r('p', 4)} AS p_value, p > 0.05 AS is_normal, {r('sk', 4)} AS skewness, "
              f"{r('ku', 4)} AS kurtosis, {r('jb', 4)} AS jb_p_value, CASE WHEN n > 5000 THEN 'n > 5000' END AS reason FROM n_p")
_EV_VALUES = "ev_v AS (SELECT server_id, cpu_usage AS v FROM metrics_ev)"


@oracle("normality_test")
def _():
    return with_(METRICS_EV, _EV_VALUES, normality_sql("ev_v")) + _NORMALITY


def _homogeneity(ctes: list[str], source: str, groups: int, large: bool = False) -> str:
    """Normality rows, ANOVA if all are normal, Kruskal-Wallis; closed forms for
    an even number of degrees of freedom between groups.  ``large``: every group
    has more than 5,000 values and is judged by Anderson-Darling."""
    half = (groups - 1) // 2
    f_tail = "pow(xx, a)" if half == 1 else "pow(xx, a) * (1 + a * (1 - xx))"
    h_tail = "exp(-h / 2)" if half == 1 else "exp(-h / 2) * (1 + h / 2)"
    base = with_(*ctes, normality_sql(source), *([anderson_sql(source)] if large else []))
    anova = f"""{base}, g AS (SELECT server_id, count(*) AS n, avg(v) AS m, var_samp(v) AS v FROM {source} WHERE v IS NOT NULL GROUP BY 1),
t AS (SELECT count(*) AS k, sum(n) AS N, sum(n * m) / sum(n) AS gm FROM g),
f AS (SELECT k, N, (SELECT sum(n * (m - gm) * (m - gm)) FROM g) / (k - 1) / ((SELECT sum((n - 1) * v) FROM g) / (N - k)) AS fs FROM t),
x AS (SELECT *, (N - k) / ((N - k) + (k - 1) * fs) AS xx, (N - k) / 2.0 AS a FROM f)
SELECT {r('fs', 4)} AS f_statistic, {r(f_tail, 4)} AS p_value, {f_tail} > 0.05 AS homogeneous FROM x
WHERE (SELECT coalesce(bool_and(coalesce(p > 0.05, false)), false) FROM {"a_p" if large else "n_p"})"""
    kruskal = f"""{with_(*ctes)}, d AS (SELECT server_id, v FROM {source} WHERE server_id IS NOT NULL AND v IS NOT NULL),
rk AS (SELECT server_id, v, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rnk FROM d),
g AS (SELECT server_id, sum(rnk) AS R, count(*) AS n FROM rk GROUP BY 1),
ties AS (SELECT sum(pow(c, 3) - c) AS tt FROM (SELECT count(*) AS c FROM d GROUP BY v)),
tot AS (SELECT CAST(count(*) AS DOUBLE) AS N FROM d),
h AS (SELECT (12.0 / (N * (N + 1)) * (SELECT sum(R * R / n) FROM g) - 3 * (N + 1)) / (1 - (SELECT tt FROM ties) / (N * N * N - N)) AS h FROM tot)
SELECT {r('h', 4)} AS h_statistic, {r(h_tail, 4)} AS p_value, {h_tail} > 0.05 AS homogeneous FROM h"""
    return "\nUNION ALL\n".join([
        long_sql(base + _NORMALITY, "normality_test", "server_id", ["statistic", "p_value", "is_normal"]),
        *([long_sql(base + _ANDERSON, "normality_large", "server_id", ["statistic", "p_value", "is_normal"])] if large else []),
        long_sql(anova, "anova", None, ["f_statistic", "p_value", "homogeneous"]),
        long_sql(kruskal, "kruskal_wallis", None, ["h_statistic", "p_value", "homogeneous"])])


@oracle("homogeneity")
def _():
    return _homogeneity([METRICS_EV, _EV_VALUES], "ev_v", 5)


@oracle("homogeneity_daily")
def _():
    monthly = ("monthly AS (SELECT 'group_' || CAST(l_suppkey % 3 AS VARCHAR) AS server_id, avg(l_quantity) AS v "
               "FROM lineitem GROUP BY 1, date_trunc('month', l_shipdate))")
    return _homogeneity([monthly], "monthly", 3)


@oracle("anderson_darling")
def _():
    return with_(METRICS_EV, _EV_VALUES, anderson_sql("ev_v")) + _ANDERSON


_NODES = """nodes AS (SELECT 'node_' || CAST(vec_id % 3 AS VARCHAR) AS server_id, 50 + 100 * CAST(x AS DOUBLE) AS v
  FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings))"""


@oracle("homogeneity_large")
def _():
    return _homogeneity([_NODES], "nodes", 3, large=True)


# ---------------------------------------------------------------- checked CSV
@oracle("csv_logs")
def _():
    return with_(LOGS_K) + 'SELECT * EXCLUDE (k) FROM logs_k WHERE k IS NULL OR k NOT IN (0, 1, 2, 3, 4)'


@oracle("csv_errors")
def _():
    return with_(LOGS_K) + """SELECT CASE k WHEN 0 THEN 'bad response_code' WHEN 1 THEN 'bad timestamp' WHEN 2 THEN 'bad response_size'
  WHEN 3 THEN 'no timestamp' ELSE 'bad response_code, bad response_time_ms' END AS reason, count(*) AS records, count(*) AS with_file
FROM logs_k WHERE k IN (0, 1, 2, 3, 4) GROUP BY 1"""


# ---------------------------------------------------------------- rollups
_WINDOW = f"""count(*) AS total_requests, {r('avg(response_time_ms)', 2)} AS avg_response_time,
  count(CASE WHEN response_code >= 400 THEN 1 END) AS error_count,
  CASE WHEN count(*) > 0 THEN {r('count(CASE WHEN response_code >= 400 THEN 1 END) / count(*) * 100', 2)} ELSE 0.0 END AS error_rate"""


@oracle("rollup_log_stats")
def _():
    return with_(LOGS) + f"""SELECT {_WINDOW}, true AS ips_near, true AS endpoints_near FROM logs
WHERE "timestamp" >= TIMESTAMP '2024-01-24' AND "timestamp" < TIMESTAMP '2024-01-31'"""


@oracle("trailing_log_stats")
def _():
    return with_(LOGS) + f""", hours AS (SELECT DISTINCT date_trunc('hour', "timestamp") AS h FROM logs)
SELECT h AS "hour", {_WINDOW.replace(r('avg(response_time_ms)', 2) + " AS avg_response_time,", "")} FROM hours JOIN logs ON "timestamp" < h + INTERVAL 1 HOUR AND "timestamp" >= h - INTERVAL 23 HOUR GROUP BY 1"""


# ---------------------------------------------------------------- k-means
_FEATURES = ["cpu_usage_mean", "cpu_usage_std", "cpu_usage_max", "memory_usage_mean", "memory_usage_std", "response_time_ms_mean", "response_time_ms_max", "error_rate_mean"]
_ROUNDS = 25            # more than the test tables need to settle; a settled round repeats itself


def cluster_sql(features: str, k: int = 3) -> str:
    """Farthest-first start and Lloyd steps over ``features(server_id, ...)``, with
    one chain of tables for each step; integer points as lists."""
    z = ", ".join(f"coalesce(CAST(floor(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0) * 10000 + 0.5) AS BIGINT), 0)" for c in _FEATURES)
    dist = lambda a, b: f"list_sum(list_transform(list_zip({a}, {b}), lambda q: (q[1] - q[2]) * (q[1] - q[2])))"
    out = [f"""f AS MATERIALIZED (SELECT server_id, {", ".join(f"coalesce({c}, 0) AS {c}" for c in _FEATURES)} FROM ({features})),
pt AS MATERIALIZED (SELECT server_id, [{z}] AS x FROM f),
s1 AS MATERIALIZED (SELECT 0 AS c, x AS m FROM pt ORDER BY {dist("x", "[0, 0, 0, 0, 0, 0, 0, 0]")} DESC, server_id LIMIT 1)"""]
    for i in range(2, k + 1):
        out.append(f"""s{i} AS MATERIALIZED (SELECT c, m FROM s{i - 1} UNION ALL (SELECT {i - 1}, x FROM
  (SELECT server_id, x, min({dist("x", "m")}) AS d FROM pt, s{i - 1} GROUP BY 1, 2) WHERE d > 0 ORDER BY d DESC, server_id LIMIT 1))""")
    last = f"s{k}"
    near = lambda centres: f"SELECT server_id, x, arg_min(c, ({dist('x', 'm')}, c)) AS c FROM pt, {centres} GROUP BY 1, 2"
    for i in range(_ROUNDS):
        out.append(f"""a{i} AS MATERIALIZED ({near(last)}),
m{i} AS MATERIALIZED (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM
  (SELECT c, i, sum(x[i]) AS s, count(*) AS n FROM a{i}, range(1, 9) r(i) GROUP BY c, i) GROUP BY c),
c{i} AS MATERIALIZED (SELECT c, coalesce(m{i}.m, o.m) AS m FROM {last} o LEFT JOIN m{i} USING (c))""")
        last = f"c{i}"
    out.append(f"""fin AS MATERIALIZED ({near(last)}),
num AS (SELECT c, CAST(row_number() OVER (ORDER BY avg(cpu_usage_mean), min(server_id)) - 1 AS INTEGER) AS cluster FROM fin JOIN f USING (server_id) GROUP BY c)""")
    return "WITH " + ",\n".join(out) + "\nSELECT f.*, cluster FROM f JOIN fin USING (server_id) JOIN num USING (c)"


@oracle("cluster_servers")
def _():
    return cluster_sql(ORACLE["server_features"])


@oracle("advanced_report")
def _():
    features = ORACLE["server_features"].replace(METRICS, METRICS_EV).replace("FROM metrics WHERE", "FROM metrics_ev WHERE")
    return ORACLE["advanced_report_sections"] + "\nUNION ALL\n" + long_sql(cluster_sql(features), "clusters", "server_id", ["cluster"])


# ---------------------------------------------------------------- host files
_HOST_COLUMNS = ["timestamp", "server_id", "cpu_usage", "cpu_user", "cpu_system", "memory_usage", "memory_used_gb", "memory_available_gb", "swap_usage",
                 "disk_usage", "disk_read_mb", "disk_write_mb", "network_sent_mb", "network_recv_mb", "load_average"]


@oracle("host_files")
def _():
    own = {"timestamp": "ts", "server_id": "event_type", "cpu_usage": "value", "cpu_user": "value * 0.75", "cpu_system": "value * 0.25",
           "memory_usage": "CAST(user_id % 100 AS DOUBLE)", "swap_usage": "CASE WHEN event_type IN ('click', 'view') THEN CAST(user_id % 3 AS DOUBLE) END",
           "load_average": "value / 8"}
    cols = ", ".join(f'{own.get(c, "CAST(user_id % 11 AS DOUBLE)")} AS "{c}"' for c in _HOST_COLUMNS)
    return f"SELECT {cols}, CASE WHEN event_type IN ('click', 'view') THEN 'a' ELSE 'b' END AS layout, true AS dated FROM events"


@oracle("host_layouts")
def _():
    other = ["agent", *[c for c in reversed(_HOST_COLUMNS) if c != "swap_usage"]]
    return (f"SELECT '{','.join(_HOST_COLUMNS)}' AS columns, '' AS missing, '' AS unknown UNION ALL "
            f"SELECT '{','.join(other)}', 'swap_usage', 'agent'")


@oracle("hybrid_files")
def _():
    return """SELECT 'host' AS source, count(*) AS "rows", count(event_type) AS servers, 0 AS endpoints, count(*) AS with_file FROM events
UNION ALL SELECT 'access_logs', count(*), 0, count(*), count(*) FROM events"""


# ---------------------------------------------------------------- formats and layouts
@oracle("parse_common")
def _():
    return with_(LOGS_K) + """SELECT date_trunc('second', "timestamp") AS "timestamp", client_ip, request_method, endpoint, response_code,
  CASE WHEN k = 2 THEN 0 ELSE response_size END AS response_size, CAST(NULL AS DOUBLE) AS response_time_ms, CAST(NULL AS VARCHAR) AS referer,
  CAST(NULL AS VARCHAR) AS user_agent, CASE WHEN k = 0 THEN 'alice' END AS remote_user FROM logs_k WHERE k IS NULL OR k NOT IN (1, 5)"""


@oracle("parse_common_errors")
def _():
    return with_(LOGS_K) + "SELECT 'bad_timestamp' AS reason, count(*) AS lines FROM logs_k WHERE k = 1 HAVING count(*) > 0"


@oracle("load_formats")
def _():
    cols = '"timestamp", server_id, cpu_usage, request_count'
    return with_(METRICS) + f"SELECT 'parquet' AS source, {cols} FROM metrics UNION ALL SELECT 'csv', {cols} FROM metrics"


@oracle("report_sink")
def _():
    return ORACLE["basic_report"]
