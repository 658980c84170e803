"""Access-log line parsing with native regex expressions (no Python UDF).

A line is matched once per pattern group with ``regexp_extract`` (anchored
at the start, trailing text allowed), converted with ``try_*`` functions, and
split into parsed rows and quarantined rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Line patterns that must match the reference parser exactly.
# "main": the parser's access-log layout (10 groups):
#   ip, time, method, path, protocol, status, size, referer, agent, seconds
MAIN_PATTERN = r'(\S+) - - \[(.*?)\] "(\S+) (\S+) (\S+)" (\d+) (\d+) "([^"]*)" "([^"]*)" (\d+\.\d+)'
# "nginx_rt": the nginx ``log_format main`` of the bundled web-server config:
#   $remote_addr - $remote_user [$time_local] "$request" $status
#   $body_bytes_sent "$http_referer" "$http_user_agent" "$http_x_forwarded_for" rt=$request_time
NGINX_RT_PATTERN = (r'(\S+) - (\S+) \[(.*?)\] "(\S+) (\S+) (\S+)" (\d+) (\d+|-) '
                    r'"([^"]*)" "([^"]*)" "([^"]*)" rt=(\d+(?:\.\d+)?|-)')
# "common": Common Log Format, no referer/agent/time
COMMON_PATTERN = r'(\S+) (\S+) (\S+) \[(.*?)\] "(\S+) (\S+)(?: (\S+))?" (\d{3}) (\d+|-)'
TIME_FORMAT = "d/MMM/yyyy:H:m:s"   # strptime('%d/%b/%Y:%H:%M:%S'), zone dropped

# group index per field, per format
_FIELDS = {
    "main": dict(client_ip=1, time=2, request_method=3, endpoint=4, protocol=5, response_code=6,
                 response_size=7, referer=8, user_agent=9, seconds=10),
    "nginx_rt": dict(client_ip=1, remote_user=2, time=3, request_method=4, endpoint=5, protocol=6,
                     response_code=7, response_size=8, referer=9, user_agent=10,
                     x_forwarded_for=11, seconds=12),
    "common": dict(client_ip=1, remote_user=3, time=4, request_method=5, endpoint=6, protocol=7,
                   response_code=8, response_size=9),
}
PATTERNS = {"main": MAIN_PATTERN, "nginx_rt": NGINX_RT_PATTERN, "common": COMMON_PATTERN}


# The characters Python's ``str.strip()`` removes (Unicode
# whitespace), as a Java regex class.
_PY_SPACE = r"[\t\n\x0B\f\r\x1C-\x1F \x85\xA0  -     　]"
_SEP, _MARK = "\u0001", "\u0002"


def _ngroups(pattern: str) -> int:
    import re
    return re.compile(pattern).groups


def _dash_to_null(c: Column) -> Column:
    return F.when(c != F.lit("-"), c)


def _evaluate_once(df: DataFrame, keep: list[str], **cols: Column) -> DataFrame:
    """Compute ``cols`` in a Generate step.  Catalyst collapses consecutive
    projections and would then re-evaluate an expensive expression (the line
    regex) once per field that reads it; a Generate is never collapsed."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(k) for k, c in cols.items()]))))


def parse_lines(lines: DataFrame, fmt: str = "main", value_col: str = "value",
                keep_cols: tuple[str, ...] = ()) -> DataFrame:
    """Add ``_status`` ('ok', 'blank', 'no_match', 'bad_timestamp') and the
    typed access-log columns to a frame of raw lines.

    One regex pass per line: the anchored pattern (after the leading
    whitespace that ``strip()`` would remove; trailing text allowed) is
    replaced by a marker plus all groups joined by a separator, which is then
    split into an array.  A line that holds one of these two control characters
    itself is matched and read group by group instead."""
    pat, g = PATTERNS[fmt], _FIELDS[fmt]
    n = _ngroups(pat)
    repl = _MARK + _SEP.join(f"${i}" for i in range(1, n + 1))
    raw = F.col(value_col)
    keep = list(keep_cols) + [value_col]
    whole = "^" + _PY_SPACE + "*" + pat + "(?s:.*)$"
    p = _evaluate_once(lines, keep, _blank=raw.rlike("^" + _PY_SPACE + "*$"), _odd=raw.rlike(f"[{_SEP}{_MARK}]"),
                       _packed=F.regexp_replace(raw, whole, repl))
    packed = F.col("_packed")
    each = F.when(raw.rlike(whole), F.array(*[F.regexp_extract(raw, whole, i) for i in range(1, n + 1)]))
    p = _evaluate_once(p, keep + ["_blank"], _g=F.when(F.col("_odd"), each).when(
        F.startswith(packed, F.lit(_MARK)), F.split(F.substring(packed, 2, 1 << 30), _SEP, -1)))
    grp = lambda name: F.get("_g", F.lit(g[name] - 1))
    # first whitespace-separated token of the bracketed time (zone dropped)
    ts_text = F.regexp_extract(grp("time"), r"^\s*(\S+)", 1)
    ts = F.try_to_timestamp(ts_text, F.lit(TIME_FORMAT)).cast("timestamp_ntz")
    cols = {
        "timestamp": ts,
        "client_ip": grp("client_ip"),
        "request_method": grp("request_method"),
        "endpoint": grp("endpoint"),
        "response_code": grp("response_code").try_cast("int"),
        "response_size": F.coalesce(_dash_to_null(grp("response_size")).try_cast("bigint"), F.lit(0).cast("bigint")),
    }
    if "seconds" in g:
        secs = F.coalesce(_dash_to_null(grp("seconds")).try_cast("double"), F.lit(0.0))
        cols["response_time_ms"] = F.round(secs * 1000, 2)
    else:
        cols["response_time_ms"] = F.lit(None).cast("double")
    cols["referer"] = grp("referer") if "referer" in g else F.lit(None).cast("string")
    cols["user_agent"] = grp("user_agent") if "user_agent" in g else F.lit(None).cast("string")
    if fmt != "main":
        cols["remote_user"] = _dash_to_null(grp("remote_user"))
    if "x_forwarded_for" in g:
        cols["x_forwarded_for"] = _dash_to_null(grp("x_forwarded_for"))
    typed = _evaluate_once(p, keep + ["_blank", "_g"], **cols)
    status = (F.when(F.col("_blank"), F.lit("blank"))
               .when(F.col("_g").isNull(), F.lit("no_match"))
               .when(F.col("timestamp").isNull(), F.lit("bad_timestamp"))
               .otherwise(F.lit("ok")))
    return typed.withColumn("_status", status).drop("_blank", "_g")


ACCESS_LOG_COLUMNS = ["timestamp", "client_ip", "request_method", "endpoint", "response_code",
                      "response_size", "response_time_ms", "referer", "user_agent"]


def parse_access_log(lines: DataFrame, fmt: str = "main", value_col: str = "value") -> DataFrame:
    """Parsed ``access_logs`` rows (column order of the reference output);
    blank and malformed lines are dropped — see :func:`parse_errors`."""
    extra = [] if fmt == "main" else ["remote_user"] + (["x_forwarded_for"] if fmt == "nginx_rt" else [])
    p = parse_lines(lines, fmt, value_col)
    return p.where(F.col("_status") == "ok").select(*ACCESS_LOG_COLUMNS, *extra)


def parse_errors(lines: DataFrame, fmt: str = "main", value_col: str = "value",
                 keep_cols: tuple[str, ...] = ()) -> DataFrame:
    """Quarantine: non-blank lines that do not match or carry an impossible
    date, as ``(*keep_cols, reason, line)``."""
    p = parse_lines(lines, fmt, value_col, keep_cols)
    return (p.where(F.col("_status").isin("no_match", "bad_timestamp"))
             .select(*keep_cols, F.col("_status").alias("reason"), F.col(value_col).alias("line")))
