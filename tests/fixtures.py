"""Hand fixtures (fixed values taken from the reference's sample data and
committed reports)."""

import datetime as dt

# The ten sample access-log lines and their parsed form.
SAMPLE_LOG = [
    '192.168.1.1 - - [09/Oct/2024:10:30:00 +0300] "GET /api/users HTTP/1.1" 200 1543 "https://example.com" "Mozilla/5.0" 0.045',
    '192.168.1.2 - - [09/Oct/2024:10:30:01 +0300] "POST /api/login HTTP/1.1" 201 234 "https://example.com" "Mozilla/5.0" 0.123',
    '192.168.1.3 - - [09/Oct/2024:10:30:02 +0300] "GET /static/css/style.css HTTP/1.1" 200 5432 "https://example.com" "Mozilla/5.0" 0.012',
    '192.168.1.1 - - [09/Oct/2024:10:30:03 +0300] "GET /api/products HTTP/1.1" 200 8765 "https://example.com" "Mozilla/5.0" 0.067',
    '192.168.1.4 - - [09/Oct/2024:10:30:04 +0300] "GET /admin HTTP/1.1" 403 123 "https://example.com" "Mozilla/5.0" 0.034',
    '192.168.1.2 - - [09/Oct/2024:10:30:05 +0300] "POST /api/orders HTTP/1.1" 500 0 "https://example.com" "Mozilla/5.0" 1.234',
    '192.168.1.5 - - [09/Oct/2024:10:30:06 +0300] "GET /api/health HTTP/1.1" 200 89 "https://example.com" "Mozilla/5.0" 0.008',
    '192.168.1.1 - - [09/Oct/2024:10:30:07 +0300] "GET /images/logo.png HTTP/1.1" 200 15432 "https://example.com" "Mozilla/5.0" 0.023',
    '192.168.1.3 - - [09/Oct/2024:10:30:08 +0300] "PUT /api/users/123 HTTP/1.1" 404 267 "https://example.com" "Mozilla/5.0" 0.089',
    '192.168.1.6 - - [09/Oct/2024:10:30:09 +0300] "GET /api/metrics HTTP/1.1" 200 3456 "https://example.com" "Mozilla/5.0" 0.156',
]

SAMPLE_PARSED = [  # (second, ip, method, endpoint, code, size, ms)
    (0, "192.168.1.1", "GET", "/api/users", 200, 1543, 45.0),
    (1, "192.168.1.2", "POST", "/api/login", 201, 234, 123.0),
    (2, "192.168.1.3", "GET", "/static/css/style.css", 200, 5432, 12.0),
    (3, "192.168.1.1", "GET", "/api/products", 200, 8765, 67.0),
    (4, "192.168.1.4", "GET", "/admin", 403, 123, 34.0),
    (5, "192.168.1.2", "POST", "/api/orders", 500, 0, 1234.0),
    (6, "192.168.1.5", "GET", "/api/health", 200, 89, 8.0),
    (7, "192.168.1.1", "GET", "/images/logo.png", 200, 15432, 23.0),
    (8, "192.168.1.3", "PUT", "/api/users/123", 404, 267, 89.0),
    (9, "192.168.1.6", "GET", "/api/metrics", 200, 3456, 156.0),
]

MALFORMED = [
    '10.0.0.1 - bob [09/Oct/2024:10:30:00 +0300] "GET /a HTTP/1.1" 200 1 "r" "a" 0.1',      # named user
    '10.0.0.1 - - [31/Feb/2024:10:30:00 +0300] "GET /a HTTP/1.1" 200 1 "r" "a" 0.1',        # impossible date
    '10.0.0.1 - - [09/Oct/2024:10:30:00 +0300] "GET /a HTTP/1.1" 200 - "r" "a" 0.1',        # size '-'
    '10.0.0.1 - - [09/Oct/2024:10:30:00 +0300] "GET /a HTTP/1.1" 200 1 "r" "a" 1',          # no decimal point
    '10.0.0.1 - - [09/Oct/2024:10:30:00 +0300] "GET /a HTTP/1.1" 200 1 "r" "a" "-" rt=0.1',  # web-server layout
]


def stat_golden_rows():
    """The seed-42 statistical fixture: hourly rows for three servers over
    2024-01-01 .. 2024-01-10, about 5 % dropped."""
    import numpy as np
    rng = np.random  # legacy global generator, as in the recipe
    rng.seed(42)
    rows = []
    start = dt.datetime(2024, 1, 1)
    for h in range(9 * 24 + 1):
        ts = start + dt.timedelta(hours=h)
        for server in ("web01", "api01", "db01"):
            if rng.random() > 0.05:
                rows.append((ts, server, float(rng.normal(50, 15)), float(rng.normal(60, 10)),
                             float(rng.normal(100, 30)), float(rng.exponential(1))))
    return rows


STAT_SCHEMA = ("timestamp timestamp_ntz, server_id string, cpu_usage double, memory_usage double, "
               "response_time_ms double, error_rate double")
