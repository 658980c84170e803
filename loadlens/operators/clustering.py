"""Server clustering: per-server load features -> standardisation -> k-means.

The clustering is reproducible: standardised features are kept as integers, starts
are chosen farthest first, and means are exact, so the labels depend neither on
partitioning nor on the order of sums.  Each step is one aggregation over the
feature table (a row per server); only k centroids come back to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.operators.aggregations import server_features
from loadlens.session import materialize

FEATURES = ["cpu_usage_mean", "cpu_usage_std", "cpu_usage_max", "memory_usage_mean",
            "memory_usage_std", "response_time_ms_mean", "response_time_ms_max", "error_rate_mean"]
SCALE = 10_000          # units of a standard deviation
MAX_ROUNDS = 100        # integer means could take turns; real inputs settle long before
_POINT = [f"_x{i}" for i in range(len(FEATURES))]


def standardised(feats: DataFrame) -> DataFrame:
    """``server_id`` and each feature in units of ``1 / SCALE`` sample standard
    deviations from its mean, rounded; 0 for a constant feature."""
    stats = feats.agg(*[F.avg(c).alias(f"_m{i}") for i, c in enumerate(FEATURES)], *[F.stddev_samp(c).alias(f"_s{i}") for i, c in enumerate(FEATURES)])
    z = lambda i: F.try_divide(F.col(FEATURES[i]) - F.col(f"_m{i}"), F.col(f"_s{i}"))
    points = [F.coalesce(F.floor(z(i) * SCALE + 0.5), F.lit(0)).cast("bigint").alias(x) for i, x in enumerate(_POINT)]
    return feats.crossJoin(F.broadcast(stats)).select("server_id", *points)         # one row of statistics


def _distance(centre: list[int]) -> Column:
    return F.expr(" + ".join(f"({x} - {v}L) * ({x} - {v}L)" for x, v in zip(_POINT, centre)))


def _farthest_first(points: DataFrame, k: int) -> list[list[int]]:
    """The server farthest from the mean, then each time the one farthest from all
    chosen (ties: the smallest id); fewer than ``k`` if no other point is left."""
    chosen: list[list[int]] = []
    while len(chosen) < k:
        away = F.least(*map(_distance, chosen)) if len(chosen) > 1 else _distance(chosen[0] if chosen else [0] * len(_POINT))
        far = points.withColumn("_d", away).groupBy("_d").agg(F.min_by(F.struct(*_POINT), "server_id").alias("p")).orderBy(F.desc("_d")).limit(1).first()
        if far is None or (chosen and far["_d"] == 0):
            break
        chosen.append(list(far["p"]))
    return chosen


def _nearest(centres: list[list[int]]) -> Column:
    """Number of the nearest centre (ties: the smaller)."""
    all_d = F.array(*map(_distance, centres))
    return (F.array_position(all_d, F.array_min(all_d)) - 1).cast("int")


def k_means(points: DataFrame, k: int) -> list[list[int]]:
    """Centres after Lloyd steps from a farthest-first start until no centre moves:
    the floor of each mean; an empty cluster keeps its centre."""
    centres = _farthest_first(points, k)
    for _ in range(MAX_ROUNDS if centres else 0):
        rows = points.groupBy(_nearest(centres).alias("c")).agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(x) for x in _POINT]).collect()     # k rows
        moved = list(centres)
        for r in rows:
            moved[r["c"]] = [r[x] // r["n"] for x in _POINT]
        if moved == centres:
            break
        centres = moved
    return centres


def cluster_servers(df: DataFrame, k: int = 3) -> DataFrame:
    """The 8 features per server plus ``cluster``, 0 to at most ``k`` - 1.

    A one-row server has NULL std -> 0; servers of equal features share a cluster.
    Clusters are numbered by ascending mean cpu (ties by the smallest server id)."""
    feats = materialize(server_features(df).na.fill(0.0, subset=FEATURES))   # one row per server, read by every step
    points = materialize(standardised(feats))
    centres = k_means(points, k)
    if not centres:
        return feats.withColumn("cluster", F.lit(None).cast("int"))
    pred = feats.join(points.select("server_id", _nearest(centres).alias("_c")), "server_id")
    # renumber clusters by (mean cpu, smallest member): a table of <= k rows
    order = pred.groupBy("_c").agg(F.avg("cpu_usage_mean").alias("_m"), F.min("server_id").alias("_s"))
    order = order.withColumn("cluster", (F.row_number().over(Window.orderBy("_m", "_s")) - 1).cast("int"))
    return pred.join(F.broadcast(order.select("_c", "cluster")), "_c").drop("_c")
