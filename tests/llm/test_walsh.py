"""Progressive search against all distances, rounds against plain Python, edges and the SQL twin."""

import hashlib
import math

import __spark_entry__ as entry
import numpy as np
import pytest
from conftest import SF01
from pyspark.sql import functions as F

from loadlens.llm.walsh import SAFE, ProgressiveSearch, cluster_vectors, fit, transform, walsh_order
from oracle_compare import compare, duck

SCHEMA = "vec_id bigint, embedding array<float>, cluster string, id string, vector string, distance string"


def plain_clusters(rows, k=16, rounds=3):
    kept = [(i, tuple(math.floor(64 * x) for x in map(float, v))) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    cents = [v for _, v in sorted((name(i), v) for i, v in kept)[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((dist(v, c), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        cents = [tuple(sum(x) // len(groups[j]) for x in zip(*groups[j])) if j in groups else c for j, c in enumerate(cents)]
    found = [(i, *reversed(near(v))) for i, v in kept]
    per = {}
    for _, j, d in found:
        per[j] = per.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, j, d, per[j], sum(per.values()), sha[j]) for i, j, d in found), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_transform_keeps_distances_and_orders_coarse_to_fine():
    x = np.random.default_rng(3).integers(-99, 99, (20, 64))
    h = transform(x)
    assert ((h[0] - h[1]) ** 2).sum() == 64 * ((x[0] - x[1]) ** 2).sum()
    rows = transform(np.eye(64, dtype=np.int64))[walsh_order()]
    assert [(np.diff(r) != 0).sum() for r in rows] == list(range(64))


@pytest.mark.parametrize("spread, size", [(2, 400), (30, 400), (1 << 26, 40)])
def test_search_equals_all_distances(spread, size):
    rng = np.random.default_rng(spread)
    x, c = rng.integers(-spread, spread, (size, 64)), rng.integers(-spread, spread, (16, 64))
    c[7], x[:20] = c[3], c[3]                      # equal centroids, vectors on them
    x[20:40] = (c[1] + c[2]) // 2
    search = ProgressiveSearch(c)
    cluster, distance = search.nearest(x)
    for v, j, d in zip(x.tolist(), cluster, distance):
        all_d = [sum((a - b) ** 2 for a, b in zip(v, o)) for o in c.tolist()]
        assert (d, j) == (min(all_d), all_d.index(min(all_d)))
    assert search.wide == (spread > SAFE)


def test_worse_centroids_are_not_finished():
    rng = np.random.default_rng(5)
    c = rng.integers(-40, 40, (16, 64))
    search = ProgressiveSearch(c)
    search.nearest(c[rng.integers(0, 16, 500)] + rng.integers(-4, 5, (500, 64)))
    assert search.finished_pairs < 0.1 * search.pairs


def test_clusters_against_plain(spark):
    rng = np.random.default_rng(11)
    v = (rng.standard_normal((300, 64)) * 0.3).astype(np.float32).tolist()
    rows = [(i, x) for i, x in enumerate(v)] + [(7, v[7]), (None, v[9]), (400, v[0])]
    rows += [(500 + i, [0.25] * 64) for i in range(150)]         # a third of all rows alike
    rows += [(800, None), (801, []), (802, v[0][:63]), (803, v[0] + [0.0]), (804, [None] + v[0][1:]), (805, [math.nan] + v[0][1:]), (806, [math.inf] + v[0][1:])]
    df = spark.createDataFrame([(i, x, "c", "i", "v", "d") for i, x in rows], SCHEMA)
    want = plain_clusters([(r["vec_id"], r["embedding"]) for r in df.collect()])
    assert got(cluster_vectors(df.repartition(5))) == want == got(cluster_vectors(df.coalesce(1)))
    assert len(want) == 453


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(i, [float(i)] * 64, "c", "i", "v", "d") for i in (1, 2, 2)], SCHEMA)
    assert got(cluster_vectors(df)) == plain_clusters([(i, [float(i)] * 64) for i in (1, 2, 2)])
    none = cluster_vectors(df.limit(0))
    assert none.collect() == [] and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert len(fit(df.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")), k=2)) == 2


def test_large_components(spark):
    far = [(1, [16000.0] * 64), (2, [-16000.0] * 64), (3, [300000.0] * 64), (4, [0.5] * 64)]
    df = spark.createDataFrame([(i, v, "c", "i", "v", "d") for i, v in far], SCHEMA)
    assert got(cluster_vectors(df)) == plain_clusters(far)
    with pytest.raises(Exception, match="limit"):
        cluster_vectors(spark.createDataFrame([(1, [1e30] * 64, "c", "i", "v", "d")], SCHEMA)).collect()


def test_query_matches_sql(spark):
    ok, msg, _ = compare(spark, duck(SF01), "op11_centroids", entry.queries()["op11_centroids"], entry.oracle_sql()["op11_centroids"], SF01)
    assert ok, msg
