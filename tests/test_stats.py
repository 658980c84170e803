"""Distribution functions, Shapiro-Wilk, ANOVA, clustering invariants."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlens.functions import distributions as D
from loadlens.operators import clustering as K
from loadlens.operators import inference as I
from shapiro_plain import shapiro_wilk
from loadlens.sources.views import metrics_ev_view, metrics_view

SF = "/root/testdata/sf0.01"


def test_distribution_values():
    assert abs(D.t_ppf(0.975, 612) - 1.9638) < 5e-5
    assert abs(D.t_ppf(0.975, 1) - 12.706204736) < 1e-6
    assert abs(D.chi2_sf(1.1626, 2) - math.exp(-0.5813)) < 1e-12
    h = 7.3
    assert abs(D.chi2_sf(h, 4) - math.exp(-h / 2) * (1 + h / 2)) < 1e-12
    f, d2 = 2.2, 300.0
    x, a = d2 / (d2 + 4 * f), d2 / 2
    assert abs(D.f_sf(f, 4, d2) - x ** a * (1 + a * (1 - x))) < 1e-12


def test_distributions_at_large_parameters():
    assert abs(D.chi2_sf(1e8, 1e8) - 0.49998) < 1e-5
    assert abs(D.chi2_sf(1.0003e8, 1e8) - 0.0169) < 1e-3
    assert abs(D.t_ppf(0.975, 1e12) - 1.959963985) < 1e-8
    assert abs(D.t_ppf(0.975, 10_001) - D.t_ppf(0.975, 9_999)) < 1e-6
    for k in (9e4, 1.1e5):    # the two forms agree where they meet
        z = 1.5
        x = k * (1 - 2 / (9 * k) + z * math.sqrt(2 / (9 * k))) ** 3
        assert abs(D.chi2_sf(2 * x, 2 * k) - D.norm_sf(z * math.sqrt(2))) < 2e-3
    assert abs(D.f_sf(1.3, 4, 9_999_999) - D.f_sf(1.3, 4, 10_000_001)) < 1e-7
    assert abs(D.f_sf(1.01, 11_000, 9_999_999) - D.f_sf(1.01, 11_000, 10_000_001)) < 1e-4
    assert abs(D.f_sf(2.0, 3, 1e12) - D.chi2_sf(6.0, 3)) < 1e-9


def test_normal_quantile_column(spark):
    from statistics import NormalDist
    from loadlens.functions.numeric import norm_ppf_col
    ps = [1e-12, 1e-6, 0.001, 0.02, 0.075, 0.3, 0.5, 0.77, 0.93, 0.999, 1 - 1e-9]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select("p", norm_ppf_col(F.col("p")).alias("z")).collect()
    assert all(abs(r.z - NormalDist().inv_cdf(r.p)) < 1e-9 for r in got)


SAMPLES = {"normal": lambda r: r.normal(0, 1, 500), "exponential": lambda r: r.exponential(1, 300), "three": lambda r: [1.0, 2.0, 4.0],
           "four": lambda r: r.normal(5, 2, 4), "five": lambda r: r.gamma(1, 2, 5), "eleven": lambda r: r.normal(1e6, 2, 11),
           "tied": lambda r: r.integers(0, 5, 400).astype(float), "shifted": lambda r: r.normal(1e8, 1e-2, 60)}


def test_normality_against_plain(spark):
    rows = [(k, float(v)) for k, make in SAMPLES.items() for v in make(np.random.default_rng(3))]
    rows += [("constant", 2.0)] * 9 + [("two", 1.0), ("two", 2.0), ("two", float("nan")), (None, 1.0)]
    got = {r.server_id: r for r in I.normality_test(spark.createDataFrame(rows, "server_id string, cpu_usage double").repartition(5)).collect()}
    assert set(got) == {*SAMPLES, "constant", "two"}
    for k in SAMPLES:
        w, p = shapiro_wilk(np.array([v for g, v in rows if g == k]))
        assert abs(got[k].statistic - w) < 2e-4 and abs(got[k].p_value - p) < 2e-3, k
    assert got["constant"].reason == "constant" and got["constant"].statistic is None
    assert got["two"].reason == "n < 3" and got["two"].n == 2


def test_normality_of_large_groups(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("server_id"), F.rand(1).alias("cpu_usage"))
    for r in I.normality_test(df).collect():
        x = np.arange(1, r.n + 1) / (r.n + 1)
        assert r.reason == "n > 5000" and r.p_value is None and abs(r.kurtosis + 1.2) < 0.05 and r.jb_p_value == 0.0
        assert abs(r.statistic - shapiro_wilk(x)[0]) < 2e-3


def test_normality_spreads_ties(spark):
    df = spark.createDataFrame([("s", 1.0)] * 700 + [("s", 2.0)] * 300, "server_id string, cpu_usage double")
    want = I.normality_test(df).first()
    step, I.TIE_STEP = I.TIE_STEP, 64
    try:
        assert I.normality_test(df).first() == want
    finally:
        I.TIE_STEP = step


def test_anova_far_from_zero_and_one_row_groups(spark):
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 12, 50) * 1e-3, rng.integers(4, 16, 50) * 1e-3
    for base in (0.0, 1e8):
        df = spark.createDataFrame([("a", base + float(x)) for x in a] + [("b", base + float(x)) for x in b], "server_id string, cpu_usage double")
        x, y = base + a, base + b
        grand = np.concatenate([x, y]).mean()
        f = (50 * ((x.mean() - grand) ** 2 + (y.mean() - grand) ** 2)) / ((((x - x.mean()) ** 2).sum() + ((y - y.mean()) ** 2).sum()) / 98)
        assert I.anova(df).first().f_statistic == pytest.approx(f, rel=1e-3)
    one = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 4.0)], "server_id string, cpu_usage double")
    r = I.anova(one).first()
    assert r.f_statistic is None and r.p_value is None and (r.df_between, r.df_within) == (2, 0)


def test_anova_against_numpy(spark):
    ev = metrics_ev_view(spark, SF)
    pdf = ev.select("server_id", "cpu_usage").toPandas()
    groups = [g.to_numpy() for _, g in pdf.groupby("server_id")["cpu_usage"]]
    n, k = sum(map(len, groups)), len(groups)
    gm = np.concatenate(groups).mean()
    ssb = sum(len(g) * (g.mean() - gm) ** 2 for g in groups)
    ssw = sum(((g - g.mean()) ** 2).sum() for g in groups)
    f = (ssb / (k - 1)) / (ssw / (n - k))
    r = I.anova(ev).first()
    assert abs(r.f_statistic - round(f, 4)) < 1e-4


def test_cluster_invariants(spark):
    out = K.cluster_servers(metrics_view(spark, "/root/testdata/sf0.001")).toPandas()
    assert out["server_id"].is_unique and out["cluster"].between(0, 2).all()
    means = out.groupby("cluster")["cpu_usage_mean"].mean()
    assert list(means.index) == sorted(means.index)


def plain_k_means(points, k):
    """points: id -> integer tuple; farthest-first start, Lloyd steps, floor means."""
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    centres, zero = [], tuple([0] * len(next(iter(points.values()))))
    while len(centres) < k:
        d, s = min((-min(dist(p, c) for c in centres or [zero]), s) for s, p in points.items())
        if centres and d == 0:
            break
        centres.append(points[s])
    while True:
        label = {s: min((dist(p, c), i) for i, c in enumerate(centres))[1] for s, p in points.items()}
        groups = [[points[s] for s in label if label[s] == i] for i in range(len(centres))]
        moved = [tuple(sum(x) // len(g) for x in zip(*g)) if g else c for g, c in zip(groups, centres)]
        if moved == centres:
            return label
        centres = moved


def test_clusters_are_reproducible(spark):
    df = metrics_view(spark, "/root/testdata/sf0.01")
    runs = [{r.server_id: r.cluster for r in K.cluster_servers(d).collect()} for d in (df, df.repartition(7, "timestamp"), df.orderBy(F.desc("cpu_usage")))]
    assert runs[0] == runs[1] == runs[2] and set(runs[0].values()) == {0, 1, 2}
    points = {r[0]: tuple(r)[1:] for r in K.standardised(K.server_features(df).na.fill(0.0, subset=K.FEATURES)).collect()}
    label = plain_k_means(points, 3)
    assert {frozenset(s for s in label if label[s] == i) for i in range(3)} == {frozenset(s for s in runs[0] if runs[0][s] == i) for i in range(3)}


def test_clusters_of_few_and_equal_servers(spark):
    rows = [(f"s{i}", 5.0 * (i % 2), 1.0, 2.0, 3.0) for i in range(6)]
    make = lambda r: spark.createDataFrame(r, "server_id string, cpu_usage double, memory_usage double, response_time_ms double, error_rate double")
    out = {r.server_id: r.cluster for r in K.cluster_servers(make(rows)).collect()}
    assert out == {f"s{i}": i % 2 for i in range(6)}                     # two different points: two clusters
    assert [r.cluster for r in K.cluster_servers(make(rows[:1])).collect()] == [0]
    assert K.cluster_servers(make(rows).limit(0)).count() == 0


def plain_anderson_darling(v):
    import math
    x = sorted(v)
    n, mean = len(x), sum(x) / len(x)
    sd = math.sqrt(sum((a - mean) ** 2 for a in x) / (n - 1))
    lower = [math.log(0.5 * math.erfc(-(a - mean) / sd / math.sqrt(2))) for a in x]
    upper = [math.log(0.5 * math.erfc((a - mean) / sd / math.sqrt(2))) for a in x]
    raw = -n - sum((2 * i - 1) * (lower[i - 1] + upper[n - i]) for i in range(1, n + 1)) / n
    return raw * (1 + 0.75 / n + 2.25 / n ** 2)


def test_anderson_darling_by_hand_and_edges(spark):
    rng = np.random.default_rng(8)
    groups = {"normal": rng.normal(1e6, 3, 9000), "ties": np.round(rng.normal(0, 2, 6000)), "uniform": rng.uniform(0, 1, 400), "tail": rng.lognormal(0, 2, 300),
              "constant": np.full(50, 3.0), "few": rng.normal(0, 1, 7), "eight": rng.normal(0, 1, 8)}
    rows = [(k, float(x)) for k, v in groups.items() for x in v] + [(None, 1.0), ("normal", None), ("normal", float("nan"))]
    df = spark.createDataFrame(rows, "server_id string, cpu_usage double").repartition(6)
    out = {r.server_id: r for r in I.anderson_darling(df).collect()}
    assert set(out) == set(groups) and out["normal"].n == 9000
    for k in ("normal", "ties", "uniform", "tail", "eight"):
        assert out[k].statistic == pytest.approx(plain_anderson_darling(groups[k]), abs=2e-4)
    assert [out[k].is_normal for k in ("normal", "ties", "uniform", "tail", "constant", "few")] == [True, False, False, False, None, None]
    assert out["constant"].statistic is None and out["tail"].p_value == 0.0


def test_large_normal_servers_reach_anova(spark):
    from loadlens.plans.reports import homogeneity
    rng = np.random.default_rng(5)
    rows = [(f"s{i}", float(x)) for i in range(3) for x in rng.normal(50 + i, 5, 10_000)] + [("small", float(x)) for x in rng.normal(50, 5, 100)]
    df = spark.createDataFrame(rows, "server_id string, cpu_usage double")
    out = {(r.section, r.subject, r.metric): r.value for r in homogeneity(df).collect()}
    assert out[("anova", None, "homogeneous")] == 0.0
    assert out[("normality_large", "s1", "is_normal")] == 1.0 and ("normality_large", "small", "is_normal") not in out
    skewed = df.unionByName(spark.createDataFrame([("odd", float(x)) for x in rng.exponential(1, 6000)], "server_id string, cpu_usage double"))
    assert not [r for r in homogeneity(skewed).collect() if r.section == "anova"]


def test_density_is_a_vector_of_sums(spark):
    from loadlens.operators import aggregations as A
    rng = np.random.default_rng(2)
    groups = {"hot": rng.normal(5, 2, 4000), "b": np.r_[0.0, 1.0], "ties": np.repeat([1.0, 2.0, 7.0], 50), "constant": np.full(9, 4.0), "one": np.array([1.0])}
    rows = [(k, float(x)) for k, v in groups.items() for x in v] + [(None, 1.0), ("b", None)]
    df = spark.createDataFrame(rows, "server_id string, cpu_usage double").repartition(5)
    curve = A.kde_curve(df, grid=50)
    out = {}
    for r in curve.collect():
        out.setdefault(r.server_id, {})[r.point] = (r.x, r.density)
    assert set(out) == {"hot", "b", "ties"}
    for k, points in out.items():
        v = groups[k]
        h, x = v.std(ddof=1) * len(v) ** -0.2, np.linspace(v.min(), v.max(), 50)
        want = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(1) / (len(v) * h * math.sqrt(2 * math.pi))
        assert [points[i][0] for i in range(50)] == pytest.approx(list(x), abs=1e-6)
        assert [points[i][1] for i in range(50)] == pytest.approx(list(want), abs=1e-7)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    plan = A.kde_curve(df)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Generate ") == 1 and plan.index("Generate ") < plan.index("HashAggregate")     # only the finished curves are unfolded
    assert A.kde_curve(df.limit(0)).collect() == []
