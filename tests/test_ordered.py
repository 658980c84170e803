"""Order-statistic primitives against brute force, with a hot key holding a
third of the rows and under different partitionings."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadlens.operators.ordered import value_counts, with_cum_count, with_prev
from loadlens.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 6000
    key = np.where(np.arange(n) < n // 3, "hot", rng.choice(["a", "b", "c", "d"], n))
    val = np.round(rng.exponential(10, n), 1)
    pdf = pd.DataFrame({"k": key, "v": val, "seq": rng.permutation(n).astype("int64")})
    return pdf, spark.createDataFrame(pdf).repartition(7)


def test_with_prev_matches_lag(skewed):
    pdf, df = skewed
    out = with_prev(df, ["k"], "seq", ["v"], rows_per_range=100).toPandas().sort_values(["k", "seq"])
    ref = pdf.sort_values(["k", "seq"]).assign(prev=lambda d: d.groupby("k")["v"].shift())
    assert np.allclose(out["prev_v"].fillna(-1).to_numpy(), ref["prev"].fillna(-1).to_numpy())


def test_with_prev_global(skewed):
    pdf, df = skewed
    out = with_prev(df, [], "seq", ["v"], rows_per_range=100).toPandas().sort_values("seq")
    ref = pdf.sort_values("seq")["v"].shift()
    assert out["prev_v"].isna().sum() == 1
    assert np.allclose(out["prev_v"].fillna(-1).to_numpy(), ref.fillna(-1).to_numpy())


def test_cum_count_ranks(skewed):
    pdf, df = skewed
    c = with_cum_count(value_counts(df, ["k"], "v"), ["k"], "v", rows_per_range=20).toPandas()
    for k, g in pdf.groupby("k"):
        vals = np.sort(g["v"].to_numpy())
        sub = c[c.k == k]
        expect = {v: int(np.searchsorted(vals, v, "left")) for v in sub["v"]}
        assert all(expect[v] == cb for v, cb in zip(sub["v"], sub["cum_before"]))
        assert (sub["group_n"] == len(vals)).all()


@pytest.mark.parametrize("probs", [[0.25, 0.5, 0.75], [0.0, 0.1, 1.0]])
def test_exact_quantiles(skewed, probs):
    pdf, df = skewed
    q = exact_quantiles(df, ["v"], probs, [f"p{i}" for i in range(len(probs))], ["k"], inside_rows=30).toPandas()
    assert len(q) == pdf.k.nunique()
    for _, row in q.iterrows():
        ref = pdf[pdf.k == row.k]["v"].quantile(probs).to_numpy()
        assert np.allclose([row[f"v_p{i}"] for i in range(len(probs))], ref, rtol=0, atol=1e-9)


def test_quantiles_of_continuous_ties_and_edges(spark):
    rng = np.random.default_rng(3)
    n = 60_000
    pdf = pd.DataFrame({"a": rng.lognormal(0, 3, n), "b": rng.integers(0, 2, n).astype(float), "c": np.r_[np.full(n // 2, 5.0), rng.normal(0, 1, n - n // 2)],
                        "d": np.r_[[-np.inf, np.inf], rng.normal(0, 1, n - 2)], "e": np.nan})
    pdf.loc[::7, "a"] = np.nan
    df = spark.createDataFrame(pdf).repartition(5).withColumn("f", F.lit(None).cast("double"))
    probs = [0.0, 0.25, 0.999]
    for rows in (10 ** 6, 50):                                  # one bracket, and brackets within brackets
        r = exact_quantiles(df, list("abcdef"), probs, [str(i) for i in range(3)], inside_rows=rows).first()
        for c in "abcd":
            want = np.nanquantile(pdf[c], probs) if c != "d" else [-np.inf, *np.quantile(pdf[c], probs[1:])]
            assert [r[f"{c}_{i}"] for i in range(3)] == pytest.approx(list(want), rel=1e-12)
        assert (r["a_n"], r["e_n"], r["f_n"], r["e_2"], r["f_2"]) == (pdf["a"].count(), 0, 0, None, None)
    assert exact_quantiles(df.limit(0), ["a"], [0.5]).collect()[0].asDict() == {"a_n": 0, "a_q50": None}
    assert exact_quantiles(df.limit(0), ["a"], [0.5], keys=["b"]).collect() == []
    one = exact_quantiles(spark.createDataFrame([(None, 3.0), ("x", 1.0), (None, 4.0)], "k string, v double"), ["v"], [0.5], keys=["k"]).collect()
    assert {r["k"]: r["v_q50"] for r in one} == {None: 3.5, "x": 1.0}


def test_refuted_brackets_are_opened(spark, monkeypatch):
    from loadlens.operators import quantiles
    right = quantiles._bracket
    monkeypatch.setattr(quantiles, "_bracket", lambda g, n, a, b, lo, hi: (right(g, n, a, b, lo, hi)[1], right(g, n, a, b, lo, hi)[1]))   # too high
    v = np.random.default_rng(1).normal(0, 1, 5000)
    df = spark.createDataFrame(pd.DataFrame({"v": v}))
    assert exact_quantiles(df, ["v"], [0.3]).first()["v_q30"] == pytest.approx(np.quantile(v, 0.3), abs=1e-12)


def nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def test_only_the_rows_inside_brackets_leave_their_task(spark):
    df = spark.range(200_000).select(F.xxhash64("id").cast("double").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = exact_quantiles(df, ["v"], [0.25, 0.5, 0.75])._jdf.queryExecution().executedPlan()
        plan.execute().count()
        moved = [n.metrics().apply("shuffleRecordsWritten").value() for n in nodes(plan) if n.nodeName() == "Exchange"]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert moved and max(moved) < 0.03 * 200_000


def test_partitioning_does_not_change_results(skewed, spark):
    pdf, df = skewed
    a = with_prev(df.repartition(1), ["k"], "seq", ["v"], rows_per_range=10).orderBy("k", "seq").toPandas()
    b = with_prev(df.repartition(13, "v"), ["k"], "seq", ["v"], rows_per_range=10).orderBy("k", "seq").toPandas()
    pd.testing.assert_frame_equal(a.reset_index(drop=True), b.reset_index(drop=True))


def test_number_of_ranges_has_no_limit(spark):
    from loadlens.operators.ordered import ranged
    df = spark.range(400_000).select(F.lit("hot").alias("k"), F.xxhash64("id").alias("v"))
    t = ranged(df, ["k"], "v", 1_000).groupBy("_bkt").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    rows = t.orderBy("_bkt").collect()
    assert 395 <= len(rows) <= 400 and max(r["n"] for r in rows) < 10_000
    assert all(a["hi"] < b["lo"] for a, b in zip(rows, rows[1:]))


def test_small_input_takes_one_range(skewed):
    from loadlens.operators.ordered import ranged
    pdf, df = skewed
    assert ranged(df, ["k"], "seq").select("_bkt").distinct().count() == 1


def test_equal_order_is_deterministic(spark):
    df = spark.createDataFrame([(1, float(v)) for v in (3, 1, 2, 2)] + [(2, 5.0)], "seq int, v double")
    runs = {tuple(map(tuple, with_prev(df.repartition(n), [], "seq", ["v"]).orderBy("seq", "v").collect())) for n in (1, 3, 5)}
    assert len(runs) == 1
