"""Inferential statistics: normality (Shapiro-Wilk), one-way ANOVA,
Kruskal-Wallis, confidence intervals and forecast-error metrics.

Test statistics come from distributed aggregations (sums, counts, ranks);
only the final p-value / quantile of each test is evaluated by a small
Arrow UDF on the aggregated row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.functions.distributions import chi2_sf_col, f_sf_col, norm_sf_col, t_ppf_col
from loadlens.functions.numeric import norm_log_cdf_col, norm_ppf_col, np_round
from loadlens.operators.filters import drop_missing
from loadlens.operators.ordered import value_counts, with_cum_count, with_prev
from loadlens.schemas import METRIC_COLUMNS
from loadlens.session import materialize

SHAPIRO_MIN_N, SHAPIRO_MAX_N = 3, 5000   # sizes for which AS R94 defines a p-value
TIE_STEP = 100_000                      # ranks of one value spread out at a time

# Polynomial coefficients of Royston's Shapiro-Wilk
# approximation (Applied Statistics algorithm AS R94, 1995).
SW_C1 = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056]
SW_C2 = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
SW_C3 = [0.5440, -0.39978, 0.025054, -6.714e-4]
SW_C4 = [1.3822, -0.77857, 0.062767, -0.0020322]
SW_C5 = [-1.5861, -0.31082, -0.083751, 0.0038915]
SW_C6 = [-0.4803, -0.082676, 0.0030302]
SW_G = [-2.273, 0.459]


# P-value of the Anderson-Darling statistic for a normal sample of
# unknown mean and variance (D'Agostino and Stephens, 1986, table 4.9): exponents
# by ranges of the corrected statistic, lowest power first.
AD_LARGE, AD_MIDDLE = [1.2937, -5.709, 0.0186], [0.9177, -4.279, -1.38]
AD_SMALL, AD_LEAST = [-8.318, 42.796, -59.938], [-13.436, 101.14, -223.73]
AD_ZERO_FROM = 13.0                     # the fitted parabola rises again far beyond; p is below 1e-26 here


def _poly(c: Sequence[float], x: Column) -> Column:
    out = F.lit(0.0)
    for coef in reversed(c):
        out = out * x + F.lit(float(coef))
    return out


def _score(rank: Column, n: Column) -> Column:
    """Expected normal order statistic of a rank (Blom)."""
    return norm_ppf_col((rank - 0.375) / (n + 0.25))


def _ranked_sums(ranks: DataFrame) -> DataFrame:
    """Per server, sums over all ranks of score * value and score^2.  A value
    with many copies has many ranks: beyond ``TIE_STEP`` they are dealt out in
    steps to other tasks."""
    first, last = F.col("cum_before") + 1, F.col("cum_before") + F.col("cnt")
    few = ranks.where(F.col("cnt") <= TIE_STEP).select("server_id", "group_n", "d", F.explode(F.sequence(first, last)).alias("i"))
    many = ranks.where(F.col("cnt") > TIE_STEP).select("server_id", "group_n", "d", last.alias("last"),
                                                       F.explode(F.sequence(first, last, F.lit(TIE_STEP).cast("bigint"))).alias("lo"))
    many = many.repartition("server_id", "lo").select(
        "server_id", "group_n", "d", F.explode(F.sequence("lo", F.least(F.col("lo") + TIE_STEP - 1, F.col("last")))).alias("i"))
    m = _score(F.col("i"), F.col("group_n"))
    return few.unionAll(many).select("server_id", "d", m.alias("m")).groupBy("server_id").agg(
        F.sum(F.col("m") * F.col("d")).alias("mx"), F.sum(F.col("m") * F.col("m")).alias("mm"))


def normality_test(df: DataFrame, column: str = "cpu_usage", key: str = "server_id") -> DataFrame:
    """Shapiro-Wilk W for every group of three values or more, whatever its size,
    from the table of order statistics: one row per group with ``n, statistic,
    p_value, is_normal``, sample ``skewness`` and (excess) ``kurtosis``, the
    Jarque-Bera ``jb_p_value`` and a ``reason`` where there is no p-value
    ("n > 5000": AS R94 defines none; "n < 3"; "constant").  NaN values count as
    missing."""
    data = drop_missing(df.select(F.col(key).cast("string").alias("server_id"), F.col(column).cast("double").alias("v")), ["server_id", "v"])
    moments = materialize(data.groupBy("server_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"), F.var_pop("v").alias("var"), F.skewness("v").alias("skewness"),
        F.kurtosis("v").alias("kurtosis")))
    ranks = materialize(with_cum_count(value_counts(data, ["server_id"], "v"), ["server_id"], "v")
                        .join(moments.select("server_id", "mean"), "server_id").withColumn("d", F.col("v") - F.col("mean")))
    at = lambda r: F.max(F.when((F.col("cum_before") < r) & (r <= F.col("cum_before") + F.col("cnt")), F.col("d")))
    ends = ranks.groupBy("server_id").agg(at(F.lit(1)).alias("x1"), at(F.lit(2)).alias("x2"), at(F.col("group_n") - 1).alias("y2"),
                                          at(F.col("group_n")).alias("y1"))
    s = moments.join(ends, "server_id").join(_ranked_sums(ranks), "server_id")
    n = F.col("n").cast("double")
    # scores of the two least ranks, and the weights of the two ends
    s = s.withColumn("m1", _score(F.lit(1.0), n)).withColumn("m2", _score(F.lit(2.0), n)).withColumn("root", F.sqrt("mm"))
    s = s.withColumn("a1", F.when(n > 3, _poly(SW_C1, 1 / F.sqrt(n)) - F.try_divide(F.col("m1"), F.col("root"))).otherwise(F.lit(0.5 ** 0.5)))
    s = s.withColumn("a2", F.when(n > 5, F.try_divide(-F.col("m2"), F.col("root")) + _poly(SW_C2, 1 / F.sqrt(n))).otherwise(F.lit(0.0)))
    two = (n > 5).cast("double")
    left = F.col("mm") - 2 * F.col("m1") * F.col("m1") - 2 * two * F.col("m2") * F.col("m2")
    s = s.withColumn("fac", F.sqrt(F.try_divide(left, 1 - 2 * F.col("a1") * F.col("a1") - 2 * F.col("a2") * F.col("a2"))))
    inner = F.col("mx") - F.col("m1") * (F.col("x1") - F.col("y1")) - two * F.col("m2") * (F.col("x2") - F.col("y2"))
    part = F.when(n > 3, F.try_divide(inner, F.col("fac"))).otherwise(F.lit(0.0))
    fit = part + F.col("a1") * (F.col("y1") - F.col("x1")) + two * F.col("a2") * (F.col("y2") - F.col("x2"))
    s = s.withColumn("W", F.when((F.col("n") >= SHAPIRO_MIN_N) & (F.col("var") > 0), F.least(F.try_divide(fit * fit, n * F.col("var")), F.lit(1.0))))
    ln, y = F.log(n), F.log(F.greatest(1 - F.col("W"), F.lit(1e-300)))
    gamma = _poly(SW_G, n)
    small = (-F.log(F.greatest(gamma - y, F.lit(1e-300))) - _poly(SW_C3, n)) / F.exp(_poly(SW_C4, n))
    large = (y - _poly(SW_C5, ln)) / F.exp(_poly(SW_C6, ln))
    z = F.when(n <= 11, F.when(y < gamma, small).otherwise(F.lit(40.0))).otherwise(large)
    three = F.greatest(F.lit(6 / math.pi) * (F.asin(F.sqrt("W")) - math.pi / 3), F.lit(0.0))
    defined = F.col("W").isNotNull() & (F.col("n") <= SHAPIRO_MAX_N)
    s = s.withColumn("z", F.when(defined & (n > 3), z))
    s = s.withColumn("p", F.when(defined, F.when(n == 3, three).otherwise(norm_sf_col(F.col("z")))))
    jb = n / 6 * (F.col("skewness") * F.col("skewness") + F.col("kurtosis") * F.col("kurtosis") / 4)
    reason = F.when(F.col("n") < SHAPIRO_MIN_N, "n < 3").when(F.col("var") <= 0, "constant").when(F.col("n") > SHAPIRO_MAX_N, "n > 5000")
    return s.select(F.col("server_id").alias(key), "n", np_round("W", 4).alias("statistic"), np_round("p", 4).alias("p_value"),
                    (F.col("p") > 0.05).alias("is_normal"), np_round(F.when(F.col("var") > 0, F.col("skewness")), 4).alias("skewness"),
                    np_round(F.when(F.col("var") > 0, F.col("kurtosis")), 4).alias("kurtosis"),
                    np_round(F.when(F.col("var") > 0, F.exp(-jb / 2)), 4).alias("jb_p_value"), reason.alias("reason"))


def anderson_darling(df: DataFrame, column: str = "cpu_usage", key: str = "server_id") -> DataFrame:
    """Anderson-Darling test of normality with estimated mean and variance, for
    groups of any size: ``key, n, statistic`` (corrected for n), ``p_value,
    is_normal``; the last three are NULL below 8 values and for constant groups.

    The statistic weighs the log-probabilities of each value by its ranks; for a
    run of equal values the weights add up in closed form, so a distinct value
    costs one row, and a group is spread over ranges of its values."""
    data = drop_missing(df.select(F.col(key).cast("string").alias("server_id"), F.col(column).cast("double").alias("v")), ["server_id", "v"])
    counts = materialize(value_counts(data, ["server_id"], "v"))            # every pass below reads this
    mean = counts.groupBy("server_id").agg((F.sum(F.col("v") * F.col("cnt")) / F.sum("cnt")).alias("mean"), F.sum("cnt").alias("n"))
    off = F.col("v") - F.col("mean")
    spread = counts.join(mean, "server_id").groupBy("server_id").agg(
        F.first("mean").alias("mean"), F.first("n").alias("n"), F.sum(F.col("cnt") * off * off).alias("squares"), (F.max("v") > F.min("v")).alias("varied"))
    moments = materialize(spread.withColumn("sd", F.when(F.col("varied"), F.sqrt(F.try_divide(F.col("squares"), F.col("n") - 1)))))
    ranks = with_cum_count(counts, ["server_id"], "v", checkpoint=False).join(moments.select("server_id", "mean", "sd"), "server_id")
    n, a, b = (c.cast("double") for c in (F.col("group_n"), F.col("cum_before"), F.col("cum_before") + F.col("cnt")))
    z = F.try_divide(off, F.col("sd"))
    term = (b - a) * (b + a) * norm_log_cdf_col(z) + (b - a) * (2 * n - a - b) * norm_log_cdf_col(-z)      # sums of 2i-1 and 2(n-i)+1
    s = moments.join(ranks.groupBy("server_id").agg(F.sum(term / n + F.col("cnt")).alias("rest")), "server_id")      # the n is taken off term by term
    n = F.col("n").cast("double")
    s = s.withColumn("A", F.when((F.col("n") >= 8) & F.col("varied"), -F.col("rest") * (1 + 0.75 / n + 2.25 / (n * n))))
    A = F.col("A")
    p = F.when(A >= AD_ZERO_FROM, 0.0).when(A >= 0.6, F.exp(_poly(AD_LARGE, A))).when(A > 0.34, F.exp(_poly(AD_MIDDLE, A)))\
        .when(A > 0.2, 1 - F.exp(_poly(AD_SMALL, A))).when(A.isNotNull(), 1 - F.exp(_poly(AD_LEAST, A)))
    return s.select(F.col("server_id").alias(key), "n", np_round("A", 4).alias("statistic"), np_round(p, 4).alias("p_value"), (p > 0.05).alias("is_normal"))


def _group_moments(df: DataFrame, column: str, key: str) -> DataFrame:
    return (df.where(F.col(key).isNotNull() & F.col(column).isNotNull())
              .groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg(column).alias("m"),
                                F.var_samp(column).alias("v")))


def anova(df: DataFrame, column: str = "cpu_usage", key: str = "server_id") -> DataFrame:
    """One-way ANOVA F test across groups (one row; none for < 2 groups).  The
    squares between groups are taken about the grand mean, so values far from
    zero keep their digits; F is NULL where the within-group part is empty."""
    g = materialize(_group_moments(df, column, key))        # one row per group
    mean = g.agg(F.try_divide(F.sum(F.col("n") * F.col("m")), F.sum("n")).alias("grand"))
    off = F.col("m") - F.col("grand")
    s = g.crossJoin(F.broadcast(mean)).agg(                  # one row
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("N"), F.sum(F.col("n") * off * off).alias("ssb"),
        F.sum(F.coalesce((F.col("n") - 1) * F.col("v"), F.lit(0.0))).alias("ssw"))
    fstat = F.try_divide(F.try_divide(F.col("ssb"), F.col("k") - 1), F.try_divide(F.col("ssw"), F.col("N") - F.col("k")))
    s = s.where(F.col("k") >= 2).select("k", "N", fstat.alias("_f"))
    p = F.when(F.col("_f").isNotNull(), f_sf_col(F.col("_f"), F.col("k") - 1, F.col("N") - F.col("k")))
    return s.select(np_round("_f", 4).alias("f_statistic"), np_round(p, 4).alias("p_value"),
                    (p > 0.05).alias("homogeneous"),
                    (F.col("k") - 1).cast("bigint").alias("df_between"),
                    (F.col("N") - F.col("k")).cast("bigint").alias("df_within"))


def kruskal_wallis(df: DataFrame, column: str = "cpu_usage", key: str = "server_id") -> DataFrame:
    """Kruskal-Wallis H with tie correction; p from chi-square(k - 1).

    Ranks are tie-averaged global ranks: distinct values with counts, running
    counts from :func:`with_cum_count` (no single-partition window), then a
    rank-sum per group.  One row; none for fewer than two non-empty groups."""
    data = df.where(F.col(key).isNotNull() & F.col(column).isNotNull()).select(key, F.col(column).alias("v"))
    # (group, value, count) written once; the value totals and rank sums read it
    per_group = materialize(value_counts(data, [key], "v"))
    totals = with_cum_count(per_group.groupBy("v").agg(F.sum("cnt").alias("cnt")), [], "v")
    ranks = totals.select("v", (F.col("cum_before") + (F.col("cnt") + 1) / 2.0).alias("rank"),
                          F.col("cnt").alias("t"), F.col("group_n").alias("_total"))
    per = per_group.join(ranks, "v")
    groups = per.groupBy(key).agg(F.sum(F.col("cnt") * F.col("rank")).alias("R"),
                                  F.sum("cnt").alias("n"), F.first("_total").alias("_total"))
    tie = ranks.agg(F.sum(F.pow(F.col("t"), 3) - F.col("t")).alias("_ties"))
    # squares about the mean rank: no difference of two large terms
    off = F.col("R") / F.col("n") - (F.col("_total") + 1) / 2.0
    s = groups.agg(F.count(F.lit(1)).alias("k"), F.first("_total").alias("_total"),
                   F.sum(F.col("n") * off * off).alias("_s")).crossJoin(tie)
    N = F.col("_total").cast("double")
    h = F.lit(12.0) / (N * (N + 1)) * F.col("_s")
    corr = F.lit(1.0) - F.col("_ties") / (N * N * N - N)
    hc = F.try_divide(h, F.when(corr > 0, corr))
    s = s.where(F.col("k") >= 2).select("k", hc.alias("_h"))
    p = chi2_sf_col(F.col("_h"), F.col("k") - 1)
    return s.select(np_round("_h", 4).alias("h_statistic"), np_round(p, 4).alias("p_value"),
                    (p > 0.05).alias("homogeneous"), (F.col("k") - 1).cast("bigint").alias("df"))


def confidence_intervals(df: DataFrame, columns: Sequence[str] = METRIC_COLUMNS,
                         level: float = 0.95) -> DataFrame:
    """t-based interval for the mean of each column, 10 fields per column.
    Columns that are absent or have fewer than two values are skipped."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame([], "metric string")
    agg = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)],
                 *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(cols)])
    long = agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("m"),
                 F.col(f"s{i}").alias("s")) for i, c in enumerate(cols)])).alias("e")).select("e.*")
    long = long.where(F.col("n") >= 2)
    t = t_ppf_col(F.lit(1.0 - (1.0 - level) / 2.0), F.col("n") - 1)
    long = long.withColumn("t", t).withColumn("se", F.col("s") / F.sqrt(F.col("n")))\
        .withColumn("moe", F.col("t") * F.col("se"))
    rel = F.when(F.col("m") != 0, F.col("moe") / F.col("m") * 100).otherwise(F.lit(0.0))
    return long.select("metric", np_round("m", 4).alias("mean"), np_round("s", 4).alias("std_dev"),
                       F.col("n").cast("bigint").alias("sample_size"),
                       F.lit(float(level)).alias("confidence_level"),
                       np_round("t", 4).alias("t_critical"), np_round("se", 4).alias("standard_error"),
                       np_round("moe", 4).alias("margin_of_error"),
                       np_round(F.col("m") - F.col("moe"), 4).alias("ci_lower"),
                       np_round(F.col("m") + F.col("moe"), 4).alias("ci_upper"),
                       np_round(rel, 2).alias("relative_error_percent"))


def error_metrics(pairs: DataFrame, predicted: str = "predicted", actual: str = "actual",
                  order: str = "seq") -> DataFrame:
    """MAE, MSE, RMSE, MAPE (over actual != 0), R^2 and Durbin-Watson of
    ``predicted - actual`` in ``order``.  Rows with a missing side are
    dropped; absent metrics are NULL; an empty input gives no row."""
    ok = drop_missing(pairs, [predicted, actual])
    e = ok.select(order, (F.col(predicted) - F.col(actual)).alias("e"), F.col(actual).alias("a"))
    # successive differences of the residual series (range-bucketed lag)
    lagged = with_prev(e, [], order, ["e"])
    s = lagged.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs("e")).alias("mae"),
        F.avg(F.col("e") * F.col("e")).alias("mse"),
        F.avg(F.when(F.col("a") != 0, F.abs(F.col("e") / F.col("a")))).alias("_mape"),
        F.sum(F.col("e") * F.col("e")).alias("_ss_res"),
        (F.var_pop("a") * F.count("a")).alias("_ss_tot"),
        F.sum(F.pow(F.col("e") - F.col("prev_e"), 2)).alias("_dw_num"))
    r2 = F.when(F.col("_ss_tot") != 0, F.lit(1.0) - F.col("_ss_res") / F.col("_ss_tot"))
    dw = F.when(F.col("n") > 1, F.try_divide(F.col("_dw_num"), F.col("_ss_res")))
    return s.where(F.col("n") > 0).select(
        F.col("n").cast("bigint").alias("n"),
        np_round("mae", 4).alias("mae"), np_round("mse", 4).alias("mse"),
        np_round(F.sqrt("mse"), 4).alias("rmse"), np_round(F.col("_mape") * 100, 4).alias("mape"),
        np_round(r2, 4).alias("r_squared"), np_round(dw, 4).alias("durbin_watson"))
