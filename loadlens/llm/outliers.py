"""Quality rules: robust multivariate outliers, natively.

Base statistics of each whole text come from built-in functions; they become a
vector of transformed statistics.  For each language and source the minimum
covariance determinant is estimated: concentration steps keep the ``SUBSET``
share of documents with the least Mahalanobis distance and estimate centre and
covariance from them until the determinant settles, from two deterministic
starts; the smaller determinant wins.  Documents beyond a chi-square cutoff are
rejected.

Everything is DataFrame work: a step is one histogram of distances on a fixed
grid (so the kept share is found by adding up a few hundred counts, never by
sorting a group) and one set of moments per group.  Both are partial
aggregations: a group with a third of all rows costs one row per task.  The
covariance is factored (LDL') in column expressions on the table of groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.llm.common import MAX_BROADCAST_ROWS, checkpointed, join_small, written

MIN_WORDS = 50
SUBSET = 0.75          # share of a group that the estimate rests on
MIN_GROUP = 200        # smaller groups are judged with their language, or with all
STEPS = 6              # most concentration steps
GRID = 16              # distance grid: steps for each doubling
FLOOR = (0.20, 0.05, 0.04, 0.10, 0.08)  # least standard deviation of each statistic
CUTOFF = 35.0          # squared distance; chi-square with 5 degrees of freedom exceeds it once in 660,000
FEATURES = ("f0", "f1", "f2", "f3", "f4")
_SPACE = "[ \\t-\\r]+"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(words: Column) -> Column:
    """Words lying in 3-word windows found twice or more in ``words``.

    Each window is a 64-bit hash; hash and place are packed into one long, so
    one primitive sort brings equal windows together.  As many bits as the
    places need are taken from the hash; neighbours that agree in the rest are
    confirmed by their whole hashes."""
    def of_hashes(h: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(h) - 2),
                              lambda i: F.xxhash64(F.element_at(h, i), F.element_at(h, i + 1), F.element_at(h, i + 2)))
        return _let(windows, of_windows)

    def of_windows(w: Column) -> Column:
        low = F.pow(F.lit(2.0), F.ceil(F.log2(F.size(w) + F.lit(1.0)))).cast("bigint") - 1  # the places' bits
        return _let(low, lambda m: _let(
            F.sort_array(F.transform(w, lambda x, i: x.bitwiseAND(F.bitwise_not(m)).bitwiseOR(i.cast("bigint")))), lambda s: of_sorted(w, s, m)))

    def of_sorted(w: Column, s: Column, m: Column) -> Column:
        def same(x: Column, y: Column) -> Column:
            return F.coalesce((F.bitwise_not(m).bitwiseAND(x.bitwiseXOR(y)) == 0)
                              & (F.get(w, x.bitwiseAND(m).cast("int")) == F.get(w, y.bitwiseAND(m).cast("int"))), F.lit(False))
        twice = F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)))
        return _let(F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(m))), covered)

    def covered(p: Column) -> Column:
        three = F.lit(3).cast("bigint")
        return F.aggregate(F.transform(p, lambda x, i: F.coalesce(F.least(three, F.get(p, i + 1) - x), three)), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return F.when(F.size(words) < 4, F.lit(0).cast("bigint")).otherwise(_let(F.transform(words, lambda x: F.xxhash64(x)), of_hashes))


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, lang, source`` and the base statistics of each whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    solid = F.regexp_replace(t, _SPACE, "")
    words = F.array_remove(F.split(t, _SPACE), "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    return docs.select(
        "doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        _let(words, lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), _repeated_words(w).alias("n_repeat_words"))).alias("w"),
        _let(lines, lambda x: F.struct(F.size(x).cast("bigint").alias("n_lines"),
                                       (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"))).alias("l"),
        _let(solid, lambda c: F.struct(F.length(c).cast("bigint").alias("word_chars"),
                                       F.length(F.regexp_replace(c, "[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"))).alias("c"))\
        .select("doc_id", "lang", "source", "w.*", "l.*", "c.*")


def with_features(base: DataFrame) -> DataFrame:
    """The vector that distances are taken of: size, word length, and the shares
    of symbols (as root), repeated lines and repeated words."""
    def share(part: str, whole: str) -> Column:
        return F.col(part) / (F.col(whole) + 1.0)
    return base.select(
        "*", F.log(F.col("n_words") + 10.0).alias("f0"),
        F.log((F.col("word_chars") + 5.0) / (F.col("n_words") + 1.0)).alias("f1"),
        F.sqrt(share("n_symbols", "word_chars")).alias("f2"), share("n_dup_lines", "n_lines").alias("f3"),
        share("n_repeat_words", "n_words").alias("f4"))


def _factor(groups: DataFrame, d: int) -> DataFrame:
    """LDL' of the covariance ``c_ij`` (i >= j) of each row: ``l_ij`` and ``p_i``,
    and the log determinant ``logdet``."""
    g = groups
    for j in range(d):
        below = [F.col(f"l_{j}_{k}") * F.col(f"l_{j}_{k}") * F.col(f"p_{k}") for k in range(j)]
        g = g.withColumn(f"p_{j}", F.greatest(F.col(f"c_{j}_{j}") - sum(below, F.lit(0.0)), F.lit(1e-12)))
        g = g.withColumns({f"l_{i}_{j}": (F.col(f"c_{i}_{j}") - sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") * F.col(f"p_{k}") for k in range(j)),
                                                                 F.lit(0.0))) / F.col(f"p_{j}") for i in range(j + 1, d)}) if j + 1 < d else g
    return g.withColumn("logdet", sum((F.log(f"p_{j}") for j in range(d)), F.lit(0.0)))


def _distance(d: int) -> Column:
    """Squared Mahalanobis distance of ``f_i`` to ``m_i`` by forward substitution."""
    y: list[Column] = []
    for i in range(d):
        y.append(F.col(FEATURES[i]) - F.col(f"m_{i}") - sum((F.col(f"l_{i}_{k}") * y[k] for k in range(i)), F.lit(0.0)))
    return sum((y[i] * y[i] / F.col(f"p_{i}") for i in range(d)), F.lit(0.0))


def _estimate(rows: DataFrame, keys: list[str], d: int, floor: tuple[float, ...]) -> DataFrame:
    """Centre and covariance of ``rows`` for each group, the variances raised by
    the floors (a statistic that is constant in a subset stays usable)."""
    f = [F.col(c) for c in FEATURES[:d]]
    g = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.avg(f[i]).alias(f"m_{i}") for i in range(d)],
                                *[F.covar_pop(f[i], f[j]).alias(f"c_{i}_{j}") for i in range(d) for j in range(i + 1)])
    g = g.withColumns({f"c_{i}_{j}": F.col(f"c_{i}_{j}") * _CONSISTENT + F.lit(floor[i] ** 2 if i == j else 0.0) for i in range(d) for j in range(i + 1)})
    return checkpointed(_factor(g, d))


#: Covariances of the nearest 75 % of a 5-dimensional normal sample are too small
#: by P(chi2_7 <= 6.6257) / 0.75, fixed value.
_CONSISTENT = 0.75 / 0.5309


def _upto(cells: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Grid cell ``upto`` at which the least ``share`` of each group's rows is reached."""
    counts = cells.groupBy(*keys, "cell").agg(F.count(F.lit(1)).alias("c"))
    by = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # a few hundred cells a group
    counts = counts.withColumn("before", F.coalesce(F.sum("c").over(by), F.lit(0))).withColumn("all", F.sum("c").over(Window.partitionBy(*keys)))
    return counts.where(F.col("before") < F.ceil(F.col("all") * share)).groupBy(*keys).agg(F.max("cell").alias("upto"))


def _medians(rows: DataFrame, values: list[Column]) -> DataFrame:
    """``grp, v_0..``: medians of ``values`` to the grid of 1/64."""
    cells = rows.select("grp", F.posexplode(F.array(*values)).alias("i", "v")).select("grp", "i", F.floor(F.col("v") * 64).alias("cell"))
    return _upto(cells, ["grp", "i"], 0.5).groupBy("grp").agg(
        *[(F.max(F.when(F.col("i") == i, F.col("upto"))) / 64 + 1 / 128).alias(f"v_{i}") for i in range(len(values))])


def _with_distance(rows: DataFrame, groups: DataFrame, keys: list[str], d: int, few: bool) -> DataFrame:
    figures = [f"m_{i}" for i in range(d)] + [f"p_{i}" for i in range(d)] + [f"l_{i}_{j}" for i in range(d) for j in range(i)]
    out = join_small(rows, groups.select(*keys, *figures), keys, few=few).withColumn("d2", _distance(d)).drop(*figures)
    # cells of equal ratio between 2^-10 and 2^30
    return out.withColumn("cell", F.floor(F.log2(F.greatest(F.least("d2", F.lit(2.0 ** 30)), F.lit(2.0 ** -10))) * GRID).cast("int"))


def minimum_covariance(rows: DataFrame, subset: float = SUBSET, steps: int = STEPS, floor: tuple[float, ...] = FLOOR) -> DataFrame:
    """MCD of the features of ``rows(grp, f0..)``: for each ``grp`` the centre
    ``m_i``, the factors ``l_ij`` and ``p_i``, ``logdet`` and its size ``n``."""
    d, keys = len(FEATURES), ["grp", "start"]
    both = rows.select("grp", *FEATURES).withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    # start 0: medians and absolute deviations; start 1: all rows
    centre = checkpointed(_medians(rows, [F.col(c) for c in FEATURES]))
    few = 2 * centre.count() <= MAX_BROADCAST_ROWS
    off = join_small(rows, centre, ["grp"], few=few)
    spread = _medians(off, [F.abs(F.col(c) - F.col(f"v_{i}")) for i, c in enumerate(FEATURES)])
    spread = spread.select("grp", *[F.col(f"v_{i}").alias(f"a_{i}") for i in range(d)])
    robust = centre.join(spread, "grp").select(
        "grp", F.lit(0).alias("start"), F.lit(0).cast("bigint").alias("n"), *[F.col(f"v_{i}").alias(f"m_{i}") for i in range(d)],
        *[(F.lit(0.0) if i != j else F.pow(1.4826 * F.col(f"a_{i}"), F.lit(2.0)) + floor[i] ** 2).alias(f"c_{i}_{j}") for i in range(d) for j in range(i + 1)])
    groups = checkpointed(_factor(robust, d).unionByName(_estimate(both.where("start = 1"), keys, d, floor)))
    for _ in range(steps):
        dist = _with_distance(both, groups, keys, d, few)
        near = join_small(dist, _upto(dist, keys, subset), keys, few=few).where(F.col("cell") <= F.col("upto"))
        new = _estimate(near, keys, d, floor)
        moved = new.select(*keys, F.col("logdet").alias("new")).join(groups.select(*keys, "logdet"), keys)\
            .where(F.abs(F.col("new") - F.col("logdet")) > 1e-3).take(1)
        groups = new
        if not moved:
            break
    best = groups.groupBy("grp").agg(F.min_by("start", F.struct("logdet", "start")).alias("start"))
    return checkpointed(groups.join(best, ["grp", "start"]).drop("start"))


def _name(*values: Column) -> Column:
    """One text for the values of a group, nulls told apart from texts."""
    return F.concat_ws("|", F.lit(str(len(values))), *[F.coalesce(F.base64(F.encode(v, "utf-8")), F.lit("-")) for v in values])


def judge(docs: DataFrame, min_words: int = MIN_WORDS, cutoff: float = CUTOFF, min_group: int = MIN_GROUP) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, distance, kept``.

    ``base_failed``: under ``min_words`` words, or over half the words in
    repeated 3-word windows.  The estimate rests on the others; ``distance`` is
    their robust Mahalanobis distance (null where base_failed).  Null and empty
    texts have no words.  Null lang or source is a value of its own.  A group of
    under ``min_group`` such documents is judged with its whole language, and a
    language of under as many with all documents.  Only doc_id, text, lang and
    source are read; an empty table gives an empty result."""
    base = with_features(with_base(docs)).withColumn(
        "base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    rows = written(base, "outliers")
    passed = rows.where("not base_failed")
    sizes = passed.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    # a row for each language and source
    sizes = sizes.withColumn("n_lang", F.sum("n").over(Window.partitionBy("lang")))
    name, lang = _name(F.col("lang"), F.col("source")), _name(F.col("lang"))
    level = checkpointed(sizes.select(name.alias("name"), F.when(F.col("n") >= min_group, name)
                                      .when(F.col("n_lang") >= min_group, lang).otherwise(F.lit("all")).alias("grp")))
    at = join_small(passed.withColumn("name", name), level, ["name"])
    # a level's estimate rests on all documents of that level, not on its small groups alone
    wanted = checkpointed(level.select("grp").distinct())
    pool = passed.select("lang", "source", *FEATURES).select(
        F.explode(F.array(name, lang, F.lit("all"))).alias("grp"), *FEATURES)
    pool = written(join_small(pool, wanted, ["grp"]), "outliers-pool")
    groups = minimum_covariance(pool)
    scored = join_small(at, groups.drop("n", "logdet"), ["grp"]).withColumn("distance", F.sqrt(_distance(len(FEATURES))))
    out = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return scored.select(*out, "distance", (F.col("distance") * F.col("distance") <= cutoff).alias("kept")).unionAll(
        rows.where("base_failed").select(*out, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept")))

