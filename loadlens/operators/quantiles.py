"""Exact quantiles by bracketing: no sort and no exchange of all values.

A mergeable sketch gives, for each wanted rank, two values that should enclose it.
One aggregation then counts the rows below and inside every bracket, which proves
or refutes it; a refuted side is moved out, and a bracket that holds too many rows
is sketched again on its own rows.  In the end only the rows inside the brackets
(a few thousandths of the table, fewer after another round) are collapsed to
distinct values and ranked.  Every pass is a partial aggregation over one scan, and
all columns and probabilities share the passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions.numeric import nan_to_null
from loadlens.session import materialize

GRID = 500                  # quantiles read off a sketch
ACCURACY = 5_000            # a sketch's rank error is at most 1 / ACCURACY: less than a grid step
INSIDE_ROWS = 1_000_000     # rows of a bracket that one task ranks
MAX_BROADCAST_GROUPS = 20_000


def _sketch(column: str) -> Column:
    """``GRID + 1`` evenly spaced approximate quantiles of a column."""
    return F.expr(f"percentile_approx({column}, array({', '.join(f'{i / GRID}D' for i in range(GRID + 1))}), {ACCURACY})")


def _bracket(grid: Column, rows: Column, rank_lo: Column, rank_hi: Column, lo: Column, hi: Column) -> tuple[Column, Column]:
    """The grid values around the ranks (counted among the sketched ``rows``), a
    step further out; ``lo`` and ``hi`` beyond the grid."""
    last = F.greatest(rows - 1, F.lit(1)).cast("double")
    i = F.floor(rank_lo / last * GRID).cast("int") - 1
    j = F.ceil(rank_hi / last * GRID).cast("int") + 1
    return F.when(i < 0, lo).otherwise(F.get(grid, i)), F.when(j > GRID, hi).otherwise(F.get(grid, j))


class _Targets:
    """The wanted (column, probability) pairs and their column names."""

    def __init__(self, columns: Sequence[str], probs: Sequence[float]):
        self.columns, self.probs = list(columns), [float(p) for p in probs]
        self.all = [(c, p) for c in range(len(self.columns)) for p in range(len(self.probs))]

    def value(self, c: int) -> Column:
        return F.col(f"_v{c}")

    def ranks(self, c: int, p: int) -> tuple[Column, Column]:
        at = (F.col(f"_n{c}") - 1) * F.lit(self.probs[p])
        return F.floor(at), F.ceil(at)

    def inside(self, c: int, p: int) -> Column:
        return self.value(c).between(F.col(f"_lo{c}_{p}"), F.col(f"_hi{c}_{p}"))


def _with_groups(rows: DataFrame, state: DataFrame, keys: Sequence[str], few: bool) -> DataFrame:
    """``rows`` with their group's row of ``state``; without keys that is one row."""
    if not keys:
        return rows.crossJoin(F.broadcast(state))
    state = state.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in state.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return rows.join(F.broadcast(state) if few else state, same).drop(*[f"_{k}" for k in keys])


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], names: Sequence[str] | None = None, keys: Sequence[str] = (),
                    inside_rows: int = INSIDE_ROWS) -> DataFrame:
    """Exact quantiles with linear interpolation (the pandas and NumPy default):
    position ``h = (n-1)p``, ``x[floor h] + (h - floor h)(x[ceil h] - x[floor h])``.

    One row per group (one row without keys): ``keys..., {column}_n,
    {column}_{name}...``.  NULL and NaN are no values; without values the quantiles
    are NULL; NULL keys are a group; an empty table gives one row without keys and
    none with them.  ``inside_rows`` bounds the rows a task ranks, not the result."""
    t, given, keys = _Targets(columns, probs), list(keys), [f"_k{i}" for i in range(len(keys))]
    names = list(names or [f"q{round(p * 100)}" for p in t.probs])
    rows = df.select(*[F.col(g).alias(k) for g, k in zip(given, keys)], *[nan_to_null(F.col(c).cast("double")).alias(f"_v{i}") for i, c in enumerate(t.columns)])
    counts = [F.count(t.value(c)).alias(f"_n{c}") for c in range(len(t.columns))]
    first = rows.groupBy(*keys).agg(*counts, *[_sketch(f"_v{c}").alias(f"_g{c}") for c in range(len(t.columns))])
    kept = [*keys, *[f"_n{c}" for c in range(len(t.columns))]]
    brackets = []
    for c, p in t.all:
        lo, hi = _bracket(F.col(f"_g{c}"), F.col(f"_n{c}"), *t.ranks(c, p), F.lit(float("-inf")), F.lit(float("inf")))
        brackets += [lo.alias(f"_lo{c}_{p}"), hi.alias(f"_hi{c}_{p}")]
    state = materialize(first.select(*kept, *brackets))                 # a row per group: counts and brackets
    few = not keys or state.count() <= MAX_BROADCAST_GROUPS
    state, left = _settled(rows, state, t, keys, kept, few), None
    while True:
        big = [F.coalesce((F.col(f"_in{c}_{p}") > inside_rows) & (F.col(f"_lo{c}_{p}") < F.col(f"_hi{c}_{p}")), F.lit(False)) for c, p in t.all]
        many = state.agg(F.sum(sum(F.when(b, F.col(f"_in{c}_{p}")).otherwise(F.lit(0)) for b, (c, p) in zip(big, t.all)))).first()[0]
        if not many or (left is not None and 2 * many > left):          # small enough, or equal values that no bracket parts
            break
        left = many
        held = _with_groups(rows, state, keys, few).select(*keys, *[F.when(b & t.inside(c, p), t.value(c)).alias(f"_s{c}_{p}") for b, (c, p) in zip(big, t.all)])
        again = held.groupBy(*keys).agg(*[_sketch(f"_s{c}_{p}").alias(f"_g{c}_{p}") for c, p in t.all])
        both = _with_groups(state, again, keys, few)
        brackets = []
        for b, (c, p) in zip(big, t.all):
            lo_rank, hi_rank = (x - F.col(f"_below{c}_{p}") for x in t.ranks(c, p))
            old = F.col(f"_lo{c}_{p}"), F.col(f"_hi{c}_{p}")
            new = _bracket(F.col(f"_g{c}_{p}"), F.col(f"_in{c}_{p}"), lo_rank, hi_rank, *old)
            brackets += [F.when(b, n).otherwise(o).alias(f"_{side}{c}_{p}") for side, n, o in zip(("lo", "hi"), new, old)]
        state = _settled(rows, materialize(both.select(*kept, *brackets)), t, keys, kept, few)
    return _read_off(rows, state, t, keys, names, few).withColumnsRenamed(dict(zip(keys, given)))


def _settled(rows: DataFrame, state: DataFrame, t: _Targets, keys: list[str], kept: list[str], few: bool) -> DataFrame:
    """``state`` with the rows below (``_below``) and inside (``_in``) each bracket;
    a side that the counts refute is opened and counted again."""
    while True:
        aggs = []
        for c, p in t.all:
            aggs += [F.count_if(t.value(c) < F.col(f"_lo{c}_{p}")).alias(f"_below{c}_{p}"), F.count_if(t.inside(c, p)).alias(f"_in{c}_{p}")]
        names = [f"_{side}{c}_{p}" for c, p in t.all for side in ("lo", "hi")]
        counted = _with_groups(rows, state.select(*keys, *names), keys, few).groupBy(*keys).agg(*aggs)
        state = materialize(_with_groups(state, counted, keys, few))
        low = [F.col(f"_below{c}_{p}") > t.ranks(c, p)[0] for c, p in t.all]
        high = [F.col(f"_below{c}_{p}") + F.col(f"_in{c}_{p}") <= t.ranks(c, p)[1] for c, p in t.all]
        has = [F.col(f"_n{c}") > 0 for c, _ in t.all]
        wrong = reduce(lambda a, b: a | b, [n & (x | y) for n, x, y in zip(has, low, high)])
        if not state.where(wrong).take(1):
            return state
        opened = []
        for n, x, y, (c, p) in zip(has, low, high, t.all):
            opened += [F.when(n & x, F.lit(float("-inf"))).otherwise(F.col(f"_lo{c}_{p}")).alias(f"_lo{c}_{p}"),
                       F.when(n & y, F.lit(float("inf"))).otherwise(F.col(f"_hi{c}_{p}")).alias(f"_hi{c}_{p}")]
        state = state.select(*kept, *opened)


def _read_off(rows: DataFrame, state: DataFrame, t: _Targets, keys: list[str], names: list[str], few: bool) -> DataFrame:
    """Rank the distinct values inside each bracket and interpolate."""
    picks = []
    for i, (c, p) in enumerate(t.all):
        lo, hi = (x - F.col(f"_below{c}_{p}") for x in t.ranks(c, p))
        picks.append(F.when(t.inside(c, p), F.struct(F.lit(i).alias("t"), lo.alias("lo"), hi.alias("hi"), t.value(c).alias("v"))))
    held = _with_groups(rows, state, keys, few).select(*keys, F.explode(F.array_compact(F.array(*picks))).alias("e")).select(*keys, "e.*")
    values = held.groupBy(*keys, "t", "lo", "hi", "v").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(*keys, "t").orderBy("v")) - F.col("n")      # a bracket's distinct values
    at = lambda r: F.max(F.when((F.col("before") <= F.col(r)) & (F.col(r) < F.col("before") + F.col("n")), F.col("v")))
    found = values.withColumn("before", before).groupBy(*keys, "t").agg(at("lo").alias("a"), at("hi").alias("b"))
    wide = found.groupBy(*keys).agg(*[F.max(F.when(F.col("t") == i, F.col(x))).alias(f"_{x}{i}") for i in range(len(t.all)) for x in ("a", "b")])
    if keys:
        other = wide.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in wide.columns if c not in keys])
        out = state.join(other, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "left")
    else:
        out = state.crossJoin(F.broadcast(wide))
    result = [F.col(k) for k in keys]
    for c, column in enumerate(t.columns):
        result.append(F.col(f"_n{c}").alias(f"{column}_n"))
        for p, name in enumerate(names):
            i = t.all.index((c, p))
            a, b, h = F.col(f"_a{i}"), F.col(f"_b{i}"), (F.col(f"_n{c}") - 1) * F.lit(t.probs[p])
            part = h - F.floor(h)
            # NumPy's lerp: from the upper end when the fraction is 0.5 or more
            result.append(F.when(a == b, a).when(part >= 0.5, b - (b - a) * (F.lit(1.0) - part)).otherwise(a + (b - a) * part).alias(f"{column}_{name}"))
    return out.select(*result)
