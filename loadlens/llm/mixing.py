"""Mixing sources to target weights by hierarchical budgeting, natively.

Documents hang below a tree domain -> language -> source.  A token budget runs
down it: each node deals its budget to its children by weight, and a child
that holds less than its share (``epochs`` passes over its tokens at most) gives
the rest to its siblings.  A node's own supply is the sum of its leaves', so a
shortage goes up to an ancestor only when a whole subtree runs dry.

A leaf's budget is spent on its documents in a seeded order, a new one for each
epoch: whole epochs first, then the prefix of the last one.  The prefix is
found without sorting a leaf in one task: documents fall into buckets of the
order key (more buckets for larger leaves), bucket sums are accumulated, and
only the bucket that the budget ends in is ranked.

All sums are whole numbers, so results do not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.llm.common import checkpointed, fresh, join_small, without, written

LEVELS = ("domain", "lang", "source")
NULL = "(null)"
BUCKET_ROWS = 2_000     # documents of a leaf for each bucket of the order
MAX_EPOCHS = 2
SEED = 7
DOMAINS = 4             # domains that sources are dealt to where no table names them
DEFAULT_WEIGHT = 100


def n_tokens(text: str | Column = "text") -> Column:
    """Words of the whole text (runs without white space); 0 for null."""
    t = F.trim(F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "[ \\t-\\r]+", " "))
    return F.when(t == "", F.lit(0)).otherwise(F.length(t) - F.length(F.translate(t, " ", "")) + 1).cast("bigint")


def domain_of(source: str = "source", domains: int = DOMAINS) -> Column:
    """Domain of a source by its number (``src17`` -> 17 mod ``domains``);
    sources without a number are in domain 0."""
    number = F.coalesce(F.expr(f"try_cast(regexp_extract(`{source}`, '([0-9]{{1,9}})$', 1) as bigint)"), F.lit(0))
    return F.concat(F.lit("domain"), F.pmod(number, F.lit(domains)).cast("string"))


def _weight(weights: Mapping[str, int], column: str) -> Column:
    out = F.lit(DEFAULT_WEIGHT)
    for name, w in weights.items():
        out = F.when(F.col(column) == name, F.lit(int(w))).otherwise(out)
    return out.cast("decimal(38,0)")


def deal(children: DataFrame, parent: Sequence[str]) -> DataFrame:
    """``children`` (parent columns, ``weight``, ``cap``, the parent's ``budget``,
    an ordered ``name``) with ``got``: the budget by weight, none above its cap,
    what a full child leaves dealt to the others.

    Children are taken from the least ``cap / weight``; one is full if the rest
    of the budget by its share of the rest of the weights exceeds its cap.
    Where the budget exceeds all caps each child gets its cap.  Shares are
    rounded down; the tokens lost by rounding (fewer than the children) go, one
    each, to the first children that have room.  A weight of 0 gets nothing."""
    keys = [F.col(c) for c in parent]
    by = Window.partitionBy(*keys).orderBy(F.col("ratio"), F.col("name"))
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    zero = F.lit(0).cast("decimal(38,0)")
    live = F.col("weight") > 0
    c = children.withColumn("cap", F.when(live, F.col("cap")).otherwise(zero))\
        .withColumn("ratio", F.when(live, F.expr("try_divide(cap * 1000000, weight)").cast("decimal(38,0)")).otherwise(zero))
    c = c.withColumn("used", F.coalesce(F.sum("cap").over(before).cast("decimal(38,0)"), zero))\
        .withColumn("left_w", F.sum("weight").over(whole).cast("decimal(38,0)") - F.coalesce(F.sum("weight").over(before).cast("decimal(38,0)"), zero))
    rest = F.greatest(F.col("budget") - F.col("used"), zero)
    c = c.withColumn("full", ~live | (F.col("cap").cast("decimal(38,0)") * F.col("left_w") <= rest * F.col("weight")))
    # after the last full child, the others share what is left by weight
    n_full = F.sum(F.when(F.col("full"), 1).otherwise(0)).over(whole)
    c = c.withColumn("n_full", n_full)\
        .withColumn("left", F.greatest(F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(zero)).over(whole), zero))\
        .withColumn("open_w", F.sum(F.when(F.col("full"), zero).otherwise(F.col("weight"))).over(whole))
    c = c.withColumn("got", F.when(F.col("full"), F.col("cap")).otherwise(F.expr("floor(try_divide(left * weight, open_w))")).cast("bigint"))
    c = c.withColumn("loss", F.least(F.col("budget"), F.sum("cap").over(whole)).cast("bigint") - F.sum("got").over(whole))\
        .withColumn("room", F.when(F.col("got") < F.col("cap"), 1).otherwise(0))
    turn = F.sum("room").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return c.withColumn("got", F.col("got") + F.when((F.col("room") == 1) & (turn <= F.col("loss")), 1).otherwise(0))\
        .drop("ratio", "used", "left_w", "full", "n_full", "left", "open_w", "loss", "room")


def leaf_budgets(supply: DataFrame, budget: Column, weights: Mapping[str, Mapping[str, int]] | None = None,
                 epochs: int = MAX_EPOCHS) -> DataFrame:
    """``supply(domain, lang, source, tokens)``, one row for each leaf, -> the
    same with ``budget``.  ``budget``: a column over ``total``, all tokens."""
    weights = weights or {}
    weighed = F.lit(True)   # leaves below a weight of 0 take nothing, so they give their ancestors no room
    for level in LEVELS:
        weighed = weighed & (_weight(weights.get(level, {}), level) > 0)
    cap = supply.withColumn("cap", F.when(weighed, F.col("tokens") * epochs).otherwise(0).cast("decimal(38,0)"))
    root = supply.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total")).select(F.lit(0).alias("root"), budget.cast("decimal(38,0)").alias("budget"))
    given, at = root, ["root"]
    cap = cap.withColumn("root", F.lit(0))
    for level in LEVELS:
        nodes = cap.groupBy(*at, level).agg(F.sum("cap").cast("decimal(38,0)").alias("cap"))
        nodes = nodes.join(given, at).withColumn("name", F.col(level)).withColumn("weight", _weight(weights.get(level, {}), level))
        at = at + [level]
        given = deal(nodes, at[:-1]).select(*at, F.col("got").cast("decimal(38,0)").alias("budget"))
    return supply.join(given.drop("root"), list(LEVELS)).withColumn("budget", F.col("budget").cast("bigint"))


def order_key(seed: int, epoch: Column, doc_id: str) -> Column:
    """Seeded order of an epoch: 60 bits of md5(seed:epoch:doc_id)."""
    text = F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def select_mix(docs: DataFrame, budget: Column, weights: Mapping[str, Mapping[str, int]] | None = None,
               epochs: int = MAX_EPOCHS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows ``(no, doc_id, domain, lang, source, n_tokens, epoch)`` selected from
    ``docs(no, doc_id, domain, lang, source, n_tokens)``; ``no`` tells repeated
    rows apart.  A document is taken if its leaf's budget is not spent when its
    turn comes, so a leaf exceeds its budget by less than one document.

    Null levels are a value of their own, ``(null)``.  Documents without tokens
    are never selected.  Ties in the order go by ``no``."""
    d = docs.where(F.col("n_tokens") > 0).select(
        "no", "doc_id", *[F.coalesce(F.col(c).cast("string"), F.lit(NULL)).alias(c) for c in LEVELS], "n_tokens")
    leaf = list(LEVELS)
    supply = checkpointed(d.groupBy(*leaf).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")))
    plan = leaf_budgets(supply, budget, weights, epochs)
    plan = plan.withColumn("whole", F.expr("budget div tokens")).withColumn("part", F.col("budget") % F.col("tokens"))\
        .withColumn("buckets", F.ceil(F.col("docs") / F.lit(bucket_rows)))
    plan = checkpointed(plan.select(*leaf, "whole", "part", "buckets"))
    e = join_small(d, plan, leaf)
    full = e.where("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("whole").cast("int"))))
    last = e.where("part > 0").withColumn("epoch", (F.col("whole") + 1).cast("int"))
    last = last.withColumn("key", order_key(seed, F.col("epoch"), "doc_id"))\
        .withColumn("bucket", F.floor(F.col("key").cast("decimal(38,0)") * F.col("buckets") / F.lit(1 << 60)).cast("bigint"))
    sums = last.groupBy(*leaf, "part", "bucket").agg(F.sum("n_tokens").alias("in_bucket"))
    before = Window.partitionBy(*leaf).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("upto", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)))\
        .where(F.col("upto") < F.col("part")).select(*leaf, "bucket", "upto", "in_bucket")
    last = last.join(sums, leaf + ["bucket"])
    out = ["no", "doc_id", *leaf, "n_tokens", "epoch"]
    inside = last.where(F.col("upto") + F.col("in_bucket") <= F.col("part"))
    edge = last.where(F.col("upto") + F.col("in_bucket") > F.col("part"))
    turn = Window.partitionBy(*leaf, "bucket").orderBy("key", "no").rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.withColumn("spent", F.col("upto") + F.coalesce(F.sum("n_tokens").over(turn), F.lit(0))).where(F.col("spent") < F.col("part"))
    return full.select(*out).unionAll(inside.select(*out)).unionAll(edge.select(*out))


def mix_documents(docs: DataFrame, budget_share: float = 0.6, weights: Mapping[str, Mapping[str, int]] | None = None,
                  epochs: int = MAX_EPOCHS, seed: int = SEED, domains: int = DOMAINS) -> DataFrame:
    """Selected (document, epoch) rows of ``documents`` with a budget of
    ``budget_share`` of all words."""
    d = docs.select("doc_id", domain_of("source", domains).alias("domain"), "lang", "source", n_tokens("text").alias("n_tokens"))
    d = written(d.withColumn("no", F.monotonically_increasing_id()), "mix")
    return select_mix(d, share(budget_share), weights, epochs, seed).drop("no")


def share(part: float) -> Column:
    """A budget of ``part`` (in steps of 1/1000) of all tokens, rounded down."""
    return F.floor(F.col("total").cast("decimal(38,0)") * F.lit(round(part * 1000)) / F.lit(1000))


def keep_mix(docs: DataFrame, budget_share: float, weights: Mapping[str, Mapping[str, int]] | None = None,
             seed: int = SEED, domains: int = DOMAINS) -> DataFrame:
    """``docs`` cut to the mix in at most one epoch: all columns, each row once.
    Equal rows (id and text) stay or go together."""
    no = fresh(docs, "mix_no")
    number = F.xxhash64("doc_id", "text")
    d = written(docs.select(number.alias("no"), "doc_id", domain_of("source", domains).alias("domain"), "lang", "source",
                            n_tokens("text").alias("n_tokens")), "mix")
    chosen = checkpointed(select_mix(d, share(budget_share), weights, 1, seed).select("no").distinct())
    gone = checkpointed(d.select("no").distinct().join(chosen, "no", "left_anti").withColumnRenamed("no", "_no"))
    return without(docs.withColumn(no, number), gone, {no: "_no"}).drop(no)
