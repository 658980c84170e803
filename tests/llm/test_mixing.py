"""Budgets against a plain water-filling, selection against its SQL and by hand."""

import __spark_entry__ as entry
import pytest
from conftest import SF01
from pyspark.sql import functions as F

from loadlens.llm.mixing import deal, keep_mix, leaf_budgets, mix_documents, select_mix, share
from oracle_compare import compare, duck


def plain_deal(children, budget):
    """Give each open child its share; close those that are full; repeat."""
    got, left = {}, min(budget, sum(c for _, w, c in children if w))
    live = [x for x in children if x[1] > 0]
    while live:
        total = sum(w for _, w, _ in live)
        full = [x for x in live if x[2] * total <= left * x[1]]
        if not full:
            for n, w, c in live:
                got[n] = left * w / total
            break
        for n, w, c in full:
            got[n] = c
        left -= sum(c for _, _, c in full)
        live = [x for x in live if x not in full]
    return got


@pytest.mark.parametrize("children, budget", [
    ([("a", 1, 100), ("b", 1, 10), ("c", 2, 1000)], 300), ([("a", 1, 100), ("b", 3, 100)], 1000), ([("a", 5, 7), ("b", 5, 7), ("c", 5, 7)], 20),
    ([("a", 0, 50), ("b", 1, 50)], 80), ([("a", 1, 0), ("b", 1, 10), ("c", 7, 10 ** 12)], 10 ** 11), ([("a", 3, 5)], 0)])
def test_deal(spark, children, budget):
    df = spark.createDataFrame([(0, n, n, w, c, budget) for n, w, c in children], "p int, child string, name string, weight bigint, cap bigint, budget bigint")
    df = df.select("p", "child", "name", *[F.col(c).cast("decimal(38,0)").alias(c) for c in ("weight", "cap", "budget")])
    got = {r["child"]: r["got"] for r in deal(df, ["p"]).collect()}
    want = plain_deal(children, budget)
    caps = {n: c for n, _, c in children}
    assert sum(got.values()) == min(budget, sum(c for n, w, c in children if w))
    for n, g in got.items():
        assert g <= caps[n] and abs(g - want.get(n, 0)) <= 1


@pytest.mark.parametrize("rows", [10 ** 6, 3])
def test_prefix_of_buckets_is_the_prefix_of_the_order(spark, rows):
    docs = spark.range(400).select(F.col("id").alias("no"), F.col("id").alias("doc_id"), F.lit("d").alias("domain"), F.lit("en").alias("lang"),
                                   F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("source"), (F.col("id") % 17 + 1).alias("n_tokens"))
    a = {tuple(r) for r in select_mix(docs, share(0.7), bucket_rows=rows).collect()}
    b = {tuple(r) for r in select_mix(docs.repartition(7), share(0.7)).collect()}
    assert a == b and len(a) > 100
    spent = sum(r[5] for r in a)
    total = sum(i % 17 + 1 for i in range(400))
    assert total * 7 // 10 <= spent < total * 7 // 10 + 2 * 17


def test_edges(edge_docs, no_docs):
    rows = mix_documents(edge_docs, 1.0).collect()
    assert sorted(r["n_tokens"] for r in rows if r["epoch"] == 1)[-1] == 3000
    assert {r["source"] for r in rows} <= {"src1", "(null)"}
    assert mix_documents(no_docs).collect() == [] and keep_mix(no_docs, 0.5).collect() == []
    kept = keep_mix(edge_docs, 1.0)
    assert kept.columns == edge_docs.columns and kept.where("text is null or trim(text) = ''").count() == 0
    assert kept.where("doc_id = 5").count() == 3


def test_query_matches_sql(spark):
    name = next(q for q in entry.queries() if q.startswith("op4_"))
    ok, msg, _ = compare(spark, duck(SF01), name, entry.queries()[name], entry.oracle_sql()[name], SF01)
    assert ok, msg


def test_unequal_weights_on_all_levels(spark):
    """Budgets of leaves against the plain water-filling down the tree; leaves below a weight of 0 leave their share to others."""
    leaves = {("d1", "en", "a"): 1000, ("d1", "en", "b"): 400, ("d1", "de", "a"): 500, ("d2", "en", "a"): 900, ("d2", "fr", "c"): 800, ("d3", "fr", "a"): 300}
    weights = {"domain": {"d1": 300}, "lang": {"fr": 0, "de": 50}, "source": {"a": 70, "b": 0}}

    def plain(prefix, budget):
        if len(prefix) == 3:
            return {prefix: budget}
        level = ("domain", "lang", "source")[len(prefix)]
        room = lambda p: sum(n for leaf, n in leaves.items() if leaf[:len(p)] == p
                             and all(weights[k].get(v, 100) for k, v in zip(weights, leaf)))
        below = sorted({leaf[:len(prefix) + 1] for leaf in leaves if leaf[:len(prefix)] == prefix})
        got = plain_deal([(p, weights[level].get(p[-1], 100), room(p)) for p in below], budget)
        return {k: v for p in below for k, v in plain(p, got.get(p, 0)).items()}
    supply = spark.createDataFrame([(*k, n) for k, n in leaves.items()], "domain string, lang string, source string, tokens bigint")
    for budget in (500, 1500, 2200, 5000):
        got = {(r["domain"], r["lang"], r["source"]): r["budget"] for r in leaf_budgets(supply, F.lit(budget), weights, 1).collect()}
        want = plain((), budget)
        assert sum(got.values()) == min(budget, 1000 + 500 + 900)
        for k, n in got.items():
            assert abs(n - want[k]) <= 3


def test_weighted_query_matches_sql(spark):
    ok, msg, _ = compare(spark, duck(SF01), "mixing_weighted", entry.queries()["mixing_weighted"], entry.oracle_sql()["mixing_weighted"], SF01)
    assert ok, msg
    con = duck(SF01)
    tokens = lambda name: dict(con.sql(f"select domain, sum(n_tokens) from ({entry.oracle_sql()[name]}) group by 1").fetchall())
    equal, weighted = tokens("op4_mixing"), tokens("mixing_weighted")
    assert weighted["domain0"] > 1.2 * equal["domain0"] and weighted["domain2"] < 0.8 * equal["domain2"]      # the weights take effect
