"""Base statistics and the robust estimate against plain versions."""

import collections
import re

import numpy as np
import pytest

import __spark_entry__ as entry
from conftest import SF01
from loadlens.llm import outliers as o


def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    triples = list(zip(words, words[1:], words[2:]))
    count, covered = collections.Counter(triples), set()
    for i, t in enumerate(triples):
        if count[t] > 1:
            covered |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
TEXTS = [None, "", " \n\t", "a", "a b c", "a b c a b c", "a a a", "a a a a", "a a a a a", "x y z x y z y z x y", "#a *b\n#a *b\n\n \n#a *b", "é\x0bü\x0c$\r\nq",
         "a b c d " * 500, "w " + " ".join(map(str, range(3000))) + " w 5 6 7 8 9", " wide space", "<|> & %%"]


def test_base(spark, documents, edge_rows):
    texts = TEXTS + [r[1] for r in edge_rows] + [r[1] for r in documents]
    df = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string")
    got = {r["doc_id"]: tuple(r[c] for c in BASE) for r in o.with_base(df).collect()}
    assert got == {i: plain_base(t) for i, t in enumerate(texts)}


def plain_mcd(x, share=o.SUBSET, steps=60):
    floor = np.diag(np.array(o.FLOOR) ** 2)
    best = None
    med = np.median(x, 0)
    mad = 1.4826 * np.median(np.abs(x - med), 0)
    for centre, cov in ((med, np.diag(mad ** 2) + floor), (x.mean(0), np.cov(x.T, bias=True) * o._CONSISTENT + floor)):
        for _ in range(steps):
            d2 = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
            near = x[np.argsort(d2, kind="stable")[:int(np.ceil(share * len(x)))]]
            centre, cov = near.mean(0), np.cov(near.T, bias=True) * o._CONSISTENT + floor
        det = np.linalg.slogdet(cov)[1]
        if best is None or det < best[0]:
            best = (det, centre, cov)
    return best


def test_estimate_is_near_plain_mcd(spark):
    rng = np.random.default_rng(4)
    groups = {"hot": 3000, "cold": 400}
    rows, data = [], {}
    for g, n in groups.items():
        x = rng.normal(0, 1, (n, 5)) @ np.diag([1, .5, .3, .2, .4]) + [5, 2, 0, 0, 1]
        x[: n // 8] += [4, -3, 2, 2, -2]
        data[g] = x
        rows += [(g, *map(float, r)) for r in x]
    got = o.minimum_covariance(spark.createDataFrame(rows, ["grp", *o.FEATURES]).repartition(5)).collect()
    for r in got:
        det, centre, _ = plain_mcd(data[r["grp"]])
        assert np.allclose([r[f"m_{i}"] for i in range(5)], centre, atol=0.05)
        assert abs(r["logdet"] - det) < 0.1


def test_good_documents_stay(spark):
    name = next(q for q in entry.queries() if q.startswith("op1_"))
    rows = entry.queries()[name](spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").where("not base_failed").collect()
    good, junk = [r["kept"] for r in rows if r["quality"] == 1], [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) >= 0.99 and np.mean(junk) <= 0.1


def test_edges(edge_docs, edge_rows, no_docs, spark):
    got = o.judge(edge_docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], tuple(r[c] for c in BASE)) for r in got if r["doc_id"] is not None) == \
        sorted((False, i, plain_base(t)) for i, t, *_ in edge_rows if i is not None)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"]) and (r["kept"] is False or not r["base_failed"])
    assert o.judge(no_docs).collect() == []


@pytest.mark.parametrize("n", [1, 30])
def test_small_groups_and_equal_rows(spark, n):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(i, text, None if i % 2 else "en", f"s{i % 3}") for i in range(n)]
    got = o.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()
    assert len(got) == n and all(r["kept"] for r in got)
