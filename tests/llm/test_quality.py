"""Discriminant against plain numpy, held-out accuracy and edge cases."""

import numpy as np

import __spark_entry__ as entry
from conftest import SF01
from loadlens.llm.quality import Discriminant, class_sums, drop_low_quality, quality_scores, statistics


def test_sums_and_densities(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, (200, 3)), rng.normal(2, [1, 2, 3], (300, 3))])
    y = np.repeat([0, 1], [200, 300])
    df = spark.createDataFrame([(r.tolist(), int(c)) for r, c in zip(x, y)], "x array<double>, y int").repartition(5)
    model = Discriminant(class_sums(df, 3), 0.1)
    centre, scale = x.mean(0), x.std(0)
    z, at = (x - centre) / scale, []
    for c in (0, 1):
        m, cov = z[y == c].mean(0), np.cov(z[y == c].T, bias=True) * 0.9 + 0.1 * np.eye(3)
        d = z - m
        at.append(np.log((y == c).mean()) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(at[0] - at[1])))


def test_held_out_accuracy(spark):
    name = next(q for q in entry.queries() if q.startswith("op9_"))
    rows = entry.queries()[name](spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, 0), (4, 0, 0), (5, None, 0), (None, 1, 0), (6, 1, 0), (9, 0, 0), (10, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = quality_scores(edge_docs, labels).collect()
    assert len(got) == len(edge_rows) and all(0 <= r["score"] <= 1 for r in got)
    assert quality_scores(no_docs, labels).collect() == []
    assert {r["score"] for r in quality_scores(edge_docs, labels.limit(0)).collect()} == {0.5}
    assert drop_low_quality(edge_docs, labels).columns == edge_docs.columns
    assert statistics(None) == statistics("") and all(np.isfinite(statistics("a" * 10 ** 6 + " b\n" * 1000)))
