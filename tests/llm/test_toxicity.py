"""Held-out accuracy, lexicon and edge cases of the toxicity scores."""

import numpy as np

import __spark_entry__ as entry
from conftest import SF01
from loadlens.llm.toxicity import FEATURES, Measure, learn_lexicon, plain, toxicity_scores


def test_plain_words():
    assert plain("Idiot!!") == ("idiot", False)
    assert plain("1d10t") [0] == "idiot" and plain("s.c.u.m") == ("scum", True)
    assert plain("don't")[1] is False and plain("") == ("", False)


def test_lexicon(spark):
    rows = [(f"filler{i} badword{i % 5} other", 1) for i in range(40)] + [(f"filler{i} good other", 0) for i in range(60)]
    lex = learn_lexicon(spark.createDataFrame(rows, "text string, y int").repartition(3))
    assert "badwo*" in lex and "other" not in lex and "fill*" not in lex
    assert "badw*" not in lex   # accounted for by the longer beginning
    m = Measure({"scum": 3.0})
    x = dict(zip(FEATURES, m("you are SCUM, s.c.u.m ok")))
    assert x["density"] == 2 / 5 and x["near_you"] == 1.0 and x["obfuscated_hits"] == 1 / 5
    assert len(m(None)) == len(FEATURES) and m(None) == m("") and np.isfinite(m("! " * 50_000)).all()


def test_held_out_accuracy(spark):
    name = next(q for q in entry.queries() if q.startswith("op2_"))
    rows = entry.queries()[name](spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame([(i, 1, int(i % 2)) for i in range(12)] + [(3, 1, 1), (None, 1, 1), (4, 1, None)], "doc_id bigint, quality int, toxic int")
    got = toxicity_scores(edge_docs, labels).collect()
    assert len(got) == len(edge_rows) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity_scores(no_docs, labels).collect() == []
    assert {r["score"] for r in toxicity_scores(edge_docs, labels.limit(0)).collect()} == {0.5}
    assert {r["score"] for r in toxicity_scores(edge_docs, labels.where("toxic = 0")).collect()} == {0.0}
