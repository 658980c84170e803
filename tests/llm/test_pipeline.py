"""The pipeline's stages against plain versions, each on its own input."""

import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
import __spark_entry__ as entry
from conftest import SF01
from loadlens.llm.common import table, written
from loadlens.llm.quality import quality_scores
from test_decontaminate import brute as plain_contamination
from test_simhash import plain_groups
from test_token_output import brute as plain_tokens, result as token_rows


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF01, "documents"), []
    for name, stage in P.STAGES:
        result = stage(spark, docs, SF01)
        out.append((docs, result))
        docs = written(result, f"test-{name}")
        out[-1] = (out[-1][0], docs)
    return {name: io for (name, _), io in zip(P.STAGES, out)}


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect()]


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_shape(spark, stages):
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "decontaminate", "mix", "token_ids"]
    columns = table(spark, SF01, "documents").columns
    for name, (_, result) in list(stages.items())[:-1]:
        assert result.columns == columns, name
    assert "pipeline" in entry.queries() and P.ORACLE_SQL is None


def test_quality(spark, stages):
    docs, kept = stages["quality"]
    want = quality_scores(docs, table(spark, SF01, "labels")).where("predicted = 1")
    assert ids(kept) == ids(want)
    good = kept.join(table(spark, SF01, "labels"), "doc_id").agg(F.avg("quality")).first()[0]
    assert good >= 0.99


def test_near_duplicates(stages):
    docs, kept = stages["near_duplicates"]
    assert ids(kept) == sorted({c for _, _, c in plain_groups(rows(docs))})


def test_decontaminate(spark, stages):
    docs, kept = stages["decontaminate"]
    items = [tuple(r) for r in table(spark, SF01, "benchmark").select("item_id", "text").collect()]
    assert ids(kept) == sorted(r[0] for r in plain_contamination(rows(docs), items) if not r[-1])


def test_mix(stages):
    """Shares per domain and language within a document of plain water-filling."""
    from test_mixing import plain_deal
    docs, kept = stages["mix"]
    size = lambda r: len((r[1] or "").split())
    domain = lambda r: f"domain{int(r[3][3:]) % 4}"
    all_, got = rows(docs), rows(kept)
    assert set(got) <= set(all_)
    budget = sum(map(size, all_)) * 8 // 10
    cap, spent = {}, {}
    for r in all_:
        cap[domain(r)] = cap.get(domain(r), 0) + size(r)
    for r in got:
        spent[domain(r)] = spent.get(domain(r), 0) + size(r)
    most, leaves = max(map(size, all_)), len({(r[2], r[3]) for r in all_})
    for d, share in plain_deal([(d, 100, c) for d, c in cap.items()], budget).items():
        assert share - leaves <= spent[d] <= share + most * leaves
    assert budget <= sum(spent.values()) + leaves


def test_token_ids(stages):
    docs, result = stages["token_ids"]
    assert token_rows(result) == plain_tokens(rows(docs))


def test_run_is_the_chain(spark, stages):
    assert token_rows(P.run(spark, SF01)) == token_rows(stages["token_ids"][1])


def test_edge_documents(spark, edge_docs, no_docs):
    for _, stage in P.STAGES:
        assert stage(spark, edge_docs, SF01).count() >= 0
        assert stage(spark, no_docs, SF01).count() == 0


def test_nothing_else_needs_this_package():
    import pathlib
    root = pathlib.Path(P.__file__).parent
    for f in [*root.glob("loadlens/**/*.py"), root / "bench.py"]:
        if "llm" not in f.parts:
            assert "llm" not in f.read_text() and "corpus_pipeline" not in f.read_text(), f
    assert "loadlens.llm" in sys.modules
