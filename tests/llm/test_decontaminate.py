"""Window search against a plain scan, and the query against its SQL."""

import hashlib

import __spark_entry__ as entry
import pytest
from conftest import SF001
from loadlens.llm.decontaminate import contamination_report, drop_contaminated, words_of
from oracle_compare import compare, duck


def brute(docs, items, window=13):
    wins = {}
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[i:i + window]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text, *_ in docs:
        w, hit, found = words_of(text), set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in wins:
                    hit |= set(range(i, i + n))
                    found |= wins[tuple(w[i:i + n])]
        ids = ",".join(sorted(found))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), 0 < len(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


PASSAGE = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, PASSAGE), (1, PASSAGE), (2, "short item here"), (3, None), (4, ""), (None, "zz " * 14), (10, "W3 w4! w5, w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 tail")]
COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


@pytest.mark.parametrize("block_chars", [10 ** 6, 60])
def test_edges(spark, edge_rows, edge_docs, block_chars):
    more = [(100, PASSAGE, "en", "s"), (101, "x " * 500 + PASSAGE, "en", "s"), (102, PASSAGE[10:], "en", "s"), (103, "a Short ITEM here b", "en", "s"),
            (104, "zz " * 40, "en", "s"), (105, "w0 w1 w2", "en", "s"), (106, PASSAGE.upper() + " " + PASSAGE, "en", "s")]
    extra = [r + ("s", "f", "g", "u", "n", "t") for r in more]
    docs = edge_docs.unionAll(spark.createDataFrame(extra, edge_docs.schema))
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = contamination_report(docs, bench, block_chars=block_chars).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute(edge_rows + more, ITEMS)
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not r[-1] for r in brute(edge_rows + more, ITEMS))


def test_empty_tables(edge_docs, no_docs, spark):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert contamination_report(no_docs, bench).collect() == []
    assert {r["n_hit"] for r in contamination_report(edge_docs, bench.limit(0)).collect()} == {0}


def test_query_matches_sql(spark):
    name = next(q for q in entry.queries() if q.startswith("op5_"))
    ok, msg, _ = compare(spark, duck(SF001), name, entry.queries()[name], entry.oracle_sql()[name], SF001)
    assert ok, msg
