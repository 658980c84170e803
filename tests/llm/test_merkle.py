"""Manifest against a plain tree, states against whole hashes, edges and the SQL twin."""

import hashlib
import zlib

import __spark_entry__ as entry
import pytest
from conftest import SF01

from loadlens.llm import merkle
from loadlens.llm.merkle import Node, merkle_manifest
from oracle_compare import compare, duck

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, tree string, pos string, root string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    raw = [None if v is None else str(v).encode() for v in (*row[:4], text)]
    return hashlib.sha256(b"".join(b"-" if v is None else str(len(v)).encode() + b":" + v for v in raw)).hexdigest()


def plain_levels(digests):
    levels = [list(digests)]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def plain_manifest(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        items = sorted(((r[0], plain_leaf(r, r[4]), r) for r in rows if r[2] == lang), key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
        trees[lang] = items, plain_levels([t[1] for t in items])
    top = plain_levels([trees[x][1][-1][0] for x in langs])
    out = []
    for no, lang in enumerate(langs):
        items, levels = trees[lang]
        for i, (doc_id, leaf, row) in enumerate(items):
            text = row[4]
            if text is not None and zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            digest, siblings = plain_leaf(row, text), []
            for tree, place in ((levels, i), (top, no)):
                for nodes in tree[:-1]:
                    run, slot = nodes[place // 8 * 8:place // 8 * 8 + 8], place % 8
                    siblings += run[:slot] + run[slot + 1:]
                    digest, place = sha(*run[:slot], digest, *run[slot + 1:]), place // 8
            out.append((doc_id, leaf, levels[-1][0], top[-1][0], sha(*siblings), digest, digest == top[-1][0]))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "l", "t", "p", "r") for r in rows], SCHEMA)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_states_fold_like_whole_hashes():
    children = [sha(str(i)) for i in range(8)]
    for n in range(1, 9):
        node = Node(children[:n])
        assert node.digest == sha(*children[:n]) and len(node.states) == n
        for slot in range(n):
            assert node.fold(slot, "x" * 64) == sha(*children[:slot], "x" * 64, *children[slot + 1:n])


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 1], [64, 65, 3], [700], [1] * 11])
def test_manifest_of_many_shapes(spark, monkeypatch, sizes):
    monkeypatch.setattr(merkle, "HEIGHT", 1 if max(sizes) < 500 else 2)     # blocks of 8 or 64: several layers
    rows = [(no * 10_000 + i, f"s{i % 3}", f"l{no:02d}", i, f"Text {i} ÄÖ") for no, n in enumerate(sizes) for i in range(n)]
    assert got(merkle_manifest(frame(spark, rows).repartition(3))) == plain_manifest(rows)


def test_edges(spark):
    texts = [None, "", "   ", "abc", "ABC", "Été Ünï", "word WORD\n" * 2000, "A" * 5_000_000]
    rows = [(i, "src", "en", len(t or ""), t) for i, t in enumerate(texts)]
    rows += [(None, None, None, None, None), (None, "s", None, 1, "Null Id"), (5, "src", "en", 7, "Été Ünï"), (5, "src", "en", 7, "Été Ünï"), (5, "b", "en", 1, "Z"),
             (-3, "", "", 0, ""), (2 ** 62, "x", "zz", -1, "Q")]
    want = plain_manifest(rows)
    result = merkle_manifest(frame(spark, rows))
    assert got(result) == want and {r[-1] for r in want} == {True, False}
    assert result.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    none = merkle_manifest(frame(spark, rows).limit(0))
    assert none.collect() == [] and none.columns == result.columns


def test_hot_language_over_many_ranges(spark):
    rows = [(i * 7919 % 3000, "s", "hot" if i % 3 else f"l{i % 5}", i, f"T{i}") for i in range(3000)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")        # many ranges
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        assert got(merkle_manifest(frame(spark, rows).repartition(9))) == plain_manifest(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_query_matches_sql(spark):
    ok, msg, _ = compare(spark, duck(SF01), "op12_merkle", entry.queries()["op12_merkle"], entry.oracle_sql()["op12_merkle"], SF01)
    assert ok, msg
