"""Fingerprints and components against plain all-pairs versions."""

import numpy as np
import pytest
import xxhash

from loadlens.llm.simhash import cell_links, fingerprint, keep_one_per_group, link_components, simhash_groups


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [b" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, radius=4):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    fps = list(fps)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def plain_groups(rows):
    fp = [plain_fingerprint(r[1]) for r in rows]
    root, least = plain_components(set(fp)), {}
    for f, r in zip(fp, rows):
        if r[0] is not None:
            least[root[f]] = min(least.get(root[f], r[0]), r[0])
    return sorted(((r[0], f"{f:016x}", least.get(root[f])) for r, f in zip(rows, fp)), key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_long_text_in_pieces():
    text = "some words of a text " * 400_000
    assert fingerprint(text) == fingerprint(text)
    import loadlens.llm.common as c
    w = text.encode()
    assert [x for p in c.word_chunks(w, 1000) for x in p] == w.split()


def test_whole_table(spark, documents, edge_rows):
    rows = documents + edge_rows
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(3)
    assert got(simhash_groups(df)) == plain_groups(rows)


def test_edges(edge_docs, edge_rows, no_docs):
    assert got(simhash_groups(edge_docs)) == plain_groups(edge_rows)
    assert simhash_groups(no_docs).collect() == [] and keep_one_per_group(no_docs).collect() == []
    kept = keep_one_per_group(edge_docs)
    assert kept.columns == edge_docs.columns
    want = {c for _, _, c in plain_groups(edge_rows)}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def clustered(n, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2 ** 63, 6, dtype=np.uint64)
    fps = {int(c) for c in rng.integers(0, 2 ** 63, n // 3, dtype=np.uint64)}
    while len(fps) < n:
        f = int(centres[rng.integers(6)])
        for b in rng.choice(64, rng.integers(0, 8), replace=False):
            f ^= 1 << int(b)
        fps.add(f)
    return fps


def test_tree_finds_every_link():
    fps = clustered(900)
    u, v = cell_links(np.array(sorted(fps), np.uint64), 4, leaf=16)
    root = {int(a): int(b) for a, b in zip(u, v)}
    mine = {f: root.get(f, f) for f in fps}
    want = plain_components(fps)
    assert len({(mine[f], want[f]) for f in fps}) == len(set(want.values())) == len(set(mine.values()))


@pytest.mark.parametrize("max_cell", [20_000, 40])
def test_split_cells_lose_no_link(spark, max_cell):
    fps = clustered(700)
    signed = [(int(np.uint64(f).view(np.int64)),) for f in fps]
    rows = link_components(spark.createDataFrame(signed, "fp bigint"), 4, max_cell, 16).collect()
    mine = {int(np.int64(r["node"]).view(np.uint64)): r["root"] for r in rows}
    want = plain_components(fps)
    sizes = {}
    for f in want.values():
        sizes[f] = sizes.get(f, 0) + 1
    assert set(mine) == {f for f in fps if sizes[want[f]] > 1}
    assert len({(mine[f], want[f]) for f in mine}) == len({want[f] for f in mine}) == len(set(mine.values()))
