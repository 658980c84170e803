"""Classes of repeated paragraphs against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from loadlens.llm import paragraph_dedup
from loadlens.llm.common import STEP_ROWS
from loadlens.llm.paragraph_dedup import (SHORT_BANDS, SHORT_ROWS, SIMILARITY, UNIT_WORDS, Signatures, distinct_keys, jaccard, line_bands, maybe_in, paragraph_links, paragraphs,
                                          repeated_paragraphs, shingles, units)
from pyspark.sql import functions as F


def plain_classes(rows, min_words):
    """(row, paragraph) -> class members, for classes over two rows or more."""
    items = [(i, p[0], shingles(p[3])) for i, r in enumerate(rows) for p in paragraphs(r[1], min_words)]
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(items)):
        for b in range(a):
            if jaccard(items[a][2], items[b][2]) >= SIMILARITY:
                root[find(a)] = find(b)
    classes = {}
    for a, (row, number, _) in enumerate(items):
        classes.setdefault(find(a), set()).add((row, number))
    return {frozenset(c) for c in classes.values() if len({r for r, _ in c}) > 1}


def corpus(seed=1, groups=6, copies=12):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for g in range(groups):
        base = [rng.choice(words) for _ in range(60)]
        for c in range(copies):
            text = list(base)
            for _ in range(rng.randrange(0, 5)):
                text[rng.randrange(60)] = rng.choice(words)
            other = " ".join(rng.choice(words) for _ in range(45))
            half = " ".join(base[:30] + [rng.choice(words) for _ in range(40)])
            rows.append((len(rows), "\n".join([other, " ".join(text), half if c % 3 == 0 else "short line", ""])))
    return rows


def got_classes(df, rows):
    classes = {}
    for r in df.where("class_id like 'c%'").collect():
        classes.setdefault(r["class_id"], []).append(r)
    for c in classes.values():
        assert sum(not r["removed"] for r in c) == 1 and len(c) == c[0]["copies"]
        assert min((r["doc_id"], r["paragraph"]) for r in c) == next((r["doc_id"], r["paragraph"]) for r in c if not r["removed"])
        for r in c:
            text = rows[r["doc_id"]][1]
            assert text[r["start"]:r["end"]] == text.split("\n")[r["paragraph"]]
    return {frozenset((r["doc_id"], r["paragraph"]) for r in c) for c in classes.values()}


def test_classes_are_whole(spark):
    rows = corpus()
    rows += [(len(rows) + i, rows[1][1]) for i in range(30)]  # a large group of exact copies
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert got_classes(repeated_paragraphs(df, 40), rows) == plain_classes(rows, 40)


def test_mixed_buckets_lose_no_link(spark):
    """All paragraphs in one bucket: representatives alone would miss links."""
    rows = corpus(2, groups=4, copies=8)
    items = [(i, b" ".join(p[3]).decode()) for i, r in enumerate(rows) for p in paragraphs(r[1], 40) if p[0] == 1]
    bodies = spark.createDataFrame(items, "id bigint, body string")
    distinct = bodies.select("id", F.array(F.lit(1).cast("bigint")).alias("bands"), F.lit(1).cast("bigint").alias("copies"))
    mine = {}
    for r in paragraph_links(distinct, lambda ids: bodies.join(ids, "id", "left_semi")).collect():
        mine.setdefault(r["root"], set()).add(r["node"])
    keys = [k for k, _ in items]
    sh = [shingles(b.encode().split()) for _, b in items]
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(keys)):
        for b in range(a):
            if jaccard(sh[a], sh[b]) >= SIMILARITY:
                root[find(keys[a])] = find(keys[b])
    want = {}
    for k in keys:
        want.setdefault(find(k), set()).add(k)
    assert sorted(map(sorted, mine.values())) == sorted(sorted(c) for c in want.values() if len(c) > 1)


def test_units_of_a_shared_passage():
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10 ** 6)}".encode()
    for n in (51, 60, 200):
        passage = [word() for _ in range(n)]
        lines = [[word() for _ in range(rng.randrange(0, 90))] + passage + [word() for _ in range(rng.randrange(0, 90))] for _ in range(6)]
        line, first, key = units(lines)
        per = [set(key[line == i].tolist()) for i in range(6)]
        assert set.intersection(*per)
        for i, f, k in zip(line.tolist(), first.tolist(), key.tolist()):
            assert len(lines[i][f:f + UNIT_WORDS]) == UNIT_WORDS
    assert len(units([[word()] * 50, []])[0]) == 0 and len(set(units([[b"a"] * 500])[2].tolist())) == 1


def test_units_do_not_depend_on_the_lines_beside():
    rng = random.Random(7)
    lines = [[f"w{rng.randrange(10 ** 6)}".encode() for _ in range(n)] for n in (51, 80, 20, 300, 52)]
    line, first, key = units(lines)
    for i, words in enumerate(lines):
        _, alone, own = units([words])
        assert first[line == i].tolist() == alone.tolist() and key[line == i].tolist() == own.tolist()


@pytest.mark.parametrize("size", [5, 9, 35, 36, 40, 60, 400])
def test_bands_of_near_lines_meet(size):
    """Lines whose shingles agree to 0.8 or more share a band, also across the border of short and long ones."""
    rng = random.Random(size)
    sign, short = Signatures(), Signatures(SHORT_BANDS, SHORT_ROWS, 6)
    lines = []
    for _ in range(100):
        words = [f"w{rng.randrange(10 ** 6)}".encode() for _ in range(size)]
        lines += [words, words[:size - max(0, (size - 4) // 6)], words]
    keys, ends = line_bands(lines, sign, short)
    per = [set(keys[a:z].tolist()) for a, z in zip(ends, ends[1:])]
    pairs = [(i, i + 1) for i in range(0, 300, 3) if jaccard(shingles(lines[i]), shingles(lines[i + 1])) >= SIMILARITY]
    assert len(pairs) == 100 and sum(bool(per[i] & per[j]) for i, j in pairs) >= 99
    assert all(per[i] == per[i + 2] for i in range(0, 300, 3)) and not per[0] & per[3]


def test_bit_table_loses_no_key(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").cast("binary").alias("key"), "id")
    few = rows.where("id % 50 = 0")
    got = [r["id"] for r in maybe_in(rows, few, "key").collect()]
    assert set(got) >= set(range(0, 5000, 50)) and len(got) < 120 and maybe_in(rows, few.limit(0), "key").collect() == []


def test_passages_inside_other_paragraphs(spark):
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(10 ** 6)}"
    some = lambda n: [word() for _ in range(n)]
    passage, common = some(55), some(18)
    rows = [(i, " ".join(some(rng.randrange(5, 80)) + passage + some(rng.randrange(30, 200)))) for i in range(8)]
    rows += [(20 + i, "\n".join([" ".join(common), " ".join(some(120)), " ".join(common)])) for i in range(8)]     # clean
    rows += [(40, " ".join(passage)), (41, " ".join(some(60) + common + some(60))), (42, " ".join(some(60) + common + some(60)))]
    got = repeated_paragraphs(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert {r["doc_id"] for r in got} == {*range(8), 40}
    assert sum(not r["removed"] for r in got) == 1 and len({r["class_id"] for r in got}) == 1
    for r in got:
        words = dict(rows)[r["doc_id"]].split("\n")[r["paragraph"]].split()
        assert set(words[r["first_word"]:r["first_word"] + r["n_words"]]) <= set(passage)


@pytest.mark.parametrize("min_words", [1, 40])
def test_edges(edge_docs, no_docs, min_words):
    got = repeated_paragraphs(edge_docs, min_words).collect()
    assert repeated_paragraphs(no_docs, min_words).collect() == []
    if min_words == 1:
        by = {}
        for r in got:
            by.setdefault(r["class_id"], []).append((r["doc_id"], r["paragraph"]))
        assert sorted(map(len, by.values())) == [2, 5]  # 'one two three' twice; 'a b c d e f' in five rows
    else:
        assert got == []


def words_of(rng, n):
    return [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]


def test_short_lines_and_broken_passages(spark):
    rng = random.Random(8)
    near, passage = words_of(rng, 30), words_of(rng, 80)
    rows = [(1, "\n".join([" ".join(near), "Same Heading", " ".join(words_of(rng, 30))])), (2, "\n".join([" ".join(near[:29] + ["other"]), "same  heading"])),
            (3, " ".join(words_of(rng, 40) + passage + words_of(rng, 40)))]
    wrapped = words_of(rng, 7) + passage + words_of(rng, 9)
    rows.append((4, "\n".join(" ".join(wrapped[i:i + 12]) for i in range(0, len(wrapped), 12))))
    got = repeated_paragraphs(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), 1).collect()
    whole = {}
    for r in got:
        if r["class_id"].startswith("c"):
            whole.setdefault(r["class_id"], set()).add((r["doc_id"], r["paragraph"], r["removed"]))
    assert sorted(map(sorted, whole.values())) == [[(1, 0, False), (2, 0, True)], [(1, 1, False), (2, 1, True)]]
    runs = [r for r in got if r["class_id"].startswith("p")]
    assert {r["doc_id"] for r in runs if r["removed"]} == {4} and len({r["class_id"] for r in runs}) == 1 and {r["copies"] for r in runs} == {2}
    gone = []
    for r in sorted((r for r in runs if r["removed"]), key=lambda r: r["paragraph"]):
        line = dict(rows)[4].split("\n")[r["paragraph"]]
        assert dict(rows)[4][r["start"]:r["end"]] == line and r["first_doc"] == 3
        gone += line.split()[r["first_word"]:r["first_word"] + r["n_words"]]
    assert " ".join(gone) in " ".join(passage) and len(gone) >= 51


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_every_passage_keeps_one_copy(spark, seed):
    """Staggered excerpts, and a first place inside a paragraph that goes as a near copy."""
    rng = random.Random(seed)
    source, near = words_of(rng, 200), words_of(rng, 120)
    alone = lambda: words_of(rng, rng.randrange(20, 60))
    cut = lambda a, b: " ".join(alone() + source[a:b] + alone())
    rows = [(0, cut(0, 100)), (1, cut(0, 200)), (2, cut(40, 200)), (3, " ".join(near[:70] + near[72:])), (4, " ".join(near)),
            (5, " ".join(alone() + near[44:100] + alone())), (6, " ".join(alone() + near[44:100] + alone()))]
    for i in range(7, 12):
        a = rng.randrange(0, 140)
        rows.append((i, cut(a, a + 60)))
    got = repeated_paragraphs(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    kept = {i: t.split() for i, t in rows}
    for r in got:
        if r["removed"]:
            for k in range(r["first_word"], r["first_word"] + r["n_words"]):
                kept[r["doc_id"]][k] = "-"
    left = {" ".join(w[k:k + UNIT_WORDS]) for w in kept.values() for k in range(len(w) - UNIT_WORDS + 1)}
    line, first, key = (x.tolist() for x in units([t.encode().split() for _, t in rows]))
    held = {}
    for i, k in zip(line, key):
        held.setdefault(k, set()).add(i)
    repeated = [(i, f) for i, f, k in zip(line, first, key) if len(held[k]) > 1]
    assert len(repeated) > 50
    for i, f in repeated:
        assert " ".join(rows[i][1].split()[f:f + UNIT_WORDS]) in left
    runs = [r for r in got if r["class_id"].startswith("p") and r["doc_id"] in (0, 1, 2, *range(7, 12))]
    assert len({r["class_id"] for r in runs}) == 1 and {r["copies"] for r in runs} == {8}
    assert any(r["removed"] for r in runs if r["doc_id"] == 1) and any(not r["removed"] for r in runs if r["doc_id"] == 1)
    assert all(r["removed"] for r in runs if r["doc_id"] == 2)


def test_keys_of_all_lines_are_not_sorted(spark):
    rows = [(bytes([k]), i) for i, k in enumerate((1, 2, 1, 3, 1, 2))]
    got = distinct_keys(spark.createDataFrame(rows, "key binary, row bigint"))
    assert sorted((bytes(r["key"]), r["copies"], r["row0"], r["row1"]) for r in got.collect()) == [(b"\x01", 3, 0, 4), (b"\x02", 2, 1, 5), (b"\x03", 1, 3, 3)]
    plan = got._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_workers_hold_few_documents():
    """A batch of many documents is handled a few at a time, with the same stretches."""
    n = 5 * STEP_ROWS // 2
    lines = [{"paragraph": 0, "start": 0, "end": 300, "at": 0, "n": 60}]
    docs = [{"row": i, "doc_id": i, "hits": [{"key": i, "first_word": 3}, {"key": 7, "first_word": 9}], "lines": lines, "whole": []} for i in range(n)]
    hit = pa.list_(pa.struct([("key", pa.int64()), ("first_word", pa.int32())]))
    whole = pa.list_(pa.struct([("paragraph", pa.int32()), ("removed", pa.bool_())]))
    batch = pa.RecordBatch.from_pylist(docs, pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("hits", hit), ("lines", paragraph_dedup._LINES), ("whole", whole)]))
    out = list(paragraph_dedup._stretches(iter([batch])))
    assert [b.num_rows for b in out] == [STEP_ROWS, STEP_ROWS, n - 2 * STEP_ROWS]
    rows = [r for b in out for r in b.to_pylist()]
    assert [(r["row"], r["start"], r["end"], len(r["hits"]), r["lines"]) for r in rows] == [(i, 3, 9 + UNIT_WORDS, 2, lines) for i in range(n)]


def test_python_passes_get_small_batches(spark, monkeypatch):
    """Every pass runs with bounded Arrow batches, and the settings come back."""
    names = [f"spark.sql.execution.arrow.max{x}PerBatch" for x in ("Records", "Bytes")]
    before, seen = [spark.conf.get(x) for x in names], []

    def noted(f):
        return lambda *a: (seen.append(int(spark.conf.get(names[0]))), f(*a))[1]
    for name in ("written", "checkpointed"):
        monkeypatch.setattr(paragraph_dedup, name, noted(getattr(paragraph_dedup, name)))
    got = repeated_paragraphs(spark.createDataFrame([(i, f"{i} " + " ".join(f"w{j}" for j in range(70))) for i in range(4)], "doc_id bigint, text string"), 1)
    assert "MapInArrow" not in got._jdf.queryExecution().executedPlan().toString() and got.count() == 4
    assert set(seen) == {paragraph_dedup.BATCH_ROWS} and [spark.conf.get(x) for x in names] == before


def test_least_of_each_window():
    """Every window's least place, the first of equal ones, as by a look at all its values."""
    rng = random.Random(11)
    for size in (1, 2, 5, UNIT_WORDS):
        values = [rng.randrange(40) for _ in range(300)]
        got = paragraph_dedup.least_places(np.array(values, np.uint64), size).tolist()
        assert got == [min(range(i, i + size), key=lambda k: (values[k], k)) for i in range(300 - size + 1)] == sorted(got)


def test_only_asked_words_are_hashed(monkeypatch):
    words = [f"w{i}".encode() for i in range(5000)]
    seen, hashed = [], paragraph_dedup.word_hashes
    want = paragraph_dedup.unit_hashes(hashed(words), UNIT_WORDS).view(np.int64)
    monkeypatch.setattr(paragraph_dedup, "word_hashes", lambda w: (seen.append(len(w)), hashed(w))[1])
    lines = [{"paragraph": p, "start": 0, "end": 0, "at": 2500 * p, "n": 2500} for p in (0, 1)]
    doc = {"row": 3, "doc_id": None, "words": b" ".join(words), "lines": lines, "places": [7, 20, 2490, 3000, 4990], "whole": [{"paragraph": 1, "removed": True}]}
    types = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("words", pa.binary()), ("lines", paragraph_dedup._LINES), ("places", pa.list_(pa.int32())),
                       ("whole", pa.list_(pa.struct([("paragraph", pa.int32()), ("removed", pa.bool_())])))])
    got = [r for b in paragraph_dedup._look(iter([pa.RecordBatch.from_pylist([doc], types)])) for r in b.to_pylist()]
    assert got == [{"key": int(want[x]), "doc_id": None, "row": 3, "first_word": x} for x in (7, 20)] and sum(seen) == 13 + UNIT_WORDS


_FIRST = pa.struct([("no_id", pa.bool_()), ("doc_id", pa.int64()), ("row", pa.int64()), ("first_word", pa.int32())])


def unit(first_word, first, earlier=False, mine=False, key=1):
    return {"key": key, "first_word": first_word, "first": first and dict(zip(("no_id", "doc_id", "row", "first_word"), first)), "earlier": earlier, "mine": mine}


_UNITS = pa.list_(pa.struct([("key", pa.int64()), ("first_word", pa.int32()), ("first", _FIRST), ("earlier", pa.bool_()), ("mine", pa.bool_())]))


def test_places_beside_are_asked_once():
    row = 1 << 55 | 1   # not a number that a float holds
    units_ = [unit(40, (False, 1, row, 140), earlier=True), unit(50, (False, 9, 8, 50), mine=True, key=5), unit(60, (False, 1, row, 160), earlier=True),
              unit(76, (False, 1, row, 500), earlier=True), unit(55, None, key=6), unit(30, (False, 1, row, 5), earlier=True), unit(25, (False, 1, 2, 0), earlier=True)]
    batch = pa.RecordBatch.from_pylist([{"id": 0, "units": units_}, {"id": 1, "units": [unit(50, (False, 2, 3, 0), earlier=True)]}, {"id": 2, "units": []}],
                                       pa.schema([("id", pa.int64()), ("units", _UNITS)]))
    got = [tuple(r.values()) for b in paragraph_dedup._beside(iter([batch])) for r in b.to_pylist()]
    assert sorted(got) == [(5, 2, 25), (5, row, 25), (5, row, 150)]


def test_runs_of_several_stretches():
    lines = [{"paragraph": 2, "start": 5, "end": 90, "at": 90, "n": 40}, {"paragraph": 4, "start": 95, "end": 300, "at": 140, "n": 60}]
    stretches = [
        {"doc_id": None, "start": 100, "end": 170, "root": 7, "copies": 3, "lines": lines,
         "units": [unit(110, (True, None, 1, 0), earlier=True), unit(105, (False, 4, 2, 0), earlier=True), unit(90, (True, None, 5, 90), mine=True), unit(150, None)]},
        {"doc_id": 6, "start": 0, "end": 26, "root": 8, "copies": 2, "lines": [dict(lines[0], at=0, n=30)], "units": [unit(0, (True, None, 1, 0), earlier=True)]}]
    types = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("root", pa.int64()), ("copies", pa.int64()), ("lines", paragraph_dedup._LINES),
                       ("units", _UNITS)])
    got = [tuple(r.values()) for b in paragraph_dedup._runs(iter([pa.RecordBatch.from_pylist(stretches, types)])) for r in b.to_pylist()]
    assert got == [(None, 2, 5, 90, 10, 16, "p7", 3, None, False), (None, 2, 5, 90, 26, 14, "p7", 3, 4, True), (None, 4, 95, 300, 0, 30, "p7", 3, None, False),
                   (6, 2, 5, 90, 0, 26, "p8", 2, None, True)]
