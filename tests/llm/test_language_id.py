"""Kneser-Ney probabilities against a plain recursion, accuracy, edge cases."""

import collections

import numpy as np

import __spark_entry__ as entry
from conftest import SF01
from loadlens.llm.language_id import ORDER, Models, SortedTable, _summed, codes_of, count_ngrams, identify, keys_of


def grams(texts):
    out = collections.Counter()
    for t in texts:
        codes, n = codes_of([t])
        out.update(tuple(codes[i:i + ORDER].tolist()) for i in range(len(codes) - ORDER + 1))
    return out


def plain_probability(counts, letters, gram):
    """Interpolated Kneser-Ney of one language by recursion."""
    tables = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        tables[k] = collections.Counter(g[1:] for g in tables[k + 1])

    def p(g):
        if not g:
            return 1 / (letters + 1)
        t = tables[len(g)]
        once, twice = (sum(v == x for v in t.values()) for x in (1, 2))
        cut = min(max(once / (once + 2 * twice) if once else 0.5, 0.1), 0.9)
        follow = [v for h, v in t.items() if h[:-1] == g[:-1]]
        if not follow:
            return p(g[1:])
        return max(t[g] - cut, 0) / sum(follow) * (g in t) + cut * len(follow) / sum(follow) * p(g[1:])
    return p(gram)


def models_of(per):
    return Models({lang: _summed(np.concatenate([keys_of(*codes_of([t])) for t in texts])) for lang, texts in per.items()})


PER = {"aa": ["the cat sat on the mat", "a cat and the hat", "the then"], "bb": ["der hund und die katze", "ein hut", "das ist die"]}


def test_probabilities():
    m = models_of(PER)
    counts = {x: grams(t) for x, t in PER.items()}
    letters = len({g[-1] for c in counts.values() for g in c})
    codes, n = codes_of(["the dog und xyz q"])
    keys = keys_of(codes, n)
    got = np.exp(m.log_probability(keys))
    for i in range(len(keys)):
        g = tuple(codes[i:i + ORDER].tolist())
        for j, lang in enumerate(m.languages):
            assert np.isclose(got[i, j], plain_probability(counts[lang], letters, g), rtol=1e-4)


def test_batches_do_not_mix_texts():
    texts = ["the cat", "", "  ", "der hund 12", "a", "x" * 5000, "das  -- ist"]
    m = models_of(PER)
    together, n = m.cross_entropy(texts)
    for i, t in enumerate(texts):
        alone, k = m.cross_entropy([t])
        assert k[0] == n[i] and np.allclose(alone[0], together[i], atol=1e-5)


def test_table():
    keys = np.unique(np.random.default_rng(0).integers(0, 2 ** 63, 5000, dtype=np.uint64))
    t = SortedTable(keys)
    assert (t.find(keys) == np.arange(len(keys))).all()
    assert (t.find(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)] == -1).all()


def test_counts(spark):
    rows = [(x, t) for x, ts in PER.items() for t in ts]
    got = {(r["lang"], r["k"]): r["n"] for r in count_ngrams(spark.createDataFrame(rows, "lang string, text string").repartition(3)).collect()}
    want = collections.Counter()
    for x, ts in PER.items():
        for g, n in grams(ts).items():
            key = sum(c << 16 * (ORDER - 1 - i) for i, c in enumerate(g))
            want[(x, key)] += n
    assert got == dict(want)


def test_held_out_accuracy(spark):
    name = next(q for q in entry.queries() if q.startswith("op7_"))
    rows = entry.queries()[name](spark, SF01).join(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges(edge_docs, edge_rows, no_docs, spark):
    got = identify(edge_docs).collect()
    assert len(got) == len(edge_rows)
    for r, (i, t, *_) in zip(sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)), sorted(edge_rows, key=lambda r: (r[0] is None, r[0] or 0))):
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in t or "")) and 0 <= r["score"] <= 1
    assert identify(no_docs).collect() == []
    assert {r["lang_pred"] for r in identify(edge_docs.drop("lang").selectExpr("*", "cast(null as string) lang")).collect()} == {"und"}


def test_blocks_lose_no_ngram(spark):
    """Many blocks give the results of one; a language of few rows beside a hot one stays."""
    rng = np.random.default_rng(3)
    word = lambda letters: "".join(rng.choice(list(letters), 5))
    hot = [" ".join(word("abcdefghijklmnopqrst") for _ in range(60)) for _ in range(80)]
    few = [" ".join(word("uvwxyzßøåñ") for _ in range(8)) for _ in range(8)]
    rows = [(i, t, "hot") for i, t in enumerate(hot)] + [(100 + i, t, "few") for i, t in enumerate(few)] + [(200, None, "hot"), (201, "", None), (202, "12", None), (None, "uvwxy abc", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    one, many = ({r["doc_id"]: r for r in identify(docs, **k).collect()} for k in ({}, {"max_ngrams": 2000}))
    assert set(one) == set(many) and {r["lang_pred"] for r in many.values()} == {"hot", "few", "und"}
    for i, r in one.items():
        for c in ("held_out", "lang_pred", "rejected"):
            assert many[i][c] == r[c]
        assert np.isclose(many[i]["score"], r["score"], atol=1e-4) and np.isclose(many[i]["cross_entropy"], r["cross_entropy"], rtol=1e-4)
    assert all(many[i]["lang_pred"] == ("hot" if i < 100 else "few") for i in [*range(80), *range(100, 108)])
