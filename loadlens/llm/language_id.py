"""Language identification with interpolated Kneser-Ney character models.

Texts are reduced to lower-case letters and single spaces.  All 4-grams of all
training texts are counted in Spark; a language's lower orders are continuation
counts, which follow from its distinct 4-grams.  The models are stored as
sorted arrays of 64-bit n-gram keys with one log-probability per language, in
back-off form (n-grams that a language lacks get its back-off value), and are
looked up by arrays, a batch of texts at a time.  More n-grams than a worker
holds are scored in blocks by the two codes before the last one, which the
n-gram, its contexts and its back-offs to two codes share; no n-gram is left out.
The language of least
cross-entropy per character wins; a text that fits its language much worse
than the training texts do is marked as rejected.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import fold, written

FOLDS, HELD_OUT = 4, 2
ORDER = 4
MAX_NGRAMS = 4_000_000     # n-grams of all languages held at a time (48 bytes each at four languages; more languages, fewer n-grams)
UNKNOWN = "und"
REJECT_AT = 6.0            # standard deviations above the training texts' cross-entropy
SCORE_CHARS = 100          # characters whose evidence a score may rest on
_SPACE, _START = 32, 1
_PRIME = 1_000_003
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BYTES = 1 << 22           # text scored at a time


def _letters() -> np.ndarray:
    """Code of each basic-plane character: its lower case if it is a letter or a
    mark on one, else a space."""
    out = np.full(1 << 16, _SPACE, np.uint16)
    for c in range(1 << 16):
        if unicodedata.category(chr(c))[0] in "LM":
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else c
    return out


_TABLE: list[np.ndarray] = []


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts, each after ``ORDER - 1`` start codes, and the numbers of
    codes that each text has to predict.  Characters beyond the basic plane are
    folded to 16 bits."""
    if not _TABLE:
        _TABLE.append(_letters())
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    x = _TABLE[0][np.minimum(raw, 0xFFFF)]
    high = raw > 0xFFFF
    if high.any():
        x[high] = 0xE000 + (raw[high] & 0x1FFF)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), size)
    blank = x == _SPACE
    keep = np.ones(len(x), bool)
    if len(x):
        keep[1:] = ~(blank[1:] & blank[:-1] & (doc[1:] == doc[:-1]))
    x, doc = x[keep], doc[keep]
    n = np.bincount(doc, minlength=len(texts))
    out = np.full(len(x) + (ORDER - 1) * len(texts), _START, np.uint16)
    out[np.arange(len(x)) + (doc.astype(np.int64) + 1) * (ORDER - 1)] = x
    return out, n


def keys_of(codes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The 4-gram key (16 bits a code, the last code lowest) of each predicted code."""
    c = codes.astype(np.uint64)
    key = np.zeros(max(0, len(c) - ORDER + 1), np.uint64)
    for i in range(ORDER):
        key = (key << np.uint64(16)) | c[i:len(c) - ORDER + 1 + i]
    starts = np.cumsum(n + ORDER - 1) - (n + ORDER - 1)
    keep = np.ones(len(key), bool)
    for j in range(ORDER - 1):  # windows that begin in one text and end in the next text's start codes
        at = starts[1:] - 1 - j
        keep[at[(at >= 0) & (at < len(key))]] = False
    return key[keep]


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(keys))) if counts is None else np.add.reduceat(counts, first) if len(keys) else counts
    return keys[first], n


def _pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of a bounded size together (a longer text goes alone)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > _BYTES:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def count_ngrams(rows: DataFrame) -> DataFrame:
    """``rows(lang, text)`` -> ``(lang, k, n)``: counts of all 4-grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for b in batches:
            langs, texts = np.array(b.column(0).to_pylist()), np.array(b.column(1).to_pylist(), object)
            for lang in set(langs.tolist()):
                own = texts[langs == lang].tolist()
                for i, j in _pieces(own):
                    held.setdefault(lang, []).append(_summed(keys_of(*codes_of(own[i:j]))))
                if len(held[lang]) > 8:
                    held[lang] = [_summed(np.concatenate([k for k, _ in held[lang]]), np.concatenate([n for _, n in held[lang]]))]
        for lang, parts in held.items():
            k, n = _summed(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))
            for i in range(0, len(k), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k[i:i + 100_000])), pa.array(k[i:i + 100_000].view(np.int64)),
                                                  pa.array(n[i:i + 100_000])], names=["lang", "k", "n"])
    return rows.mapInArrow(run, "lang string, k bigint, n bigint").groupBy("lang", "k").agg(F.sum("n").alias("n"))


class SortedTable:
    """Sorted mixed keys with a first-level index over their top bits."""

    def __init__(self, keys: np.ndarray):
        mixed = keys * _MIX
        self.order = np.argsort(mixed)
        self.mixed = mixed[self.order]
        self.bits = max(1, int(len(keys)).bit_length() + 1)
        self.start = np.searchsorted(self.mixed >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64)).astype(np.int32)
        self.depth = int(np.diff(self.start).max()) if len(keys) else 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key in the order they were given, -1 where absent."""
        if not self.depth:
            return np.full(len(keys), -1, np.int64)
        mixed = keys * _MIX
        top = (mixed >> np.uint64(64 - self.bits)).astype(np.int64)
        at = self.start[top].astype(np.int64)
        found = np.minimum(at, len(self.mixed) - 1)
        open_ = np.flatnonzero(self.mixed[found] != mixed)
        for step in range(1, self.depth + 1):
            if not len(open_):
                break
            place = at[open_] + step
            ended = place >= self.start[top[open_] + 1]
            found[open_[ended]] = -1
            open_, place = open_[~ended], place[~ended]
            hit = self.mixed[place] == mixed[open_]
            found[open_[hit]] = place[hit]
            open_ = open_[~hit]
        out = np.where(found >= 0, self.order[found], -1)
        return out


def discount(once: int, twice: int) -> float:
    return min(max(once / (once + 2 * twice) if once else 0.5, 0.1), 0.9)


def block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    """Block of n-gram keys of order 3 or 4, by the two codes before the last."""
    return ((keys >> np.uint64(16)) & np.uint64(0xFFFFFFFF)) % np.uint64(_PRIME) % np.uint64(blocks)


class Models:
    """Kneser-Ney models of several languages over the union of their n-grams.

    ``counts``: 4-grams of each language.  Of a block of them only, also
    ``lower[k]`` for the orders below (of order 3 the block's, else all) and
    the discounts ``cuts[k]`` of all n-grams by language."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], lower: dict[int, dict] | None = None, cuts: dict[int, dict] | None = None):
        self.languages = sorted(counts)
        per = [counts[x] for x in self.languages]
        # grams[k][l]: keys and counts of order k; below the top, continuation counts
        grams = {ORDER: [(k, n.astype(float)) for k, n in per]}
        for k in range(ORDER - 1, 0, -1):
            mask = np.uint64((1 << 16 * k) - 1)
            grams[k] = [(keys, n.astype(float)) for keys, n in (lower[k][x] for x in self.languages)] if lower else []
            for keys, _ in [] if lower else grams[k + 1]:
                low, n = _summed(keys & mask)
                grams[k].append((low, n.astype(float)))
        letters = np.unique(np.concatenate([k for k, _ in grams[1]]))
        self.uniform = 1.0 / (len(letters) + 1)
        self.tables, self.logs, self.contexts, self.backs = {}, {}, {}, {}
        below = None
        for k in range(1, ORDER + 1):
            union = np.unique(np.concatenate([x for x, _ in grams[k]]))
            ctx = np.unique(union >> np.uint64(16))
            p, lam = np.zeros((len(union), len(per))), np.ones((len(ctx), len(per)))
            for i, (keys, n) in enumerate(grams[k]):
                cut = cuts[k][self.languages[i]] if cuts else discount((n == 1).sum(), (n == 2).sum())
                at = np.searchsorted(ctx, keys >> np.uint64(16))
                total, kinds = np.bincount(at, n, len(ctx)), np.bincount(at, minlength=len(ctx))
                seen = total > 0
                lam[seen, i] = cut * kinds[seen] / total[seen]
                p[np.searchsorted(union, keys), i] = (n - cut) / total[at]
            lower = below[np.searchsorted(self._union, union & np.uint64((1 << 16 * (k - 1)) - 1))] if k > 1 else np.full((len(union), len(per)), self.uniform)
            p += lam[np.searchsorted(ctx, union >> np.uint64(16))] * lower
            self.tables[k], self.logs[k] = SortedTable(union), np.log(p).astype(np.float32)
            self.contexts[k], self.backs[k] = SortedTable(ctx), np.log(lam).astype(np.float32)
            below, self._union = p, union
        del self._union

    def log_probability(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log probability of each key's last code after the others, per language."""
        if not order:
            return np.full((len(keys), len(self.languages)), np.log(self.uniform), np.float32)
        at = self.tables[order].find(keys)
        out = self.logs[order][at]
        lost = np.flatnonzero(at < 0)
        if len(lost):
            k = keys[lost]
            back = self.contexts[order].find(k >> np.uint64(16))
            weight = np.where(back[:, None] >= 0, self.backs[order][back], np.float32(0))
            out[lost] = weight + self.log_probability(k & np.uint64((1 << 16 * (order - 1)) - 1), order - 1)
        return out

    def log_sums(self, texts: list[str], block: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
        """Summed log probabilities of each text's n-grams of a block, and the
        numbers of characters."""
        codes, n = codes_of(texts)
        keys = keys_of(codes, n)
        own = np.flatnonzero(block_of(keys, blocks) == block)
        lp, text = self.log_probability(keys[own]), np.repeat(np.arange(len(texts)), n)[own]
        return np.stack([np.bincount(text, lp[:, i], len(texts)) for i in range(lp.shape[1])], 1), n

    def cross_entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits a character under each language, and the numbers of characters."""
        codes, n = codes_of(texts)
        lp = self.log_probability(keys_of(codes, n))
        total = np.zeros((len(texts), len(self.languages)))
        some = np.flatnonzero(n)
        if len(some):
            total[some] = np.add.reduceat(lp, np.cumsum(n[some]) - n[some], axis=0, dtype=np.float64)
        return -total / np.maximum(n, 1)[:, None] / np.log(2), n


def _arrays(counts: DataFrame, languages: list[str]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Keys in order and counts of each language."""
    out = {x: (np.zeros(0, np.uint64), np.zeros(0, np.int64)) for x in languages}
    for lang, g in counts.toPandas().groupby("lang"):
        k = g["k"].to_numpy().view(np.uint64)
        order = np.argsort(k)
        out[str(lang)] = (k[order], g["n"].to_numpy()[order])
    return out


def train(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, max_ngrams: int = MAX_NGRAMS) -> Iterator[tuple[int, int, Models]]:
    """``(block, blocks, models)`` of the languages of the training rows; nothing
    if there are none.

    All n-grams of all rows count; a block holds about ``max_ngrams`` of them (at
    four languages), which bounds what is collected and broadcast at a time.
    Discounts and continuation counts are those of all n-grams."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0) & (fold("doc_id", folds) != held_out))
    counts = written(count_ngrams(rows.select(F.col("lang").cast("string").alias("lang"), "text")), "language-counts")
    sizes = {r["lang"]: r["count"] for r in counts.groupBy("lang").count().collect()}   # a row for each language
    languages = sorted(sizes)
    if not languages:
        return
    blocks = -(-sum(sizes.values()) * len(languages) // (4 * max_ngrams))
    if blocks == 1:
        yield 0, 1, Models(_arrays(counts, languages))
        return
    grams = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        grams[k] = written(grams[k + 1].groupBy("lang", F.col("k").bitwiseAND(F.lit((1 << 16 * k) - 1)).alias("k")).agg(F.count(F.lit(1)).alias("n")), f"language-{k}-grams")
    cuts = {k: {r["lang"]: discount(r["once"], r["twice"]) for r in g.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).collect()}
            for k, g in grams.items()}
    small = {k: _arrays(grams[k], languages) for k in (1, 2)}   # the alphabet and its pairs
    own = F.shiftrightunsigned("k", 16).bitwiseAND(F.lit((1 << 32) - 1)) % _PRIME % blocks
    for block in range(blocks):
        yield block, blocks, Models(_arrays(counts.where(own == block), languages), {**small, 3: _arrays(grams[3].where(own == block), languages)}, cuts)


_RESULT = "doc_id bigint, lang string, lang_pred string, score double, bits double, chars bigint"


def _judged(h: np.ndarray, n: np.ndarray, letters: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Predicted language, score and least cross-entropy of each text; ``names``
    ends with the name of no language."""
    best = np.where(letters, h.argmin(1), -1) if len(names) > 1 else np.full(len(n), -1)
    evidence = (h.min(1)[:, None] - h) * np.minimum(n, SCORE_CHARS)[:, None] * np.log(2)
    s = 1 / np.exp(np.maximum(evidence, -700)).sum(1)
    return names[best], np.where(best >= 0, s, 0.0), h.min(1)


def _letters_in(texts: list[str]) -> np.ndarray:
    return np.fromiter((any(map(str.isalpha, t)) for t in texts), bool, len(texts))


def _result(b: pa.RecordBatch, pred, score, bits, chars) -> pa.RecordBatch:
    cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cat(pred, object), pa.string()), pa.array(cat(score, float)),
                                       pa.array(cat(bits, float)), pa.array(cat(chars, np.int64))],
                                      names=["doc_id", "lang", "lang_pred", "score", "bits", "chars"])


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models: Models | None = shared.value
        names = np.array([*(models.languages if models else []), UNKNOWN], object)
        for b in batches:
            texts = [t or "" for t in b.column(2).to_pylist()]
            out = []
            for i, j in _pieces(texts):
                part = texts[i:j]
                h, n = models.cross_entropy(part) if models else (np.zeros((len(part), 1)), np.zeros(len(part), np.int64))
                out.append((*_judged(h, n, _letters_in(part), names), n))
            yield _result(b, *(zip(*out) if out else [[]] * 4))
    return run


def _sums(shared, block: int, blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for i, j in _pieces(texts):
                sums, n = shared.value.log_sums(texts[i:j], block, blocks)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(sums.tolist(), pa.list_(pa.float64())), pa.array(n, pa.int64()),
                                                  pa.array(_letters_in(texts[i:j]))], names=["row", "sums", "n", "letters"])
    return run


def _judge(languages: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*languages, UNKNOWN], object)
        for b in batches:
            if b.num_rows:
                n, letters = (b.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
                h = -np.array(b.column(2).to_pylist()) / np.maximum(n, 1)[:, None] / np.log(2)
                yield _result(b, *([x] for x in _judged(h, n, letters, names)), [n])
    return run


def _predicted(docs: DataFrame, blocks: Iterator[tuple[int, int, Models]]) -> DataFrame:
    """``_RESULT`` of ``docs(doc_id, lang, text)``: in one pass over the texts for one
    block, else in a pass for each block, whose sums are added up."""
    context, parts = docs.sparkSession.sparkContext, []
    block, n, models = next(blocks, (0, 1, None))
    if n == 1:
        return written(docs.mapInArrow(_predict(context.broadcast(models)), _RESULT), "language")
    texts = written(docs.withColumn("row", F.monotonically_increasing_id()), "language-texts", "zstd")
    while models is not None:
        shared, languages = context.broadcast(models), models.languages
        parts.append(written(texts.select("row", "text").mapInArrow(_sums(shared, block, n), "row bigint, sums array<double>, n bigint, letters boolean"), "language-sums"))
        shared.unpersist()
        block, n, models = next(blocks, (0, n, None))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionAll(part)
    total = every.groupBy("row").agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(len(languages))]).alias("sums"), F.max("n").alias("n"), F.max("letters").alias("letters"))
    joined = texts.select("row", "doc_id", "lang").join(total, "row").select("doc_id", "lang", "sums", "n", "letters")
    return written(joined.mapInArrow(_judge(languages), _RESULT), "language")


def identify(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, reject_at: float = REJECT_AT,
             max_ngrams: int = MAX_NGRAMS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, lang_pred, score,
    cross_entropy, rejected``.

    ``lang_pred`` is a training language, or ``und`` (score 0) for null texts,
    texts without a letter, and where there is nothing to learn from.
    ``rejected``: the cross-entropy lies ``reject_at`` standard deviations above
    the mean of the training texts predicted as that language; the deviation
    widens for short texts.  Rows of null lang are predicted, not learned from.
    Only doc_id, text and lang are read."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    rows = _predicted(docs, train(docs, folds, held_out, max_ngrams)).withColumn("held_out", fold("doc_id", folds) == held_out)
    usual = rows.where(~F.col("held_out") & (F.col("lang") == F.col("lang_pred"))).groupBy("lang_pred")\
        .agg(F.avg("bits").alias("mean"), F.stddev_pop("bits").alias("spread"))  # a row for each language
    limit = F.col("mean") + reject_at * (F.col("spread") + 0.01) * F.sqrt(1 + 100 / F.greatest("chars", F.lit(1)))
    return rows.join(usual, "lang_pred", "left").select(
        "doc_id", "held_out", "lang_pred", "score", F.col("bits").alias("cross_entropy"), F.coalesce(F.col("bits") > limit, F.lit(True)).alias("rejected"))
