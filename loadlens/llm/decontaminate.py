"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark window (``WINDOW`` consecutive item words, or the whole of a
shorter item) must occur word for word.  Its words are ordered by rarity, counted
over all documents, and the necessary prefix for exact containment is its
rarest word: no document can hold the window without it.  Document words are
joined with these prefix words only.  A match at word ``p`` with offset ``o``
fixes the window's place at ``p - o``; places outside the text are dropped
(positional and length bounds) and the rest compared word for word.

The benchmark is taken in blocks of at most ``BLOCK_CHARS`` characters, each
broadcast and scanned against all documents, so any benchmark size is read
with bounded memory and nothing of the documents is shuffled.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.llm.common import fresh, text_steps

WINDOW = 13
BLOCK_CHARS = 16_000_000   # characters of benchmark text broadcast at a time
MIN_SHARE = 20             # contaminated: n_hit * MIN_SHARE >= n_words
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {i: i + 32 for i in range(65, 91)}


def words_of(text: str | None) -> list[str]:
    """Words of a whole text after lower-casing A-Z; none for null."""
    if not text:
        return []
    return _WORD.findall(text.lower() if text.isascii() else text.translate(_LOWER))


#: Bytes of UTF-8 text: A-Z lower-cased, what separates words as a space.  All
#: separators are single bytes, so places do not move.
_BYTES = bytes(i + 32 if 65 <= i <= 90 else i if i >= 0x80 or 48 <= i <= 57 or 97 <= i <= 122 else 32 for i in range(256))


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of a batch of texts: for each text the place of its first word (and
    the end), for each word its code, and the distinct words by code."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "").take(pa.array(np.arange(len(texts))))
    _, offsets, data = texts.buffers()
    flat = pa.py_buffer(data.to_pybytes().translate(_BYTES) if data else b"")
    words = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, flat]))
    every = words.flatten()
    full = pc.not_equal(every, "").to_numpy(zero_copy_only=False)  # leading and trailing separators leave empty words
    size = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(full)])[np.cumsum(size)]
    coded = pc.dictionary_encode(every.filter(pa.array(full)))
    return np.concatenate([[0], ends]), coded.indices.to_numpy(), coded.dictionary


def _block_items(block: DataFrame) -> list[tuple[str, list[str]]]:
    return [("" if r[0] is None else str(r[0]), words_of(r[1])) for r in block.collect()]


def _windows(items: list[tuple[str, list[str]]], window: int) -> dict[tuple[str, ...], set[str]]:
    out: dict[tuple[str, ...], set[str]] = defaultdict(set)
    for item, words in items:
        for i in range(max(1, len(words) - window + 1) if words else 0):
            out[tuple(words[i:i + window])].add(item)
    return out


def word_counts(docs: DataFrame, vocabulary: list[str], text: str = "text") -> dict[str, int]:
    """How often each word of a bounded vocabulary occurs in all documents."""
    spark = docs.sparkSession
    order = spark.sparkContext.broadcast({w: i for i, w in enumerate(vocabulary)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n = order.value, np.zeros(len(order.value), np.int64)
        for b in batches:
            for part in text_steps(b, 0):
                _, codes, distinct = split_words(part.column(0))
                place = np.array([at.get(w, -1) for w in distinct.to_pylist()], np.int64)
                ours = np.flatnonzero(place >= 0)
                n[place[ours]] += np.bincount(codes, minlength=len(place))[ours]
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["w", "n"])

    rows = docs.select(F.col(text)).mapInArrow(count, "w bigint, n bigint").groupBy("w").agg(F.sum("n").alias("n")).collect()
    return {vocabulary[r["w"]]: r["n"] for r in rows}


def prefix_index(windows: dict[tuple[str, ...], set[str]], counts: dict[str, int]) -> dict:
    """rarest word -> [(offset, window, items)]."""
    index = defaultdict(list)
    for w, items in windows.items():
        offset = min(range(len(w)), key=lambda i: (counts.get(w[i], 0), w[i], i))
        index[w[offset]].append((offset, list(w), sorted(items)))
    return dict(index)


def find_windows(starts: np.ndarray, codes: np.ndarray, distinct: pa.Array, index: dict) -> dict[int, tuple[list, set]]:
    """Texts with occurring windows -> word spans [start, end) and items."""
    words = distinct.to_pylist()
    prefix = np.fromiter((w in index for w in words), bool, len(words))
    places = np.flatnonzero(prefix[codes])
    if not len(places):
        return {}
    code = {w: i for i, w in enumerate(words)}
    coded: dict[int, list] = {}  # prefix word -> windows whose words all occur in this batch
    out: dict[int, tuple[list, set]] = {}
    docs = np.searchsorted(starts, places, side="right") - 1
    for p, d in zip(places.tolist(), docs.tolist()):
        c = int(codes[p])
        if c not in coded:
            coded[c] = [(o, np.array([code[w] for w in window]), items) for o, window, items in index[words[c]] if all(w in code for w in window)]
        low, high = int(starts[d]), int(starts[d + 1])
        for offset, window, items in coded[c]:
            s = p - offset
            if s >= low and s + len(window) <= high and np.array_equal(codes[s:s + len(window)], window):
                spans, found = out.setdefault(d, ([], set()))
                spans.append((s - low, s - low + len(window)))
                found.update(items)
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint (start, end) word spans covering the given ones."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


_FOUND = T.StructType([T.StructField("n_words", T.LongType()),
                       T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
                       T.StructField("items", T.ArrayType(T.StringType()))])


def find_contamination(docs: DataFrame, benchmark: DataFrame, column: str = "found", window: int = WINDOW,
                       block_chars: int = BLOCK_CHARS, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``column``: ``n_words``, ``spans`` (disjoint word
    spans [start, end) hit by windows) and ``items`` (ids as text of items with
    occurring windows, sorted).

    Null and empty texts have no words and no hits; items without words are
    found nowhere; repeated items count once; a null item id is the empty
    text.  All other columns pass through.  Either table may be empty."""
    spark = docs.sparkSession
    bench = benchmark.select("item_id", "text")
    chars = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / block_chars))
    out = docs.withColumn(column, F.lit(None).cast(_FOUND))
    schema = out.schema
    for k in range(blocks):
        part = bench if blocks == 1 else bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        windows = _windows(_block_items(part), window)
        counts = word_counts(docs, sorted({w for x in windows for w in x}), text) if windows else {}
        index = spark.sparkContext.broadcast(prefix_index(windows, counts))
        out = out.mapInArrow(_scan(index, text, column), schema)
    return out


def _scan(index, text: str, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = index.value
        for whole in batches:
            names = whole.schema.names
            for b in text_steps(whole, names.index(text)):
                place = b.schema.get_field_index(column)
                starts, codes, distinct = split_words(b.column(names.index(text)))
                found = find_windows(starts, codes, distinct, at)
                rows = [{"n_words": n, "spans": [], "items": []} for n in np.diff(starts).tolist()]
                for i, (spans, items) in found.items():
                    rows[i] |= {"spans": [list(x) for x in merged(spans)], "items": sorted(items)}
                old = b.column(place)
                if old.null_count < len(old):  # an earlier block's
                    for row, was in zip(rows, old.to_pylist()):
                        row["spans"] = [list(x) for x in merged(row["spans"] + was["spans"])]
                        row["items"] = sorted({*row["items"], *was["items"]})
                new = pa.array(rows, type=b.schema.field(place).type)
                yield pa.RecordBatch.from_arrays([new if i == place else c for i, c in enumerate(b.columns)], names=names)
    return run


def n_hit(found: str) -> Column:
    return F.coalesce(F.expr(f"aggregate({found}.spans, 0L, (a, x) -> a + x[1] - x[0])"), F.lit(0).cast("bigint"))


def contaminated(found: str, min_share: int = MIN_SHARE):
    """True where hit words are at least 1 / ``min_share`` of the words."""
    return (n_hit(found) > 0) & (n_hit(found) * min_share >= F.col(f"{found}.n_words"))


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                         block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated``."""
    f = find_contamination(docs.select("doc_id", "text"), benchmark, "found", window, block_chars)
    return f.select("doc_id", F.col("found.n_words").alias("n_words"), n_hit("found").alias("n_hit"),
                    F.size("found.items").cast("bigint").alias("n_items"),
                    F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
                    contaminated("found").alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the contaminated rows; all columns stay."""
    column = fresh(docs, "found")
    return find_contamination(docs, benchmark, column, window).where(~contaminated(column)).drop(column)
