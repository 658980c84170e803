"""Substring dedup over paragraphs: MinHash banding, exact verification, components.

Paragraphs (lines of at least ``MIN_WORDS`` words, near matches from one shingle
on) are reduced to lower-case words.
Equal paragraphs collapse by a 128-bit key first, so a passage that a million
documents share is one row from there on.  The signature's bands put a pair of
Jaccard similarity 0.8 into a common bucket with probability 0.9998 (16 bands of
4 rows); short paragraphs, whose shingles rarely meet by chance, need 9 bands of
2 rows for 0.9999.

Buckets are never paired out.  First each paragraph of a bucket is compared
with one representative; the verified links make components.  Then only
buckets that still hold several components are looked at: their paragraphs
are joined with those of other components over the rarest shingles that any
pair of similarity 0.8 must share (prefix filter), within length and positional
bounds.  Each candidate pair is verified by exact Jaccard similarity of its
5-word shingles, so no link between different paragraphs of a bucket is lost
and a large group of near copies costs one comparison per member and band.

A passage that lies inside longer, otherwise different paragraphs, or is broken
over lines elsewhere, has no paragraph to match.  The word sequence of a whole
document therefore also gives units of ``UNIT_WORDS`` words: of any
``UNIT_WORDS`` consecutive ones that with the least hash, so two documents that
share over 50 consecutive words share a unit, wherever the passage and its line
breaks lie in each.  Units that repeat in another document mark their words;
stretches of adjoining units are the passages, and stretches that share a unit
are linked into classes.  The first place of each unit is kept whole; other words
go if a unit around them has an earlier place.  Which units are chosen depends on
the words beside a passage, so a unit that seems to come first beside one with an
earlier place is looked up there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.llm.common import STEP_ROWS, arrow_rows, checkpointed, text_steps, written
from loadlens.llm.components import connected_components

MIN_WORDS = 25          # lines of fewer words are no paragraphs
SHINGLE_WORDS, SIMILARITY = 5, 0.8
NEAR_WORDS = SHINGLE_WORDS  # paragraphs of fewer words have no shingle and only match equal ones
BANDS, ROWS = 16, 4
SHORT = 35              # paragraphs of at most so many shingles have their own bands
SHORT_BANDS, SHORT_ROWS = 9, 2
STEP_SHINGLES = 1 << 15
STEP_LINES = 1 << 14    # lines whose signatures are held at a time
BATCH_ROWS = 1_000      # rows with whole texts or lists of places in an Arrow batch
FILTER_BITS = 1 << 26   # bits of the table that tells which keys may be wanted (8 MB, broadcast)
UNIT_WORDS = 26         # 2 * 26 - 1 = 51 shared words always share a unit
_BASE = 0x9E3779B97F4A7C15


def shingles(words: list[bytes], k: int = SHINGLE_WORDS) -> list[bytes]:
    """The ``k``-word shingles; fewer words are one shingle."""
    return list(map(b" ".join, zip(*(words[i:] for i in range(k))))) if len(words) >= k else [b" ".join(words)] if words else []


def jaccard(a: list[bytes], b: list[bytes]) -> float:
    x, y = set(a), set(b)
    return len(x & y) / len(x | y) if x or y else 1.0


class Signatures:
    """MinHash values by random odd multipliers and offsets over 64-bit hashes."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(1, 2 ** 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2 ** 63, bands * rows, dtype=np.uint64)

    def _least(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        out, x = np.empty((len(self.a), len(starts)), np.uint64), np.empty_like(hashes)
        for j, (a, b) in enumerate(zip(self.a, self.b)):
            np.multiply(hashes, a, out=x)
            np.add(x, b, out=x)
            np.minimum.reduceat(x, starts, out=out[j])
        return out

    def band_keys(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """One 64-bit key for each text and band; ``hashes`` are the texts'
        shingles one after another, ``counts`` of them each."""
        least = np.full((len(self.a), len(counts)), np.iinfo(np.uint64).max, np.uint64)
        text = np.repeat(np.arange(len(counts)), counts)
        for k in range(0, len(hashes), STEP_SHINGLES):
            at = text[k:k + STEP_SHINGLES]
            starts = np.flatnonzero(np.diff(at, prepend=-1))
            texts = slice(at[0], at[-1] + 1)    # every text has a shingle
            np.minimum(least[:, texts], self._least(hashes[k:k + STEP_SHINGLES], starts), out=least[:, texts])
        least ^= least >> np.uint64(29)
        key = np.zeros((self.bands, len(counts)), np.uint64)
        for r in range(self.rows):
            key = (key ^ least[r::self.rows]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
        return (key.T + np.arange(self.bands, dtype=np.uint64)) * np.uint64(0xD6E8FEB86659FD93)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def paragraphs(text: str | None, min_words: int) -> list[tuple[int, int, int, list[bytes]]]:
    """(number, start, end, words) of the lines of at least ``min_words`` words."""
    out, at, least = [], 0, max(1, min_words)
    text = text or ""
    for i, (line, raw) in enumerate(zip(text.split("\n"), text.encode("utf-8", "surrogatepass").lower().split(b"\n"))):
        words, n = raw.split(), len(line)
        if len(words) >= least:
            out.append((i, at, at + n, words))
        at += n + 1
    return out


def unit_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of each run of ``size`` words, from the words' hashes."""
    run = np.zeros(len(h) - size + 1, np.uint64)
    for j in range(size):  # a polynomial of the words' hashes, modulo 2^64
        run *= np.uint64(_BASE)
        run += h[j:len(h) - size + 1 + j]
    run ^= run >> np.uint64(31)
    run *= np.uint64(0xD6E8FEB86659FD93)
    return run


def least_places(values: np.ndarray, size: int) -> np.ndarray:
    """Place of the least of each ``size`` consecutive values, the first of equal
    ones, from those of windows half as long; places never fall."""
    least, at, width = values, np.arange(len(values)), 1
    while width < size:
        step = min(width, size - width)
        later = least[step:] < least[:-step]
        least, at, width = np.minimum(least[step:], least[:-step]), np.where(later, at[step:], at[:-step]), width + step
    return at


def units(lines: list[list[bytes]], size: int = UNIT_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line, first word and 64-bit hash of the chosen units of all lines (word
    sequences): the run of ``size`` words of least hash among each ``size``
    consecutive ones, fewer at the ends of a line.  Runs do not cross them; those of under ``2 * size - 1``
    words have none."""
    long = [i for i, w in enumerate(lines) if len(w) >= 2 * size - 1]
    n = np.array([len(lines[i]) for i in long], np.int64)
    if not len(n):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = word_hashes([w for i in long for w in lines[i]])
    run = unit_hashes(h, size)
    line = np.repeat(np.arange(len(n)), n)
    whole = line[:len(run)] == line[size - 1:]
    run[~whole] = np.iinfo(np.uint64).max
    # runs that cross lines part them by size - 1 places; as many at both ends give the first and last line the same windows
    edge = np.full(size - 1, np.iinfo(np.uint64).max)
    padded = np.concatenate([edge, run, edge])
    least = least_places(padded, size) - (size - 1)
    chosen = least[np.diff(least, prepend=-size) != 0]
    chosen = chosen[(chosen >= 0) & (chosen < len(run))]
    chosen = chosen[whole[chosen]]
    starts = np.cumsum(n) - n
    return np.array(long)[line[chosen]], chosen - starts[line[chosen]], run[chosen]


_PLACES = ("kind int, row bigint, doc_id bigint, paragraph int, start int, `end` int, n_words int, first_word int, key binary, unit bigint, "
           "lines array<struct<paragraph: int, start: int, `end`: int, at: int, n: int>>")
_LINES = pa.list_(pa.struct([(x, pa.int32()) for x in ("paragraph", "start", "end", "at", "n")]))
_TYPES = {"kind": pa.int32(), "row": pa.int64(), "doc_id": pa.int64(), "paragraph": pa.int32(), "start": pa.int32(), "end": pa.int32(), "n_words": pa.int32(),
          "first_word": pa.int32(), "key": pa.binary(), "unit": pa.int64(), "lines": _LINES}
PARAGRAPH, UNIT, DOCUMENT = 0, 1, 2


def _batch(kind: int, n: int, **given) -> pa.RecordBatch:
    columns = {x: pa.nulls(n, t) if x not in given else given[x].cast(t) if isinstance(given[x], pa.Array) else pa.array(given[x], t)
               for x, t in _TYPES.items() if x != "kind"}
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), *columns.values()], names=list(_TYPES))


def _cut(min_words: int):
    """Places and keys of whole paragraphs, the units of each document, and its
    lines and key where it has units; no words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in text_steps(b, 2):
                lines, keys, whole, ends = [], [], [], [0]
                row_ids, doc_ids = part.column(0), part.column(1)
                for i, text in enumerate(part.column(2).to_pylist()):
                    sequence = []
                    for number, start, end, w in paragraphs(text, 1):
                        n = len(w)
                        lines.append((i, number, start, end, len(sequence), n))
                        sequence += w
                        if n >= min_words:
                            keys.append(xxhash.xxh3_128_digest(b" ".join(w)))
                    whole.append(sequence)
                    ends.append(len(lines))
                if lines:
                    i, *columns = np.array(lines, np.int64).T
                    taken = columns[-1] >= min_words
                    at = pa.array(i[taken])
                    paragraph, start, end, sequence_at, n = (pa.array(x.astype(np.int32)) for x in columns)
                    if keys:
                        yield _batch(PARAGRAPH, len(keys), row=row_ids.take(at), doc_id=doc_ids.take(at), key=keys,
                                     **{x: y.filter(pa.array(taken)) for x, y in (("paragraph", paragraph), ("start", start), ("end", end), ("n_words", n))})
                    maps = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([paragraph, start, end, sequence_at, n], fields=list(_LINES.value_type)))
                doc, first, unit = units(whole)
                if len(doc):
                    at = pa.array(doc)
                    yield _batch(UNIT, len(doc), row=row_ids.take(at), doc_id=doc_ids.take(at), first_word=first.astype(np.int32), unit=unit.view(np.int64))
                    have = np.unique(doc)
                    at = pa.array(have)
                    yield _batch(DOCUMENT, len(have), row=row_ids.take(at), doc_id=doc_ids.take(at), lines=maps.take(at),
                                 key=[xxhash.xxh3_128_digest(b" ".join(whole[i])) for i in have])
    return run


def _near_lines(text: bytes | None, least: int) -> list[list[bytes]]:
    """Words of the lines of at least ``least`` words, as of ``paragraphs`` but without their places."""
    return [w for w in map(bytes.split, (text or b"").lower().split(b"\n")) if len(w) >= least]


def line_bands(words: Sequence[list[bytes]], sign: Signatures, short: Signatures) -> tuple[np.ndarray, np.ndarray]:
    """Band keys of all lines, of ``SHINGLE_WORDS`` words or more each, and where
    those of each line end: short ones have their own bands, those that a short one
    may match both kinds."""
    n = np.array(list(map(len, words)), np.int64)
    run = unit_hashes(word_hashes([w for line in words for w in line]), SHINGLE_WORDS)
    line = np.repeat(np.arange(len(n)), n)
    inside = line[:len(run)] == line[SHINGLE_WORDS - 1:]
    run, line, count = run[inside], line[:len(inside)][inside], n - (SHINGLE_WORDS - 1)
    size, end = count.copy(), np.cumsum(count)
    for i in np.flatnonzero(count > SHORT):     # different shingles
        own = np.sort(run[end[i] - count[i]:end[i]])
        size[i] = 1 + np.count_nonzero(own[1:] != own[:-1])
    few, many = size * SIMILARITY <= SHORT, size > SHORT
    width = few * short.bands + many * sign.bands
    ends = np.concatenate([[0], np.cumsum(width)])
    keys = np.zeros(ends[-1], np.uint64)
    for signatures, take, skip in ((short, few, 0 * width), (sign, many, few * short.bands)):
        if take.any():
            at = (ends[:-1] + skip)[take][:, None] + np.arange(signatures.bands)
            keys[at] = signatures.band_keys(run[take[line]], count[take])
    return keys.view(np.int64), ends


def _bands(least: int):
    """``key, bands`` of each line of at least ``least`` words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign, short = Signatures(), Signatures(SHORT_BANDS, SHORT_ROWS, 6)
        for b in batches:
            for part in text_steps(b, 0):
                lines = [w for text in part.column(0).cast(pa.binary()).to_pylist() for w in _near_lines(text, least)]
                lines = list({xxhash.xxh3_128_digest(b" ".join(w)): w for w in lines}.items())
                for s in range(0, len(lines), STEP_LINES):
                    keys, words = zip(*lines[s:s + STEP_LINES])
                    bands, ends = line_bands(words, sign, short)
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(bands))],
                                                     names=["key", "bands"])
    return run


def _bodies(least: int):
    """``key, body`` of each line of at least ``least`` words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in text_steps(b, 0):
                bodies = list({b" ".join(w) for text in part.column(0).cast(pa.binary()).to_pylist() for w in _near_lines(text, least)})
                if bodies:
                    yield pa.RecordBatch.from_arrays([pa.array(list(map(xxhash.xxh3_128_digest, bodies)), pa.binary()), pa.array(bodies, pa.binary()).cast(pa.string())],
                                                     names=["key", "body"])
    return run


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, words`` of each document that may have units."""
    for b in batches:
        for part in text_steps(b, 0):
            split = ((x or b"").lower().split() for x in part.column(0).cast(pa.binary()).to_pylist())
            words = [b" ".join(w) for w in split if len(w) >= 2 * UNIT_WORDS - 1]
            if words:
                yield pa.RecordBatch.from_arrays([pa.array(list(map(xxhash.xxh3_128_digest, words)), pa.binary()), pa.array(words, pa.binary())], names=["key", "words"])


def maybe_in(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """``rows`` without most of those whose ``column`` is in no row of ``keys``: a
    table of ``FILTER_BITS`` bits, in rows of 4 KB, has the bit of each key's hash
    set.  It only thins out what the exact join after it exchanges."""
    slot = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
    table = keys.select(slot.alias("_slot")).groupBy(F.bitmap_bucket_number("_slot").alias("_bucket"))\
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits"))
    at = F.bitmap_bit_position(slot).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    named = rows.withColumn("_bucket", F.bitmap_bucket_number(slot))
    return named.join(F.broadcast(table), "_bucket").where(byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) > 0).select(*rows.columns)


def verify(pairs: DataFrame, bodies: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``pairs(u, v)`` of paragraph ids whose exact Jaccard similarity over
    5-word shingles is at least ``similarity``."""
    @F.pandas_udf("boolean")
    def alike(a, b):
        import pandas as pd
        return pd.Series([jaccard(shingles(x.encode().split()), shingles(y.encode().split())) >= similarity for x, y in zip(a, b)], dtype=bool)
    x = bodies.select(F.col("id").alias("u"), F.col("body").alias("a"))
    y = bodies.select(F.col("id").alias("v"), F.col("body").alias("b"))
    return pairs.join(x, "u").join(y, "v").where(alike("a", "b")).select("u", "v")


def _prefixes(members: DataFrame, bodies: DataFrame, similarity: float) -> DataFrame:
    """``(id, root, size, sh, place)``: the rarest shingles of each member, as many
    as a pair of the similarity must share one of, and their places in the
    order from the rarest on."""
    @F.pandas_udf("array<bigint>")
    def hashes(body):
        import pandas as pd
        return pd.Series([np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, s), np.uint64, len(s))).view(np.int64)
                          for s in (shingles(x.encode().split()) for x in body)])
    own = members.join(bodies, "id").select("id", "root", hashes("body").alias("all"))
    own = written(own.select("id", "root", F.size("all").alias("size"), F.explode("all").alias("sh")), "paragraph-shingles")
    seen = own.groupBy("sh").agg(F.count(F.lit(1)).alias("seen"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("seen", "sh"))  # a paragraph's own shingles
    return own.join(seen, "sh").withColumn("place", place)\
        .where(F.col("place") <= F.col("size") - F.ceil(F.col("size") * similarity - 1e-9) + 1).drop("seen")


def _other_pairs(members: DataFrame, bodies: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``(u, v)`` of members of different components that may reach the
    similarity: they share a shingle of both prefixes, and its places leave
    enough shingles after it on both sides (length and positional bounds).

    A place bounds the other side's size, so the join is on shingle and size:
    members whose rare shingles are their own meet nobody.  The commonest
    component of a shingle is only joined to, not from."""
    prefix = written(_prefixes(members, bodies, similarity), "paragraph-prefixes")
    main = prefix.groupBy("sh", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("sh")\
        .agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("roots")).where("roots > 1").drop("roots")
    near = prefix.join(main, "sh")
    both = (1 + similarity) / similarity
    least = F.ceil(F.col("size") * similarity - 1e-9).cast("int")
    most = F.least(F.floor(F.col("size") / similarity + 1e-9), F.floor(both * (F.col("size") - F.col("place") + 1) - F.col("size") + 1e-9)).cast("int")
    x = near.where((F.col("root") != F.col("main")) & (most >= least))\
        .select("sh", F.col("id").alias("x"), F.col("root").alias("r"), F.col("size").alias("s"), F.explode(F.sequence(least, most)).alias("size"))
    y = near.where(most >= least).select("sh", "size", "id", "root", F.floor(both * (F.col("size") - F.col("place") + 1) - F.col("size") + 1e-9).alias("upto"))
    pairs = x.join(y, ["sh", "size"]).where((F.col("r") != F.col("root")) & (F.col("s") <= F.col("upto")))
    return pairs.select(F.greatest("id", "x").alias("u"), F.least("id", "x").alias("v")).distinct()


def paragraph_links(distinct: DataFrame, bodies_of, similarity: float = SIMILARITY) -> DataFrame:
    """``distinct(id, bands, copies)`` -> components ``(node, root)`` of near-equal
    paragraphs.  ``bodies_of(ids)`` gives ``(id, body)`` of a frame of ids."""
    bucket = Window.partitionBy("b")
    # a bucket's representative is its paragraph of most copies; of equals another one in each band
    best = F.max(F.struct("copies", F.xxhash64("b", "id").alias("h"), "id")).over(bucket)["id"]
    in_bucket = distinct.select("id", "copies", F.explode("bands").alias("b")).withColumn("n", F.count(F.lit(1)).over(bucket)).withColumn("rep", best)
    members = written(in_bucket.where("n > 1").select("b", "id", "rep"), "paragraph-buckets")
    bodies = written(bodies_of(members.select("id").distinct()), "paragraph-bodies", "zstd")
    stars = members.where("id <> rep").select(F.greatest("id", "rep").alias("u"), F.least("id", "rep").alias("v")).distinct()
    links = checkpointed(verify(stars, bodies, similarity))
    groups = connected_components(links)
    # buckets with several components: their paragraphs against those of other components
    at = members.select("b", "id").join(groups.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = at.groupBy("b").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("b")
    rest = checkpointed(at.join(mixed, "b", "left_semi").select("id", "root").distinct())
    more = checkpointed(verify(_other_pairs(rest, bodies, similarity), bodies, similarity))
    return connected_components(links.unionAll(more)) if more.take(1) else groups


_STRETCHES = ("row bigint, doc_id bigint, start int, `end` int, hits array<struct<key: bigint, first_word: int, alive: boolean>>, "
              "lines array<struct<paragraph: int, start: int, `end`: int, at: int, n: int>>")
_RUNS = ("doc_id bigint, paragraph int, start int, `end` int, first_word int, n_words int, class_id string, copies bigint, first_doc bigint, "
         "removed boolean")


_LINE_FIELDS = [x.name for x in _LINES.value_type]


def _elements(lists: pa.ListArray, *fields: str) -> list[np.ndarray]:
    """Row of each struct of a column of lists and its fields, none of them null, as columns."""
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    structs = lists.flatten()
    return [np.repeat(np.arange(len(n)), n), *(structs.field(x).to_numpy(zero_copy_only=False) for x in fields)]


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each range ``lo`` to ``hi`` and all its places."""
    n = hi - lo
    of = np.repeat(np.arange(len(n)), n)
    return of, np.arange(len(of)) - (np.cumsum(n) - n - lo)[of]


def _place(row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Row and place in it (an int) as one ordered number."""
    return (row.astype(np.int64) << 32) + at


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of repeated units of each document that overlap or touch (chosen
    units lie at most ``UNIT_WORDS`` apart in a passage).  A unit is alive
    if none of its words lies in a paragraph that goes as a whole; ``lines`` are
    those of the stretch that are no repeated paragraphs."""
    for b in batches:
        for s in range(0, b.num_rows, STEP_ROWS):
            part = b.slice(s, STEP_ROWS)
            (doc, key, first), (owner, *line), (of, taken, removed) = (_elements(part[x], *f) for x, f in (
                ("hits", ("key", "first_word")), ("lines", _LINE_FIELDS), ("whole", ("paragraph", "removed"))))
            if not len(doc):
                continue
            order = np.lexsort((first, doc))
            key, first = key[order], first[order]
            order = np.lexsort((line[_LINE_FIELDS.index("at")], owner))
            line = {x: y[order] for x, y in zip(_LINE_FIELDS, line)}
            in_whole, gone = (np.isin(_place(owner, line["paragraph"]), _place(of[x], taken[x])) for x in (slice(None), removed.astype(bool)))
            gone = np.cumsum([0, *gone])
            at = _place(owner, line["at"])
            a, z = np.searchsorted(at, _place(doc, first), "right") - 1, np.searchsorted(at, _place(doc, first + UNIT_WORDS - 1), "right")
            cuts = np.flatnonzero(np.diff(doc, prepend=-1) | (np.diff(first, prepend=first[0]) > UNIT_WORDS))
            ends = np.append(cuts[1:], len(doc))
            stretch, own = _ranges(a[cuts], z[ends - 1])
            own, stretch = own[~in_whole[own]], stretch[~in_whole[own]]
            hits = pa.StructArray.from_arrays([pa.array(key), pa.array(first, pa.int32()), pa.array(gone[z] == gone[a])], ["key", "first_word", "alive"])
            lines = pa.StructArray.from_arrays([pa.array(line[x][own], pa.int32()) for x in _LINE_FIELDS], fields=list(_LINES.value_type))
            at = pa.array(doc[cuts])
            yield pa.RecordBatch.from_arrays(
                [part["row"].take(at), part["doc_id"].take(at), pa.array(first[cuts], pa.int32()), pa.array(first[ends - 1] + UNIT_WORDS, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(np.append(cuts, len(doc)), pa.int32()), hits),
                 pa.ListArray.from_arrays(pa.array(np.searchsorted(stretch, np.arange(len(cuts) + 1)), pa.int32()), lines)],
                names=["row", "doc_id", "start", "end", "hits", "lines"])


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places to look up: where a unit whose first place is here would lie beside
    the earlier place of a unit that overlaps it."""
    for b in batches:
        for s in range(0, b.num_rows, STEP_ROWS):
            units_ = b.slice(s, STEP_ROWS)["units"]
            row, key, first_word, earlier, mine = _elements(units_, "key", "first_word", "earlier", "mine")
            place = units_.flatten().field("first")     # null where no place of the unit stays
            of, at = (pc.fill_null(place.field(x), 0).to_numpy(zero_copy_only=False) for x in ("row", "first_word"))
            order = np.lexsort((first_word, row))
            row, key, first_word, earlier, mine, of, at = (x[order] for x in (row, key, first_word, earlier, mine, of, at))
            own, ask = _place(row, first_word), np.flatnonzero(mine)
            lo, hi = np.searchsorted(own, own[ask] - UNIT_WORDS, "right"), np.searchsorted(own, own[ask] + UNIT_WORDS)
            each, beside = _ranges(lo, hi)
            i, j = ask[each][earlier[beside]], beside[earlier[beside]]
            to = at[j] + first_word[i] - first_word[j]
            i, j, to = i[to >= 0], j[to >= 0], to[to >= 0]
            order = np.lexsort((to, of[j], key[i]))
            found = np.stack([key[i], of[j], to])[:, order]
            new = np.concatenate([[True] * (len(order) > 0), (found[:, 1:] != found[:, :-1]).any(0)]).astype(bool)
            if len(order):
                yield pa.RecordBatch.from_arrays([pa.array(x[new], t) for x, t in zip(found, (pa.int64(), pa.int64(), pa.int32()))], names=["key", "row", "first_word"])


def _look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units at the asked places of each document, where all their words stay."""
    for b in batches:
        for i in range(b.num_rows):
            d = b.slice(i, 1).to_pylist()[0]
            gone = {x["paragraph"] for x in d["whole"] if x["removed"]}
            words = d["words"].split(b" ")
            spans = [(x["at"], x["at"] + x["n"]) for x in d["lines"] if x["paragraph"] in gone]
            stays = np.ones(len(words), bool)
            for x, y in spans:
                stays[x:y] = False
            places = [x for x in d["places"] if x + UNIT_WORDS <= len(words) and stays[x:x + UNIT_WORDS].all()]
            if places:
                n = len(places)
                asked, at = np.unique(np.add.outer(places, np.arange(UNIT_WORDS)), return_inverse=True)     # words of other places are not hashed
                run = unit_hashes(word_hashes([words[x] for x in asked.tolist()])[at.ravel()], UNIT_WORDS)[::UNIT_WORDS]
                yield pa.RecordBatch.from_arrays([pa.array(run.view(np.int64)), pa.array([d["doc_id"]] * n, pa.int64()),
                                                  pa.array([d["row"]] * n, pa.int64()), pa.array(places, pa.int32())], names=["key", "doc_id", "row", "first_word"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches cut where their words' fate changes and at the ends of lines."""
    for b in batches:
        for s in range(0, b.num_rows, STEP_ROWS):
            part = b.slice(s, STEP_ROWS)
            start, n = part["start"].to_numpy().astype(np.int64), (part["end"].to_numpy() - part["start"].to_numpy()).astype(np.int64)
            base, total = np.cumsum(n) - n, int(n.sum())
            row, at, earlier, mine = _elements(part["units"], "first_word", "earlier", "mine")
            at = at - start[row]

            def marked(taken: np.ndarray) -> np.ndarray:    # a place that was looked up may begin before the stretch
                of, x = row[taken], at[taken]
                return np.cumsum(np.bincount(base[of] + np.maximum(x, 0), minlength=total + 1)
                                 - np.bincount(base[of] + np.minimum(x + UNIT_WORDS, n[of]), minlength=total + 1))[:-1] > 0
            held = marked(earlier.astype(bool)) & ~marked(mine.astype(bool))
            new = np.zeros(total, bool)
            new[base] = True
            new[1:] |= held[1:] != held[:-1]
            cuts = np.flatnonzero(new)
            owner, removed = np.searchsorted(base, cuts, "right") - 1, held[cuts]
            i, j = cuts - base[owner], np.append(cuts[1:], total) - base[owner]
            # the source of a removed run: the first of the earlier places of its units
            places = part["units"].flatten().field("first").filter(pa.array(earlier))
            key = [pc.fill_null(places.field(x), 0).to_numpy(zero_copy_only=False) for x in ("first_word", "row", "doc_id")]
            ranked = np.lexsort((*key, places.field("no_id").to_numpy(zero_copy_only=False).astype(bool)))
            rank = np.empty(len(ranked), np.int64)
            rank[ranked] = np.arange(len(ranked))
            own = _place(row[earlier], at[earlier])
            order = np.argsort(own)
            lo, hi = np.searchsorted(own[order], _place(owner, i - UNIT_WORDS), "right"), np.searchsorted(own[order], _place(owner, j))
            run, unit = _ranges(lo, np.where(removed, hi, lo))
            least = np.full(len(cuts), len(ranked))
            np.minimum.at(least, run, rank[order[unit]])
            source = owner.copy()
            source[removed] = len(n) + ranked[least[removed]]
            source = pa.concat_arrays([part["doc_id"], places.field("doc_id")]).take(pa.array(source))
            # lines of each run
            of, *line = _elements(part["lines"], *_LINE_FIELDS)
            order = np.lexsort((line[_LINE_FIELDS.index("at")], of))
            of, line = of[order], {x: y[order].astype(np.int64) for x, y in zip(_LINE_FIELDS, line)}
            a, z, ends = start[owner] + i, start[owner] + j, line["at"] + line["n"]
            run, x = _ranges(np.searchsorted(_place(of, ends), _place(owner, a), "right"), np.searchsorted(_place(of, line["at"]), _place(owner, z)))
            a, z = np.maximum(a[run], line["at"][x]), np.minimum(z[run], ends[x])
            each = pa.array(owner[run])
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"].take(each), *(pa.array(y, pa.int32()) for y in (line["paragraph"][x], line["start"][x], line["end"][x], a - line["at"][x], z - a)),
                 pc.binary_join_element_wise("p", part["root"].cast(pa.string()), "").take(each), part["copies"].take(each), source.take(pa.array(run)), pa.array(removed[run])],
                names=["doc_id", "paragraph", "start", "end", "first_word", "n_words", "class_id", "copies", "first_doc", "removed"])


def _passages(units_: DataFrame, documents: DataFrame, whole: DataFrame, texts: DataFrame) -> DataFrame:
    """Runs of words that lie in units repeated in other rows, a row for each line,
    without the lines that are ``whole(row, paragraph, removed)``.  The words of
    the documents that are looked up come from ``texts`` again."""
    keys = units_.groupBy("key").agg(F.min("row").alias("row0"), F.max("row").alias("row1")).where("row0 <> row1").select("key")
    keys = written(keys, "paragraph-units")   # so that the join deals out both sides anew and splits a hot unit
    hits = units_.join(keys, "key").select("row", F.struct("key", "first_word").alias("hit"))
    taken = whole.select("row", F.struct("paragraph", "removed").alias("whole"))
    parts = hits.unionByName(documents.drop("key"), True).unionByName(taken, True)
    per = parts.groupBy("row").agg(F.first("doc_id", True).alias("doc_id"), F.collect_list("hit").alias("hits"), F.first("lines", True).alias("lines"),
                                   F.collect_list("whole").alias("whole")).where(F.size("hits") > 0)   # a document's own units and lines
    stretches = written(per.mapInArrow(_stretches, _STRETCHES).withColumn("id", F.monotonically_increasing_id()), "paragraph-stretches", "zstd")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "first_word")
    each = stretches.select("id", "row", "doc_id", F.explode("hits").alias("h"))\
        .select("id", "row", "doc_id", F.col("h.key").alias("key"), F.col("h.first_word").alias("first_word"), F.col("h.alive").alias("alive"))
    firsts = written(each.groupBy("key").agg(F.min("id").alias("id0"), F.min(F.when(F.col("alive"), place)).alias("first")), "paragraph-firsts")
    each = written(each.join(firsts, "key").select("id", "id0", "key", "first_word", place.alias("place"), "first"), "paragraph-hits", "zstd")
    groups = connected_components(each.select(F.col("id").alias("u"), F.col("id0").alias("v")))
    root = groups.select(F.col("node").alias("id"), "root")
    sized = written(stretches.select("id").join(root, "id", "left").select("id", F.coalesce("root", "id").alias("root")), "paragraph-roots")
    sized = sized.join(sized.groupBy("root").agg(F.count(F.lit(1)).alias("copies")), "root")

    def of_stretches(hits: DataFrame, *more: str) -> DataFrame:
        unit = F.struct("first_word", "first", F.coalesce(F.col("first") < F.col("place"), F.lit(False)).alias("earlier"),
                        F.col("first").eqNullSafe(F.col("place")).alias("mine"), *more)
        return hits.groupBy("id").agg(F.collect_list(unit).alias("units"))   # a stretch's own units
    asked = written(of_stretches(each, "key").mapInArrow(_beside, "key bigint, row bigint, first_word int").distinct(), "paragraph-asked")
    asked_of = asked.select("row").distinct()
    places = asked.select("row", "first_word").distinct().withColumnRenamed("first_word", "place")
    asked_docs = written(documents.join(asked_of, "row", "left_semi"), "paragraph-asked-documents", "zstd")
    said = maybe_in(texts.mapInArrow(_sequences, "key binary, words binary"), asked_docs, "key").groupBy("key").agg(F.first("words").alias("words"))
    ask = asked_docs.drop("key").unionByName(places, True).unionByName(taken.join(asked_of, "row", "left_semi"), True)\
        .unionByName(asked_docs.select("row", "key").join(said, "key").select("row", "words"), True)
    ask = ask.groupBy("row").agg(F.first("doc_id", True).alias("doc_id"), F.first("words", True).alias("words"), F.first("lines", True).alias("lines"),
                                 F.collect_list("place").alias("places"), F.collect_list("whole").alias("whole"))
    there = ask.mapInArrow(_look, "key bigint, doc_id bigint, row bigint, first_word int").join(asked, ["key", "row", "first_word"])
    better = there.groupBy("key").agg(F.min(place).alias("better")).join(firsts, "key").where(F.col("better") < F.col("first")).select("key", "better")
    better = checkpointed(better)
    each = each.join(better, "key", "left").withColumn("first", F.coalesce("better", "first")).select("id", "first_word", "place", "first")
    found = better.join(stretches.select("id", F.col("row").alias("better_row"), "start", "end"), F.col("better.row") == F.col("better_row"))\
        .where((F.col("start") < F.col("better.first_word") + UNIT_WORDS) & (F.col("end") > F.col("better.first_word")))
    each = each.unionByName(found.select("id", F.col("better.first_word").alias("first_word"), F.col("better").alias("place"), F.col("better").alias("first")))
    lined = stretches.where(F.size("lines") > 0).select("id", "doc_id", "start", "end", "lines")
    return lined.join(of_stretches(each), "id").join(sized, "id").mapInArrow(_runs, _RUNS)


def distinct_keys(every: DataFrame) -> DataFrame:
    """One row for each key of ``every(key, row)``: its copies, first and last row.
    Plain numbers only, so that the aggregation hashes and does not sort all lines."""
    return every.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("row").alias("row0"), F.max("row").alias("row1"))


def repeated_paragraphs(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One row for each paragraph that repeats (equal or, from ``near_words`` words
    on, near-equal) in another document, and for each line's part of a passage
    that does:
    ``doc_id, paragraph, start, end`` (line number and its character span),
    ``first_word, n_words`` (the repeated words of the line), ``class_id``,
    ``copies`` of the paragraph or passage, ``first_doc`` (of the place that is
    kept) and ``removed``.  Of a class of paragraphs the first one by doc_id,
    row and line stays; of each unit of a passage the first place stays whose
    words are in no removed paragraph.

    Null and empty texts have no paragraphs.  Rows are told apart, so two rows
    with one doc_id are two documents.  Paragraphs that repeat only within one
    document, and documents without a repeated paragraph, have no row.  Only
    doc_id and text are read; an empty table gives an empty result."""
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        return _repeated(docs, min_words, near_words, similarity)


def _repeated(docs: DataFrame, min_words: int, near_words: int, similarity: float) -> DataFrame:
    """The result, all its Python passes written already: the callers' batches are not bounded."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    texts, least = docs.select("text"), max(min_words, near_words, SHINGLE_WORDS)
    cut = written(rows.mapInArrow(_cut(min_words), _PLACES), "paragraphs", "zstd")
    every = cut.where(F.col("kind") == PARAGRAPH).select("row", "doc_id", "paragraph", "start", "end", "n_words", "key")
    # numbered in the order of their keys, so that the numbers do not follow the order in which rows arrive
    distinct = written(distinct_keys(every).sortWithinPartitions("key").withColumn("id", F.monotonically_increasing_id()), "paragraph-keys", "zstd")
    # bands of the texts again, so that neither copies nor the written tables carry them
    banded = texts.mapInArrow(_bands(least), "key binary, bands array<bigint>").groupBy("key").agg(F.first("bands").alias("bands"))\
        .join(distinct.select("key", "id", "copies"), "key")

    def bodies_of(ids: DataFrame) -> DataFrame:
        keys = written(distinct.select("id", "key").join(ids, "id", "left_semi"), "paragraph-wanted")
        lines = maybe_in(texts.mapInArrow(_bodies(least), "key binary, body string"), keys, "key")
        return lines.join(keys, "key").groupBy("id").agg(F.first("body").alias("body"))
    groups = paragraph_links(banded.select("id", "bands", "copies"), bodies_of, similarity)
    keyed = distinct.join(groups.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    classes = keyed.groupBy("root").agg(F.sum("copies").alias("copies"), F.min("row0").alias("row0"), F.max("row1").alias("row1"))\
        .where("row0 <> row1").drop("row0", "row1")
    member = keyed.select("key", "root").join(classes, "root")
    found = written(every.join(member, "key").drop("key"), "paragraph-members", "zstd")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "paragraph")
    first = written(found.groupBy("root").agg(F.min(place).alias("first")), "paragraph-first")    # so that a large class is split in the join
    found = written(found.join(first, "root"), "paragraph-classes", "zstd")
    gone = (F.col("row") != F.col("first.row")) | (F.col("paragraph") != F.col("first.paragraph"))
    whole = found.select("doc_id", "paragraph", "start", "end", F.lit(0).alias("first_word"), "n_words", F.concat(F.lit("c"), F.col("root").cast("string")).alias("class_id"),
                         "copies", F.col("first.doc_id").alias("first_doc"), gone.alias("removed"))
    inner = _passages(cut.where(F.col("kind") == UNIT).select(F.col("unit").alias("key"), "row", "first_word"),
                      cut.where(F.col("kind") == DOCUMENT).select("row", "doc_id", "lines", "key"), found.select("row", "paragraph", gone.alias("removed")), texts)
    return whole.unionByName(written(inner, "paragraph-runs", "zstd"))
