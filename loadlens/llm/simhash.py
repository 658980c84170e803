"""SimHash near-duplicates: 64-bit fingerprints, vantage-point trees for the
exact pairs within a few bits, components of the links.

A fingerprint's distances to vantage points decide where it is compared.  Over
all 64 bits a radius of 4 straddles most medians (random fingerprints lie at
32 +- 4 bits from any point), and copying every straddler into both halves
would multiply the table.  So the 64 bits are cut into ``max_bits + 1`` blocks.
Two fingerprints within ``max_bits`` agree exactly in some block: distance
zero, so that block's vantage-point partition has no straddlers, and its
finest cells are the block's values.  Each fingerprint visits one cell per
block.  Cells above ``max_cell`` fingerprints are split again by vantage points
over all 64 bits; those within the radius of the cut are copied to the far
side (triangle bound).  Inside a cell a vantage-point tree prunes the
comparison.  Only a spanning set of links (at most one per fingerprint and
cell) leaves a cell, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import checkpointed, fresh, without, word_chunks, written
from loadlens.llm.components import connected_components

SHINGLE_WORDS, MAX_BITS, SEED = 4, 4, 42
MAX_CELL = 20_000   # fingerprints of a cell before it is split by a vantage point
LEAF = 256          # fingerprints compared directly
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BYTE_BASE = (np.arange(8, dtype=np.int64) * 256)[None, :]


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Bit b is set if set in over half the XXH64 values of the ``words``-word
    shingles of the text (A-Z lower-cased, repeats counted); a text with fewer
    words is one shingle, one without words (or null) has fingerprint zero."""
    if not text:
        return 0
    counts, n, carry, hash64 = np.zeros(2048, np.int64), 0, [], xxhash.xxh64_intdigest
    for chunk in word_chunks(text.encode("utf-8", "surrogatepass").lower()):
        w = carry + chunk
        if len(w) >= words:
            h = np.array([hash64(s, SEED) for s in map(b" ".join, zip(*(w[i:] for i in range(words))))], "<u8")
            counts += np.bincount((h.view(np.uint8).reshape(-1, 8) + _BYTE_BASE).ravel(), minlength=2048)
            n += len(h)
        carry = w[-(words - 1):] if words > 1 else []
    if not n:
        return hash64(b" ".join(carry), SEED) if carry else 0
    ones = (counts.reshape(8, 256) @ _BYTE_BITS).ravel()
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, column: str, words: int = SHINGLE_WORDS, text: str = "text") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a signed long ``column``."""
    @F.pandas_udf("bigint")
    def udf(texts):
        import pandas as pd
        return pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))
    return docs.withColumn(column, udf(F.col(text)))


# ---- links inside one cell ------------------------------------------------

def _find(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        p = parent[x]
        if np.array_equal(p, x):
            return x
        x = p


def _unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    while len(i):
        a, b = _find(parent, i), _find(parent, j)
        open_ = a != b
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def _compare(fp: np.ndarray, parent: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int) -> None:
    step = max(1, (1 << 21) // max(1, len(b)))
    for s in range(0, len(a), step):
        part = a[s:s + step]
        i, j = np.nonzero(np.bitwise_count(fp[part][:, None] ^ fp[b][None, :]) <= radius)
        _unite(parent, part[i], b[j])


def _vp_links(fp: np.ndarray, parent: np.ndarray, at: np.ndarray, radius: int, leaf: int) -> None:
    """Link all of ``at`` within ``radius``: a vantage-point tree walked against
    itself; shells further apart than the radius are never compared."""
    todo = [at]
    while todo:
        at = todo.pop()
        if len(at) <= leaf:
            _compare(fp, parent, at, at, radius)
            continue
        d = np.bitwise_count(fp[at] ^ fp[at[len(at) // 2]]).astype(np.int64)
        cut = int(np.median(d))
        inside, outside = at[d <= cut], at[d > cut]
        if not len(outside):  # all within one ball around the median: compare shell by shell
            shells = [at[d == k] for k in range(cut + 1)]
            for k, s in enumerate(shells):
                for t in shells[k:k + radius + 1]:
                    _compare(fp, parent, s, t, radius)
            continue
        d_in, d_out = d[d <= cut], d[d > cut]
        for k in range(max(0, cut - radius + 1), cut + 1):  # across the cut: |d - d'| <= radius
            near = inside[d_in == k]
            if len(near):
                _compare(fp, parent, near, outside[d_out <= k + radius], radius)
        todo += [inside, outside]


def cell_links(fp: np.ndarray, radius: int = MAX_BITS, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the distinct fingerprints of one cell: (fp, root)."""
    parent = np.arange(len(fp))
    _vp_links(fp, parent, np.arange(len(fp)), radius, leaf)
    root = _find(parent, np.arange(len(fp)))
    far = root != np.arange(len(fp))
    return fp[far], fp[root[far]]


def _links_of_sorted(radius: int, leaf: int):
    """Arrow batches sorted by cell -> spanning links; a cell may cross batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(pairs):
            u = np.concatenate([p[0] for p in pairs]).view(np.int64)
            v = np.concatenate([p[1] for p in pairs]).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        cell, held, found = None, [], []
        for b in batches:
            key, fp = b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            cuts = [0] + [i for i in range(1, len(key)) if key[i] != key[i - 1]] + [len(key)]
            for s, e in zip(cuts, cuts[1:]):
                if s == e:
                    continue
                if key[s] != cell:
                    if sum(map(len, held)) > 1:
                        found.append(cell_links(np.concatenate(held), radius, leaf))
                    cell, held = key[s], []
                held.append(fp[s:e])
            if sum(len(p[0]) for p in found) > 10_000:
                yield out(found)
                found = []
        if sum(map(len, held)) > 1:
            found.append(cell_links(np.concatenate(held), radius, leaf))
        if found:
            yield out(found)
    return run


def _split_cells(cells: DataFrame, radius: int, max_cell: int) -> DataFrame:
    """Split cells above ``max_cell`` at the median distance from a vantage
    point.  The far side also gets those of the near side within the radius of
    the cut, so each pair within the radius meets on one side at least.  A cell
    that a cut cannot shrink (all in one small ball) stays as it is."""
    done = []
    while True:
        sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min_by("fp", F.xxhash64("fp", "cell")).alias("vp"))
        big = checkpointed(sizes.where(F.col("n") > max_cell))
        if not big.take(1):
            break
        seen = cells.join(big, "cell").withColumn("d", F.bit_count(F.col("fp").bitwiseXOR(F.col("vp"))))
        hist = seen.groupBy("cell", "n", "d").agg(F.count(F.lit(1)).alias("c"))
        per = hist.groupBy("cell", "n").agg(F.sort_array(F.collect_list(F.struct("d", "c"))).alias("h"))  # 65 entries at most
        cut = per.select("cell", "n", "h", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("cut")).select(
            "cell", "n", "cut",
            F.expr("aggregate(filter(h, x -> x.d <= cut), 0L, (a, x) -> a + x.c)").alias("near"),
            F.expr(f"aggregate(filter(h, x -> x.d > cut - {radius}), 0L, (a, x) -> a + x.c)").alias("far"))
        best = cut.groupBy("cell").agg(F.min_by(F.struct("cut", "near", "far", "n"),
                                               F.struct(F.greatest("near", "far"), F.col("cut"))).alias("b"))\
            .where("greatest(b.near, b.far) < 0.9 * b.n").select("cell", F.col("b.cut").alias("cut"))
        best = checkpointed(best)
        if not best.take(1):
            break
        done.append(cells.join(best, "cell", "left_anti"))
        cut_rows = cells.join(big.select("cell", "vp"), "cell").join(best, "cell")\
            .withColumn("d", F.bit_count(F.col("fp").bitwiseXOR(F.col("vp"))))
        sides = F.filter(F.array(F.when(F.col("d") <= F.col("cut"), F.concat("cell", F.lit("/n"))),
                                 F.when(F.col("d") > F.col("cut") - radius, F.concat("cell", F.lit("/f")))),
                         lambda s: s.isNotNull())
        cells = written(cut_rows.select(F.explode(sides).alias("cell"), "fp"), "simhash-cells")
    for d in done:
        cells = cells.unionByName(d)
    return cells


def link_components(fps: DataFrame, radius: int = MAX_BITS, max_cell: int = MAX_CELL, leaf: int = LEAF) -> DataFrame:
    """Distinct fingerprints ``fp`` -> ``(node, root)`` for each fingerprint with
    another one within ``radius`` bits, by exact comparison."""
    width = 64 // (radius + 1)
    # the first blocks take one bit more where 64 does not divide
    extra, cuts, at = 64 - width * (radius + 1), [], 0
    for b in range(radius + 1):
        w = width + (1 if b < extra else 0)
        cuts.append((at, w))
        at += w
    keys = [F.concat(F.lit(f"{b}:"), F.hex(F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1))))
            for b, (s, w) in enumerate(cuts)]
    cells = fps.select("fp", F.explode(F.array(*keys)).alias("cell")).select("cell", "fp")
    cells = _split_cells(cells, radius, max_cell)
    links = cells.repartition("cell").sortWithinPartitions("cell", "fp")\
        .mapInArrow(_links_of_sorted(radius, leaf), "u bigint, v bigint")
    return connected_components(links)


def _members(fps: DataFrame, max_bits: int, max_cell: int, leaf: int) -> DataFrame:
    """``(_fp, root, component_id)`` for each distinct fingerprint of ``fps``."""
    per = checkpointed(fps.groupBy("fp").agg(F.min("doc_id").alias("first")))
    links = link_components(per.select("fp"), max_bits, max_cell, leaf)
    member = per.join(links.withColumnRenamed("node", "fp"), "fp", "left")\
        .select("fp", F.coalesce("root", "fp").alias("root"), "first")
    least = member.groupBy("root").agg(F.min("first").alias("component_id"))
    return member.join(least, "root").select(F.col("fp").alias("_fp"), "root", "component_id")


def simhash_groups(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                   max_cell: int = MAX_CELL, leaf: int = LEAF) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits),
    ``component_id`` (least non-null doc_id reachable over links of at most
    ``max_bits`` differing bits, itself included; null only where no row of the
    component has an id).

    Null, empty and blank texts have fingerprint zero and link like any other.
    Repeated rows stay, each with its row.  Other columns are not read, an
    empty table gives an empty result."""
    fps = written(with_fingerprint(docs.select("doc_id", "text"), "fp", words).select("doc_id", "fp"), "simhash")
    member = _members(fps, max_bits, max_cell, leaf)
    return fps.join(member, fps["fp"] == member["_fp"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_per_group(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the one of least doc_id (null last;
    of several fingerprints of that id the least; of equal rows one).  All
    columns stay."""
    fps = written(with_fingerprint(docs.select("doc_id", "text"), "fp", words).select("doc_id", "fp"), "simhash")
    member = _members(fps, max_bits, MAX_CELL, LEAF)
    rows = checkpointed(fps.join(member, fps["fp"] == member["_fp"]).groupBy("root", "doc_id", "fp").agg(F.count(F.lit(1)).alias("n")))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")
    best = rows.groupBy("root").agg(F.min(order).alias("k"))
    kept = F.col("doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("fp") == F.col("k.fp"))
    rows = checkpointed(rows.join(best, "root").select("doc_id", "fp", "n", kept.alias("kept")))
    fp = fresh(docs, "simhash_fp")
    # the fingerprints again, rather than a second copy of all texts
    left = without(with_fingerprint(docs, fp, words), rows.where("not kept").select("doc_id", F.col("fp").alias("_fp")), {"doc_id": "doc_id", fp: "_fp"})
    again = rows.where("kept and n > 1").select("doc_id", F.col("fp").alias("_fp"))
    if not again.take(1):
        return left.drop(fp)
    once = without(left, again, {"doc_id": "doc_id", fp: "_fp"})
    twice = left.join(again, left["doc_id"].eqNullSafe(again["doc_id"]) & (left[fp] == again["_fp"]), "left_semi").dropDuplicates(["doc_id", fp])
    return once.unionAll(twice).drop(fp)
