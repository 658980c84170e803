"""Merkle manifest of a dataset: a SHA-256 tree whose parents keep hash states.

A leaf digests a row's fields; leaves of a language in id order are digested in
runs of eight, level by level, to a subroot, and subroots likewise to the root.
A parent's hash is fed child by child, and a copy of its state before each child
slot is retained.  Folding a changed leaf resumes the state before its slot and
feeds only the replacement and the siblings to its right, at each level up to the
root.

The tree is built in blocks of ``FAN ** HEIGHT`` leaves.  A block is one row of
digests; its top digest is an item of the next layer of blocks, until each
language has one.  Going down again, every block gets the path above it (at most
seven siblings a level) and proves its own leaves, so no task holds more than a
few blocks, however many rows a language has.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.llm.common import MAX_BROADCAST_ROWS, arrow_rows, join_small, parts_of, text_steps, written

FAN = 8                 # children of a node
HEIGHT = 3              # levels of a block: 512 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 3        # rows whose id's crc32 it divides are tampered with
BATCH_ROWS = 1_000      # rows with whole texts in an Arrow batch
BATCH_BLOCKS = 16       # blocks in an Arrow batch

Step = tuple[list[str], list[str]]      # siblings left and right of a slot, as hex


def _field(raw: bytes | None) -> bytes:
    return b"-" if raw is None else b"%d:%s" % (len(raw), raw)


def leaf_digests(values: Sequence[bytes | None], change: bool) -> tuple[str, str | None]:
    """Digest of a row's fields, the text last, and that of the row with the text's
    A-Z lower-cased if ``change``.  Both resume the state before the text."""
    text = values[-1]
    state = hashlib.sha256(b"".join(map(_field, values[:-1])))
    state.update(b"-" if text is None else b"%d:" % len(text))
    whole = state.copy()
    whole.update(text or b"")
    if not change:
        return whole.hexdigest(), None
    state.update((text or b"").lower())          # bytes: A-Z only
    return whole.hexdigest(), state.hexdigest()


class Node:
    """A parent: its digest, and the hash states retained before each child slot."""

    def __init__(self, children: Sequence[str]):
        self.children, self.states = children, []
        state = hashlib.sha256()
        for c in children:
            self.states.append(state.copy())
            state.update(c.encode())
        self.digest = state.hexdigest()

    def fold(self, slot: int, replacement: str) -> str:
        """The digest with another child at ``slot``: that state, resumed."""
        state = self.states[slot].copy()
        state.update((replacement + "".join(self.children[slot + 1:])).encode())
        return state.hexdigest()


def grow(digests: Sequence[str], height: int, alone: bool) -> tuple[list[list[Node]], list[str]]:
    """Levels of parents over a block's ``digests``, bottom up, and the digest on
    top.  A block that is its whole tree (``alone``) ends at one node; another has
    ``height`` levels, since its tree goes on above."""
    levels: list[list[Node]] = []
    top = list(digests)
    while len(levels) < height and (len(top) > 1 or not alone):
        nodes = [Node(top[i:i + FAN]) for i in range(0, len(top), FAN)]
        levels.append(nodes)
        top = [n.digest for n in nodes]
    return levels, top


class Path:
    """The way from a block's top to the root: a state before the slot at each
    level, made once for all leaves below."""

    def __init__(self, steps: Sequence[Step]):
        self.siblings = "".join("".join(left) + "".join(right) for left, right in steps)
        self.steps = [(hashlib.sha256("".join(left).encode()), "".join(right).encode()) for left, right in steps]

    def fold(self, digest: str) -> str:
        for before, right in self.steps:
            state = before.copy()
            state.update(digest.encode() + right)
            digest = state.hexdigest()
        return digest


def _children_steps(nodes: Sequence[Node], steps: Sequence[list[Step]]) -> list[list[Step]]:
    """The steps up from each child of ``nodes``, given those from the nodes."""
    return [[(list(n.children[:i]), list(n.children[i + 1:])), *up] for n, up in zip(nodes, steps) for i in range(len(n.children))]


def leaves(docs: DataFrame, fields: Sequence[str] = FIELDS, every: int = TAMPER_EVERY) -> DataFrame:
    """``doc_id, lang, leaf, tampered`` of each row (``tampered`` null where the
    row is not tampered with).  ``fields`` end with the text."""
    def raw(column: pa.Array) -> list[bytes | None]:
        return column.cast(pa.binary()).to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in text_steps(batch, batch.num_columns - 1):
                change = [zlib.crc32(i or b"") % every == 0 for i in raw(b.column(2))]
                pairs = [leaf_digests(v, c) for v, c in zip(zip(*[raw(b.column(i)) for i in range(3, b.num_columns)]), change)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1)]],
                                                 names=["doc_id", "lang", "leaf", "tampered"])
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("string").alias("id_text"),
                       *[F.col(c).cast("string").alias(f"f{i}") for i, c in enumerate(fields)])
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        return written(rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang string, leaf string, tampered string"), "leaves")


def numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows (read from files) with ``pos``, their place among those of equal
    ``keys`` by ``order`` (nulls first), and ``size``, the number of those.  Rows
    are dealt to ranges of keys and order, so a key may span any number of tasks;
    the rows of earlier ranges are summed over a table of ranges."""
    by = [F.col(c).asc_nulls_first() for c in (*keys, *order)]
    shift = 1 << 33                                     # monotonically_increasing_id: partition and row
    dealt = written(rows.repartitionByRange(parts_of(rows), *by).sortWithinPartitions(*by)
                    .withColumn("range", F.spark_partition_id()).withColumn("no", F.monotonically_increasing_id() % F.lit(shift)), "numbered")
    whole = Window.partitionBy(*keys)                   # a row for each range of a key
    per = dealt.groupBy(*keys, "range").agg(F.min("no").alias("first"), F.count(F.lit(1)).alias("n"))
    per = written(per.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("range").alias("_range"), "first",
                             F.coalesce(F.sum("n").over(whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                             F.sum("n").over(whole).alias("size")), "ranges")
    same = F.col("range") == F.col("_range")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return dealt.join(F.broadcast(per) if per.count() <= MAX_BROADCAST_ROWS else per, same)\
        .select(*rows.columns, (F.col("no") - F.col("first") + F.col("before")).alias("pos"), "size")


def _blocks(items: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """``items(tree, pos, size, digest, payload...)`` as one row per block of at
    most ``FAN ** HEIGHT``: ``tree, block, alone`` (the block is its whole tree)
    and its ``items`` in order, written."""
    span = FAN ** HEIGHT
    return written(items.groupBy("tree", F.floor(F.col("pos") / F.lit(span)).cast("bigint").alias("block")).agg(
        (F.max("size") <= span).alias("alone"), F.sort_array(F.collect_list(F.struct("pos", "digest", *payload))).alias("items")), "blocks")


_PATH = "array<struct<left: array<string>, right: array<string>>>"
_ARROW_PATH = pa.list_(pa.struct([("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))]))


def _tops(blocks: DataFrame) -> DataFrame:
    """``tree, block, alone, top``: the digest on top of each block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tops = [grow(d, HEIGHT, alone)[1][0] for alone, d in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(tops, pa.string())], names=["tree", "block", "alone", "top"])
    with arrow_rows(blocks.sparkSession, BATCH_BLOCKS):
        return written(blocks.select("tree", "block", "alone", F.col("items.digest").alias("digests"))
                       .mapInArrow(run, "tree bigint, block bigint, alone boolean, top string"), "tops")


def _above(blocks: DataFrame) -> DataFrame:
    """``tree, block, root, path`` of each block: its tree's root and the way there."""
    tops = _tops(blocks)
    alone = tops.where("alone").select("tree", "block", F.col("top").alias("root"), F.lit([]).cast(_PATH).alias("path"))
    layer = tops.where("not alone")
    if not layer.take(1):
        return alone
    sizes = layer.groupBy("tree").agg(F.count(F.lit(1)).alias("size"))
    items = join_small(layer.select("tree", F.col("block").alias("pos"), F.col("top").alias("digest")), sizes, ["tree"])
    return alone.unionByName(tree_paths(items).withColumnRenamed("pos", "block"))


def tree_paths(items: DataFrame) -> DataFrame:
    """For ``items(tree, pos, size, digest)`` of any number of trees, ``pos`` from 0
    to ``size`` - 1: ``tree, pos, root, path``, the path being the siblings left and
    right at each level up to the tree's root."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                levels, top = grow(r["digests"], HEIGHT, r["alone"])
                steps = [[(s["left"], s["right"]) for s in r["path"]]] * len(top)
                for nodes in reversed(levels):
                    steps = _children_steps(nodes, steps)
                n = len(r["places"])
                yield pa.RecordBatch.from_arrays([pa.array([r["tree"]] * n, pa.int64()), pa.array(r["places"], pa.int64()), pa.array([r["root"]] * n, pa.string()), pa.array(
                    [[{"left": x, "right": y} for x, y in s] for s in steps], _ARROW_PATH)], names=["tree", "pos", "root", "path"])
    blocks = _blocks(items)
    packed = join_small(blocks, written(_above(blocks), "above"), ["tree", "block"])\
        .select("tree", "alone", F.col("items.digest").alias("digests"), F.col("items.pos").alias("places"), "root", "path")
    with arrow_rows(items.sparkSession, BATCH_BLOCKS):
        return written(packed.mapInArrow(run, f"tree bigint, pos bigint, root string, path {_PATH}"), "paths")


def _prove(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                digests, root = r["digests"], r["root"]
                levels, top = grow(digests, HEIGHT, r["alone"])
                path = Path([(s["left"], s["right"]) for s in r["path"]])
                tails = [path.siblings] * len(top)                # siblings from a node up to the root
                for nodes in reversed(levels):
                    tails = ["".join(n.children[:i]) + "".join(n.children[i + 1:]) + t for n, t in zip(nodes, tails) for i in range(len(n.children))]
                folded = []
                for i, (digest, changed) in enumerate(zip(digests, r["tampered"])):
                    digest, place = changed or digest, i
                    for nodes in levels:
                        digest, place = nodes[place // FAN].fold(place % FAN, digest), place // FAN
                    folded.append(path.fold(digest))
                n = len(digests)
                proofs = [hashlib.sha256(t.encode()).hexdigest() for t in tails]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["ids"], id_type), pa.array(digests), pa.array([r["subroot"]] * n), pa.array([root] * n), pa.array(proofs), pa.array(folded),
                     pa.array([f == root for f in folded])], names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
    return run


def merkle_manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, every: int = TAMPER_EVERY) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified``.

    Null fields are digested as ``-``, empty ones as ``0:``; a null language is a
    tree of its own, the first.  Leaves ascend by id, null ids first and repeated
    ids by leaf; a null id counts as the empty text when rows are chosen for
    tampering, and equal rows get the same results but for their places.  An empty
    table gives no row.  A text without A-Z is unchanged by tampering, so it still
    verifies.  Other columns are not read."""
    spark = docs.sparkSession
    rows = leaves(docs, fields, every)
    langs = written(rows.select("lang").distinct(), "langs")
    trees = numbered(langs, [], ["lang"]).select(F.col("lang").alias("_lang"), F.col("pos").alias("tree"), F.col("size").alias("trees"))
    trees = written(trees, "trees")
    few = trees.count() <= MAX_BROADCAST_ROWS
    items = numbered(rows, ["lang"], ["doc_id", "leaf"]).join(F.broadcast(trees) if few else trees, F.col("lang").eqNullSafe(F.col("_lang")))\
        .withColumnRenamed("leaf", "digest")
    blocks = _blocks(items, ["doc_id", "tampered"])
    above = written(_above(blocks).select("tree", "block", F.col("root").alias("subroot"), F.col("path").alias("inner_path")), "above")
    subroots = above.where("block = 0").join(trees.select("tree", "trees"), "tree")\
        .select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"), F.col("trees").alias("size"), F.col("subroot").alias("digest"))
    tree_of = tree_paths(subroots).select(F.col("pos").alias("tree"), "root", F.col("path").alias("outer_path"))
    way = join_small(above, tree_of, ["tree"]).select("tree", "block", "subroot", "root", F.concat("inner_path", "outer_path").alias("path"))
    packed = join_small(blocks, written(way, "way"), ["tree", "block"])\
        .select("alone", F.col("items.digest").alias("digests"), F.col("items.doc_id").alias("ids"), F.col("items.tampered").alias("tampered"), "subroot", "root", "path")
    kind = rows.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    with arrow_rows(spark, BATCH_BLOCKS):
        return written(packed.mapInArrow(_prove(to_arrow_type(kind)), f"doc_id {kind.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, "
                                         "folded_root string, verified boolean"), "manifest")
