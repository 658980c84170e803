"""Token ids in binary shards with Elias-Fano document boundaries.

Documents are range-partitioned by id, so shard k holds ids below shard k + 1
and a shard is written by one task as it streams through its rows.  A shard is
two files: ``.ids`` (ids concatenated, little-endian, 16 bit where the
vocabulary allows) and ``.ef`` (Elias-Fano coded boundaries and document ids,
with sampled select).  A task writes under its attempt's name and renames at
the end, so a lost executor leaves no half shard.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadlens.llm.common import arrow_rows, parts_of, text_steps
from loadlens.session import scratch_dir

END_ID = 2
BATCH_ROWS = 1_000       # rows of an Arrow batch
SAMPLE = 512            # entries between two sampled select positions
CACHE_PIECES = 150_000  # pieces whose ids a worker remembers (affects time only)


class EliasFano:
    """A non-decreasing sequence of non-negative integers: the low bits of each
    packed side by side, the high bits in unary.  ``select`` finds the i-th one
    of the unary part from a sampled position, so no plain table of
    offsets exists."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, sample: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.sample = n, low_bits, low, high, sample

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        if not n:
            return cls(0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, "<u4"))
        bits = max(0, (int(v[-1]) // n).bit_length() - 1)
        shifts = np.arange(bits, dtype=np.uint64)
        low = np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little") if bits else np.zeros(0, np.uint8)
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1, np.uint8)
        unary[ones] = 1
        high = np.packbits(unary, bitorder="little")
        return cls(n, bits, low, high, ones[::SAMPLE].astype("<u4"))

    def _highs(self, i: int, j: int) -> np.ndarray:
        """High parts of entries i..j-1, decoding only the bytes that hold them."""
        rank = i // SAMPLE * SAMPLE
        first = int(self.sample[i // SAMPLE])
        after = (j - 1) // SAMPLE + 1
        end = int(self.sample[after]) // 8 + 1 if after < len(self.sample) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[first // 8:end], bitorder="little")) + first // 8 * 8
        ones = ones[np.searchsorted(ones, first):]
        return ones[i - rank:j - rank] - np.arange(i, j)

    def decode(self, i: int, j: int) -> np.ndarray:
        """Entries i..j-1."""
        if i >= j:
            return np.zeros(0, np.int64)
        out = self._highs(i, j) << self.low_bits
        if self.low_bits:
            a, b = i * self.low_bits, j * self.low_bits
            bits = np.unpackbits(self.low[a // 8:(b + 7) // 8], bitorder="little")[a % 8:a % 8 + (b - a)]
            out = out | (bits.reshape(-1, self.low_bits).astype(np.int64) << np.arange(self.low_bits)).sum(1)
        return out

    def select(self, i: int) -> int:
        return int(self.decode(i, i + 1)[0])

    def parts(self) -> list[np.ndarray]:
        return [self.low, self.high, self.sample.view(np.uint8)]


# ---- encoding -------------------------------------------------------------

#: The normaliser and pieces for which words can be encoded alone.
_STEPS = ["NFC", "Replace", "Lowercase"]
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters up to U+00FF, then ASCII signs: one piece of each.
_SIMPLE = r"^(?P<head>[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]*)(?P<tail>[!-/:-@\[-`{-~]*)$"


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet as a translation of characters up to U+00FF: a
    character's UTF-8 bytes, printable ones as they are, the others as the
    characters from U+0100 on in byte order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}


class WordEncoder:
    """Whole texts to ids with the ``tokenizers`` library.

    Its normaliser turns white space into one space and no piece crosses a
    space, so a text's ids are its words' ids in order.  The distinct words of a
    batch are found by Arrow.  A word of Latin letters and trailing signs is two
    pieces, which the library's model encodes directly and the encoder
    remembers; any other word takes the library's whole path.  Under a tokenizer
    of another make all texts do."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        steps = [x.get("type") for x in (made["normalizer"] or {}).get("normalizers", [])]
        cuts = (made["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.by_word = steps == _STEPS and cuts[0].get("pattern") == {"Regex": _PIECES}
        self.letters, self.known = _byte_letters(), {"": []}

    def _pieces(self, pieces: list[str]) -> list[list[int]]:
        if len(self.known) > CACHE_PIECES:
            self.known = {"": []}
        known, tokenize = self.known, self.tokenizer.model.tokenize
        out = list(map(known.get, pieces))
        for i, ids in enumerate(out):
            if ids is None:
                p = pieces[i]
                out[i] = known[p] = [t.id for t in tokenize(p if p.isascii() else p.translate(self.letters))]
        return out

    def _units(self, words: pa.Array) -> tuple[list[list[int]], np.ndarray]:
        """Distinct units of ids, and the two units of each word."""
        parts = pc.extract_regex(words, _SIMPLE)
        head, tail = (pc.dictionary_encode(x) for x in (pc.utf8_lower(pc.struct_field(parts, "head")), pc.struct_field(parts, "tail")))
        units = self._pieces(head.dictionary.to_pylist() + tail.dictionary.to_pylist())
        pair = np.stack([pc.fill_null(head.indices, -1).to_numpy(), pc.fill_null(tail.indices, -1).to_numpy()], 1).astype(np.int64)
        pair[:, 1] += len(head.dictionary)
        rest = np.flatnonzero(pair[:, 0] < 0)
        units.append([])
        pair[rest] = len(units) - 1
        pair[rest, 0] = len(units) + np.arange(len(rest))
        units += [e.ids for e in self.tokenizer.encode_batch_fast(words.take(pa.array(rest)).to_pylist(), add_special_tokens=False)]
        return units, pair

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with ``end_id`` after it, and their numbers."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.by_word:
            words = pc.ascii_split_whitespace(texts)
            size = pc.list_value_length(words).to_numpy(zero_copy_only=False)
            distinct = pc.dictionary_encode(words.flatten())
            units, pair = self._units(distinct.dictionary)
            unit = pair[distinct.indices.to_numpy()].ravel()
            size = size * 2
        else:
            units = [e.ids for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            unit, size = np.arange(len(units)), np.ones(len(units), np.int64)
        length = np.fromiter(map(len, units), np.int64, len(units))
        ids = np.fromiter(chain.from_iterable(units), np.uint32, int(length.sum()))
        start, n = (np.cumsum(length) - length)[unit], length[unit]
        upto = np.concatenate([[0], np.cumsum(n)])
        ends = upto[np.cumsum(size)] + np.arange(len(size))
        out = np.full(int(upto[-1]) + len(size), end_id, np.uint32)
        word = np.ones(len(out), bool)
        word[ends] = False
        out[word] = ids[np.repeat(start - upto[:-1], n) + np.arange(upto[-1])]
        return out, np.diff(np.concatenate([[-1], ends]))


# ---- files ----------------------------------------------------------------

def _fs(uri: str):
    """File system and path of a folder that all executors share."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _write_boundaries(out, header: dict, parts: list[EliasFano]) -> None:
    arrays = [a for p in parts for a in p.parts()]
    header = header | {"ef": [[p.n, p.low_bits] for p in parts], "sizes": [a.nbytes for a in arrays]}
    raw = json.dumps(header).encode()
    out.write(len(raw).to_bytes(4, "little") + raw)
    for a in arrays:
        out.write(a.tobytes())


def read_boundaries(raw: bytes) -> tuple[dict, EliasFano, EliasFano]:
    """Header, boundary sequence (n + 1 entries) and id sequence of a shard."""
    size = int.from_bytes(raw[:4], "little")
    header, at, arrays = json.loads(raw[4:4 + size]), 4 + size, []
    for n in header["sizes"]:
        arrays.append(np.frombuffer(raw, np.uint8, n, at))
        at += n
    a, b = (EliasFano(n, bits, *arrays[3 * i:3 * i + 2], arrays[3 * i + 2].view("<u4")) for i, (n, bits) in enumerate(header["ef"]))
    return header, a, b


def _write_shards(folder: str, tokenizer: str, end_id: int, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get()
        fs, root = _fs(folder)
        fs.create_dir(root, recursive=True)
        name, tmp = f"{root}/{task.partitionId():06d}", f"{root}/.{task.partitionId():06d}-{task.taskAttemptId()}"
        encoder, lengths, doc_ids, kind = None, [], [], "<u4" if wide else "<u2"
        with fs.open_output_stream(tmp + ".ids") as out:
            for b in batches:
                encoder = encoder or WordEncoder(tokenizer)
                for part in text_steps(b, 1):
                    ids, n = encoder.encode(part.column(1), end_id)
                    out.write(ids.astype(kind).tobytes())
                    lengths.append(n)
                    doc_ids.append(pa.concat_arrays([part.column(0)]).take(pa.array(np.arange(part.num_rows))))  # not the batch with its texts
                pa.default_memory_pool().release_unused()
        n = np.concatenate(lengths) if lengths else np.zeros(0, np.int64)
        known = pa.chunked_array(doc_ids, pa.int64()).drop_null().to_numpy() if doc_ids else np.zeros(0, np.int64)
        least = int(known[0]) if len(known) else 0
        with fs.open_output_stream(tmp + ".ef") as out:
            _write_boundaries(out, {"docs": len(n), "ids": int(n.sum()), "kind": kind, "null_ids": len(n) - len(known), "least_id": least},
                              [EliasFano.encode(np.concatenate([[0], np.cumsum(n)])), EliasFano.encode((known - least).astype(np.uint64))])
        for end in (".ids", ".ef"):
            fs.move(tmp + end, name + end)
        yield pa.RecordBatch.from_arrays([pa.array([task.partitionId()], pa.int32()), pa.array([name]), pa.array([len(n)], pa.int64()),
                                          pa.array([int(n.sum())], pa.int64())], names=["shard", "path", "docs", "ids"])
    return run


def write_token_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, shards: int | None = None,
                       vocabulary: int = 49_408) -> DataFrame:
    """Encode and write ``docs(doc_id, text)`` in ascending id order (null ids
    first; repeated ids ordered by text).  Returns the written manifest: a row
    for each shard with ``shard, path, docs, ids`` and ``start``, the ids of all
    shards before it.  Null and empty texts are one end id.  An empty table
    gives an empty corpus."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    shards = shards or parts_of(rows)
    rows = rows.repartitionByRange(shards, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    with arrow_rows(spark, BATCH_ROWS):
        rows.mapInArrow(_write_shards(folder, tokenizer, end_id, vocabulary > 1 << 16), "shard int, path string, docs bigint, ids bigint")\
            .write.parquet(f"{folder}/manifest")
    manifest = spark.read.parquet(f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("bigint"))


def _read_shards(folder: str, step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                fs, _ = _fs(folder)
                path = row["path"]
                with fs.open_input_stream(path + ".ef") as f:
                    header, ends, names = read_boundaries(f.read())
                width, nulls = np.dtype(header["kind"]).itemsize, header["null_ids"]
                with fs.open_input_stream(path + ".ids") as f:
                    for i in range(0, header["docs"], step):
                        j = min(i + step, header["docs"])
                        at = ends.decode(i, j + 1)
                        ids = np.frombuffer(f.read(int(at[-1] - at[0]) * width), header["kind"]).astype("<u4")
                        local = at - at[0]
                        crc = [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(local[:-1].tolist(), local[1:].tolist())]
                        known = names.decode(max(0, i - nulls), max(0, j - nulls)) + header["least_id"]
                        doc = pa.concat_arrays([pa.nulls(j - i - len(known), pa.int64()), pa.array(known, pa.int64())])
                        yield pa.RecordBatch.from_arrays([doc, pa.array(at[:-1] + row["start"]), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_token_shards(manifest: DataFrame, folder: str, step: int = 1024) -> DataFrame:
    """One row per document from the files: ``doc_id, start, n_tokens,
    ids_crc32`` (crc32 of its ids as little-endian 32-bit integers)."""
    n = max(1, manifest.count())
    return manifest.select("shard", "path", "start").repartitionById(n, F.col("shard")).mapInArrow(
        _read_shards(folder, step), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_corpus(docs: DataFrame, tokenizer: str, end_id: int = END_ID, shards: int | None = None) -> DataFrame:
    """Write ``docs`` to a fresh folder of the shared space and read them back."""
    spark: SparkSession = docs.sparkSession
    folder = scratch_dir(spark, "tokens")
    manifest = write_token_shards(docs, folder, tokenizer, end_id, shards)
    return read_token_shards(manifest, folder)
