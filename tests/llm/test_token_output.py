"""Token shards against the library on whole texts, and Elias-Fano round trips."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loadlens.llm.common import BATCH_BYTES, arrow_rows
from loadlens.llm.queries import tokenizer_path
from loadlens.llm.token_output import SAMPLE, EliasFano, token_corpus


@pytest.mark.parametrize("values", [[0], [0, 0, 0], [5], list(range(0, 4000, 3)), [0] * 1300 + [10 ** 9] * 700,
                                    sorted(np.random.default_rng(1).integers(0, 10 ** 7, 5000).tolist()), [0] + [1] * (3 * SAMPLE)])
def test_elias_fano_round_trip(values):
    ef = EliasFano.encode(np.array(values))
    assert ef.decode(0, len(values)).tolist() == values
    for i in range(0, len(values), 7):
        assert ef.select(i) == values[i]
    assert ef.decode(len(values) // 2, len(values)).tolist() == values[len(values) // 2:]
    bits = 8 * sum(p.nbytes for p in (ef.low, ef.high))
    assert bits <= len(values) * (3 + max(0, np.log2(max(values) / len(values) + 1))) + 16


def brute(rows):
    tok = Tokenizer.from_file(tokenizer_path())
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at, out = 0, []
    for doc_id, text, *_ in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


def test_whole_table(spark, documents):
    docs = spark.createDataFrame(documents, "doc_id bigint, text string, lang string, source string").repartition(3)
    assert result(token_corpus(docs, tokenizer_path(), shards=5)) == brute(documents)


def test_edges(edge_docs, edge_rows, no_docs):
    assert result(token_corpus(edge_docs, tokenizer_path(), shards=3)) == brute(edge_rows)
    assert token_corpus(no_docs, tokenizer_path()).collect() == []


def test_shards_read_small_batches(spark, tmp_path, monkeypatch):
    """The shard writer gets at most BATCH_ROWS rows at a time."""
    import pyarrow as pa

    from loadlens.llm import token_output

    def watch(*_):
        def run(batches):
            most = max((b.num_rows for b in batches), default=0)
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([""]), pa.array([most], pa.int64()), pa.array([0], pa.int64())], names=["shard", "path", "docs", "ids"])
        return run
    monkeypatch.setattr(token_output, "_write_shards", watch)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.range(3 * token_output.BATCH_ROWS).selectExpr("id doc_id", "'a b' text")
    rows = token_output.write_token_shards(docs, f"file://{tmp_path}/shards", "", shards=1).collect()
    assert [r["docs"] for r in rows] == [token_output.BATCH_ROWS]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_batches_of_long_texts_are_bounded(spark):
    """Long texts do not make a batch of many rows large, and the settings come back."""
    texts = spark.range(60).select("id", F.repeat(F.lit("word "), 40_000).alias("text")).coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["rows", "bytes"])
    names = [f"spark.sql.execution.arrow.max{x}PerBatch" for x in ("Records", "Bytes")]
    before = [spark.conf.get(x) for x in names]
    with arrow_rows(spark, 1_000):
        got = texts.mapInArrow(sizes, "rows bigint, bytes bigint").collect()
    assert sum(r["rows"] for r in got) == 60 and max(r["bytes"] for r in got) < 2 * BATCH_BYTES
    assert [spark.conf.get(x) for x in names] == before
