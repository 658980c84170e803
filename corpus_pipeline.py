"""Training-data pipeline: five stages over ``documents``, each a numbered operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's ``docs``.

All stages: a null or empty text is a document without words, repeated rows and
null ids are documents of their own, equally ranked rows stay or go together or by
their order, an empty table gives an empty result, and columns that are not read
pass through, whatever their names (the last stage returns its own).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadlens.llm.common import table, written
from loadlens.llm.decontaminate import drop_contaminated
from loadlens.llm.mixing import keep_mix
from loadlens.llm.quality import drop_low_quality
from loadlens.llm.queries import tokenizer_path
from loadlens.llm.simhash import keep_one_per_group
from loadlens.llm.token_output import token_corpus

#: Target weights of the mix by level; a name that is not listed weighs 100.
WEIGHTS = {"lang": {"en": 100, "de": 100, "fr": 100, "es": 100}}
#: Budget of the mix as a share of the words that reach it.
BUDGET_SHARE = 0.8
#: Rows with whole texts in an Arrow batch.  A stage's last pass runs when its caller
#: writes it, so this is set for the session; Arrow buffers of the default 10,000
#: rows take more memory outside the heap than an executor has to spare.
BATCH_ROWS = 1_000
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    rows = int(spark.conf.get(_ARROW_ROWS))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(_ARROW_ROWS, str(BATCH_ROWS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    bound_batches(spark)
    return drop_low_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each group stays."""
    bound_batches(spark)
    return keep_one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: contaminated documents go."""
    bound_batches(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights, in at most one epoch."""
    bound_batches(spark)
    return keep_mix(docs, BUDGET_SHARE, WEIGHTS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards with Elias-Fano boundaries, read back."""
    bound_batches(spark)
    return token_corpus(docs, tokenizer_path())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("mix", mix), ("token_ids", token_ids)]

#: Fitted models, XXH64 and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
