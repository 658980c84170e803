"""Registered queries of this subpackage: thin bindings of the operators to the
tables, with production parameters."""

from __future__ import annotations

from loadlens.llm.common import table
from loadlens.llm.sql import ORACLE_SQL

TOKENIZER_FILE = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    """Place of a public tokenizer file (a parameter of the operator)."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_outliers(spark, sf_dir):
    from loadlens.llm.outliers import judge
    return judge(table(spark, sf_dir, "documents"))


def op2_toxicity(spark, sf_dir):
    from loadlens.llm.toxicity import toxicity_scores
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_paragraphs(spark, sf_dir):
    from loadlens.llm.paragraph_dedup import repeated_paragraphs
    return repeated_paragraphs(table(spark, sf_dir, "documents"), min_words=1)


def op4_mixing(spark, sf_dir):
    from loadlens.llm.mixing import mix_documents
    return mix_documents(table(spark, sf_dir, "documents"))


def mixing_weighted(spark, sf_dir):
    """The mix with unequal target weights on all three levels."""
    from loadlens.llm.mixing import mix_documents
    from loadlens.llm.sql import MIX_WEIGHTS
    return mix_documents(table(spark, sf_dir, "documents"), weights=MIX_WEIGHTS)


def op5_decontaminate(spark, sf_dir):
    from loadlens.llm.decontaminate import contamination_report
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_html(spark, sf_dir):
    from loadlens.llm.html_text import extract_text
    return extract_text(table(spark, sf_dir, "pages"))


def op7_language(spark, sf_dir):
    from loadlens.llm.language_id import identify
    return identify(table(spark, sf_dir, "documents"))


def op8_token_ids(spark, sf_dir):
    from loadlens.llm.token_output import token_corpus
    return token_corpus(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_quality(spark, sf_dir):
    from loadlens.llm.quality import quality_scores
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash(spark, sf_dir):
    from loadlens.llm.simhash import simhash_groups
    return simhash_groups(table(spark, sf_dir, "documents"))


def op11_centroids(spark, sf_dir):
    from loadlens.llm.walsh import cluster_vectors
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def op12_merkle(spark, sf_dir):
    from loadlens.llm.merkle import merkle_manifest
    return merkle_manifest(table(spark, sf_dir, "documents"))


def op13_urls(spark, sf_dir):
    from loadlens.llm.url_rules import judge_urls, rules_frame
    return judge_urls(table(spark, sf_dir, "pages"), rules_frame(spark))


QUERIES = {f.__name__: f for f in (op1_outliers, op2_toxicity, op3_paragraphs, op4_mixing, op5_decontaminate, op6_html, op7_language, op8_token_ids, op9_quality,
                                   op10_simhash, op11_centroids, op12_merkle, op13_urls, mixing_weighted)}
ORACLE = ORACLE_SQL
