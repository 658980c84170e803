"""Toxicity: gradient-boosted trees over dense features, isotonic calibration.

A lexicon of words and word beginnings is learned from a bounded sample of
labelled rows.  Each whole text becomes a short vector: lexicon densities, how
near the hits stand to second-person words, capitals, punctuation and
obfuscation rates.  Spark's boosted trees are fitted on part of the sample and
calibrated by isotonic regression on the rest.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import fold, labelled, written

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
MAX_TRAIN = 20_000       # labelled rows that the model is fitted on
MIN_DOCS, MIN_SHARE = 5, 0.02  # toxic documents that an entry occurs in: number and share
MIN_ODDS = 50.0          # times more often in toxic documents
BEGINNINGS = (4, 5)      # lengths of word beginnings
NEAR = 5                 # words between a hit and a second-person word
TREES, DEPTH, SEED = 20, 3, 11
CACHE_WORDS = 300_000    # words a worker remembers (affects time only)

#: Second-person words of English, German, French, Spanish.
SECOND_PERSON = frozenset("""you your yours yourself yourselves u ur du dich dir dein deine deinen deiner euch euer ihr ihnen
tu te toi ton ta tes vous votre vos ti tú tus usted ustedes vosotros vuestro vuestra os""".split())
#: Signs that stand for letters.
LOOK_ALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l", "€": "e"})
FEATURES = ("density", "weight", "distinct", "hits", "near_you", "you", "capital_words", "capitals", "marks", "exclaims",
            "obfuscated", "obfuscated_hits", "log_words")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[^\W\d_][\d\W_]+[^\W\d_]")
_JOIN = re.compile(r"[\W\d_]+")


def plain(word: str) -> tuple[str, bool]:
    """The word in lower case with look-alike signs as letters and without
    other signs, and whether signs stood between its letters."""
    core = _EDGE.sub("", word.lower())
    if core.isalpha():
        return core, False
    hidden = bool(_INNER.search(core)) and "'" not in core and "’" not in core and "-" not in core
    return _JOIN.sub("", core.translate(LOOK_ALIKE)), hidden


def terms(word: str) -> list[str]:
    """Lexicon entries that a word may match: itself and its beginnings."""
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) > n)]


def learn_lexicon(rows: DataFrame, min_docs: int = MIN_DOCS, min_odds: float = MIN_ODDS) -> dict[str, float]:
    """``rows(text, y)`` -> entry: log odds.  Documents with each entry are
    counted by class in Spark; entries in under ``min_docs`` or ``MIN_SHARE`` of the
    toxic documents (words of one group of copies) or under ``min_odds`` odds
    are left out."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = (Counter(), Counter())
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n[y].update({x for w in set((t or "").split()) for x in terms(plain(w)[0]) if len(x) > 2})
        for y in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array(list(n[y]), pa.string()), pa.array([y] * len(n[y]), pa.int32()),
                                              pa.array(list(n[y].values()), pa.int64())], names=["term", "y", "n"])

    size = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    per = rows.select("text", "y").mapInArrow(count, "term string, y int, n bigint").groupBy("term").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("n1"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("n0"))
    odds = ((F.col("n1") + 0.5) / (n1 + 1)) / ((F.col("n0") + 0.5) / (n0 + 1))
    top = per.where(F.col("n1") >= max(min_docs, MIN_SHARE * n1)).select("term", "n1", odds.alias("odds")).where(F.col("odds") >= min_odds)\
        .orderBy(F.desc("odds"), "term").collect()      # in MIN_SHARE of the documents each: at most 50 times a document's terms
    docs = {r["term"]: r["n1"] for r in top}
    # a beginning that one longer entry accounts for would only add chance hits
    spare = {short for term, n in docs.items() for k in range(min(BEGINNINGS), len(term.rstrip("*")))
             if (short := f"{term[:k]}*") in docs and n >= 0.9 * docs[short]}
    return {r["term"]: float(np.log(r["odds"])) for r in top if r["term"] not in spare}


class Measure:
    """Feature vectors of texts under a lexicon."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.seen = lexicon, {}

    def _look(self, word: str) -> tuple[float, bool, bool, str]:
        """Weight, obfuscated, second person, and the plain word."""
        core, hidden = plain(word)
        got = max((self.lexicon.get(t, 0.0) for t in terms(core)), default=0.0)
        if len(self.seen) > CACHE_WORDS:
            self.seen.clear()
        out = (got, hidden, core in SECOND_PERSON, core) if got or hidden or core in SECOND_PERSON else None
        self.seen[word] = out
        return out

    def __call__(self, text: str | None) -> list[float]:
        text = text or ""
        words, seen = text.split(), self.seen
        n, marked = len(words), []
        for i, w in enumerate(words):
            x = seen[w] if w in seen else self._look(w)
            if x:
                marked.append((i, x))
        hits = [(i, x) for i, x in marked if x[0]]
        you = np.array([i for i, x in marked if x[2]])
        at = np.array([i for i, _ in hits])
        near = 0
        if len(you) and len(at):
            k = np.searchsorted(you, at)
            near = int((np.minimum(np.abs(you[np.minimum(k, len(you) - 1)] - at), np.abs(you[np.maximum(k - 1, 0)] - at)) <= NEAR).sum())
        chars = np.frombuffer(text.encode("latin-1", "replace"), np.uint8)
        kinds = np.bincount(chars, minlength=256) if len(chars) else np.zeros(256)
        upper, solid = kinds[65:91].sum(), max(1, len(chars) - kinds[32] - kinds[10])
        marks = kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum()
        m = max(1, n)
        return [len(hits) / m, sum(x[0] for _, x in hits) / m, float(np.log1p(len({x[3] for _, x in hits}))), float(np.log1p(len(hits))),
                near / max(1, len(hits)), len(you) / m, sum(map(str.isupper, words)) / m, upper / solid, marks / solid, kinds[33] / solid,
                sum(x[1] for _, x in marked) / m, sum(x[1] for _, x in hits) / m, float(np.log1p(n))]


def with_measures(docs: DataFrame, lexicon: dict[str, float], column: str, text: str = "text") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("array<double>")
    def udf(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        measure = Measure(shared.value)
        for texts in parts:
            yield pd.Series([measure(t) for t in texts])
    return docs.withColumn(column, udf(F.col(text)))


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, threshold: float = THRESHOLD,
                    max_train: int = MAX_TRAIN) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    The model is fitted on the ``max_train`` training rows of least hashed id.
    Null and empty texts are scored as texts without words; repeated label rows
    vote; a null doc_id counts as the text '' for the fold.  With labels of one
    class only the score is that class, with none it is 0.5.  Only doc_id and
    text are read."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    chosen = labelled(labels, "toxic").where(fold("doc_id", folds) != held_out)\
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)  # at most max_train rows of 12 bytes
    sample = written(docs.join(F.broadcast(chosen), "doc_id"), "toxicity-sample")
    classes = {r["y"] for r in sample.select("y").distinct().collect()}
    lexicon = learn_lexicon(sample) if len(classes) == 2 else {}
    rows = with_measures(docs, lexicon, "x").select("doc_id", "x")
    out = ["doc_id", (fold("doc_id", folds) == held_out).alias("held_out")]
    if len(classes) < 2:
        constant = float(classes.pop()) if classes else 0.5
        scored = rows.select(*out, F.lit(constant).alias("score"))
    else:
        fit = written(with_measures(sample, lexicon, "x").select("y", "doc_id", "x"), "toxicity-train")\
            .select(F.col("y").cast("double").alias("y"), array_to_vector("x").alias("v"), fold(F.xxhash64("doc_id"), 4).alias("part"))
        trees = GBTClassifier(featuresCol="v", labelCol="y", maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.3)
        model = trees.fit(fit.where("part <> 0"))
        margin = lambda df: model.transform(df).withColumn("p", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")
        # the part that the trees have not seen; ends are tied to 0 and 1 by isotonic steps
        curve = IsotonicRegression(featuresCol="p", labelCol="y").fit(margin(fit.where("part = 0")).select("p", "y"))
        scored = curve.transform(margin(rows.withColumn("v", array_to_vector("x"))))\
            .select(*out, F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(1.0)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
