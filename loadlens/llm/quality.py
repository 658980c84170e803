"""Quality classifier: regularised quadratic discriminant over document statistics.

Each whole text becomes a short vector of transformed statistics (one pass, kept
in the shared folder, so text is read once).  Class means and covariances come
from sums over all labelled training rows, added up in Spark.  Covariances are
shrunk towards the identity in pooled standard units and factored once
(Cholesky); a document's score is the posterior of class 1 from the two
Mahalanobis log-densities.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import fold, labelled, written

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
SHRINKAGE = 0.05        # share of the identity in each class covariance
STATISTICS = ("log_words", "word_length", "upper", "digit", "symbol", "mark", "exclaim", "repeat_next", "distinct_words",
              "distinct_triples", "duplicate_lines", "line_words", "capital_words", "longest_word")
_UPPER, _DIGIT, _SYMBOL, _EXCLAIM, _MARK, _SPACE = 1, 2, 3, 4, 5, 6


def _classes() -> np.ndarray:
    """Class of each character of the basic plane; 0: other letters."""
    out = np.zeros(1 << 16, np.uint8)
    for c in range(1 << 16):
        kind = unicodedata.category(chr(c))
        out[c] = _UPPER if kind in ("Lu", "Lt") else _DIGIT if kind == "Nd" else _SPACE if kind in ("Zs", "Zl", "Zp", "Cc") else \
            _SYMBOL if kind[0] == "S" else _MARK if kind[0] == "P" else 0
    for c in "#*%&@\\":
        out[ord(c)] = _SYMBOL
    out[ord("!")] = _EXCLAIM
    return out


_CLASS: list[np.ndarray] = []


def _share(part: float, whole: float, prior: float = 0.002) -> float:
    """Log odds of a share, smoothed so that none and all stay finite."""
    p = (part + prior * 5) / (whole + 5) if whole else prior
    p = min(max(p, prior / 2), 1 - prior / 2)
    return float(np.log(p / (1 - p)))


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of a whole text; null and empty texts give those
    of a text without words."""
    text = text or ""
    if not _CLASS:
        _CLASS.append(_classes())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = np.bincount(_CLASS[0][np.minimum(codes, 0xFFFF)], minlength=7) if len(codes) else np.zeros(7)
    words = text.split()
    n, solid = len(words), len(codes) - kinds[_SPACE]
    nxt = words[1:]
    repeats = sum(map(eq, words, nxt))
    triples = len(set(zip(words, nxt, words[2:])))
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    capital = sum(map(str.isupper, words))
    return [float(np.log1p(n)), float(np.log1p(solid / max(1, n))), _share(kinds[_UPPER], solid), _share(kinds[_DIGIT], solid),
            _share(kinds[_SYMBOL], solid), _share(kinds[_MARK], solid), _share(kinds[_EXCLAIM], solid), _share(repeats, n),
            _share(n - len(set(words)), n), _share(max(0, n - 2) - triples, n), _share(len(lines) - len(set(lines)), len(lines)),
            float(np.log1p(n / max(1, len(lines)))), _share(capital, n), float(np.log1p(max(map(len, words), default=0)))]


def with_statistics(docs: DataFrame, column: str, text: str = "text") -> DataFrame:
    @F.pandas_udf("array<double>")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])
    return docs.withColumn(column, udf(F.col(text)))


def class_sums(rows: DataFrame, d: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """``rows(x, y)`` -> class: count, sum and sum of outer products.  Each task
    adds up its rows, Spark adds up the tasks: 2 (1 + d + d^2) numbers arrive."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            y = b.column(1).to_numpy(zero_copy_only=False)
            for c in (0, 1):
                v = x[y == c]
                total[c] += np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()])
        c, i = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(c.ravel()), pa.array(i.ravel()), pa.array(total.ravel())], names=["y", "i", "s"])

    got = rows.select("x", "y").mapInArrow(partial, "y bigint, i bigint, s double").groupBy("y", "i").agg(F.sum("s").alias("s")).collect()
    total = np.zeros((2, 1 + d + d * d))
    for r in got:
        total[r["y"], r["i"]] = r["s"]
    return {c: (t[0], t[1:1 + d], t[1 + d:].reshape(d, d)) for c, t in enumerate(total)}


class Discriminant:
    """Two Gaussian classes with shrunk covariances and cached factors."""

    def __init__(self, sums: dict[int, tuple[float, np.ndarray, np.ndarray]], shrinkage: float = SHRINKAGE):
        (n0, s0, q0), (n1, s1, q1) = sums[0], sums[1]
        n = n0 + n1
        self.constant = None if n0 > 1 and n1 > 1 else 0.5 if not n else n1 / n
        if self.constant is not None:
            return
        self.centre = (s0 + s1) / n
        spread = np.diag(q0 + q1) / n - self.centre ** 2
        self.scale = 1 / np.sqrt(np.maximum(spread, 1e-6))
        self.classes = []
        for m, s, q in ((n0, s0, q0), (n1, s1, q1)):
            mean = s / m
            cov = (q / m - np.outer(mean, mean)) * np.outer(self.scale, self.scale)
            low = np.linalg.cholesky((1 - shrinkage) * cov + shrinkage * np.eye(len(s)))
            self.classes.append(((mean - self.centre) * self.scale, np.linalg.inv(low), np.log(m / n) - np.log(np.diag(low)).sum()))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1."""
        if self.constant is not None or not len(x):
            return np.full(len(x), self.constant if self.constant is not None else 0.5)
        z = (x - self.centre) * self.scale
        at = [c - 0.5 * (((z - mean) @ inv.T) ** 2).sum(1) for mean, inv, c in self.classes]
        return 1 / (1 + np.exp(np.clip(at[0] - at[1], -700, 700)))


def fit(rows: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, shrinkage: float = SHRINKAGE) -> Discriminant:
    """Fit on the labelled rows of ``rows(doc_id, x)`` outside the held-out fold."""
    train = rows.where(fold("doc_id", folds) != held_out).join(labelled(labels, "quality"), "doc_id")
    return Discriminant(class_sums(train, len(STATISTICS)), shrinkage)


def score_column(model: Discriminant, column: str):
    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(x.tolist(), float).reshape(len(x), -1)))
    return score(F.col(column))


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT,
                   threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Null and empty texts are scored as texts without words; a null doc_id counts
    as the text '' for the fold and is never a training row; repeated label
    rows vote.  With labels of one class only the score is that class, with
    none it is 0.5.  Other columns are not read."""
    rows = written(with_statistics(docs.select("doc_id", "text"), "x").select("doc_id", "x"), "quality")
    model = fit(rows, labels, folds, held_out)
    return rows.select("doc_id", (fold("doc_id", folds) == held_out).alias("held_out"), score_column(model, "x").alias("score"))\
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT,
                     threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows scored under ``threshold``; all columns stay."""
    rows = written(with_statistics(docs.select("doc_id", "text"), "x").select("doc_id", "x"), "quality")
    model = fit(rows, labels, folds, held_out)

    # the statistics again in the same pass, rather than a second copy of all texts
    @F.pandas_udf("boolean")
    def passes(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t) for t in texts], float).reshape(len(texts), len(STATISTICS))
        return pd.Series(model.score(x) >= threshold, dtype=bool)
    return docs.where(passes(F.col("text")))
