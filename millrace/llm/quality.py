"""Quality classifier: a regularised quadratic discriminant over document statistics.

Each document is reduced to a few transformed statistics of its whole text. Per class, mean and
covariance are fitted on all labelled rows given; the covariance is shrunk towards that of all
rows and its diagonal, and its Cholesky factor is kept in the model. A score is the difference of
the two classes' log densities (a difference of Mahalanobis lengths), with a prior, tempered and
squeezed into 0 to 1.

A null text counts as empty. An empty text has statistics (all zero but the constant ones) and so
a score. If one class has no rows, all scores are 0 or all are 1; with no rows at all, 0.5.
Rows with a null label are not learnt from.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\W\d_]+")
UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
DIGITS = re.compile(r"\d+")
SIGNS = re.compile(r"[#*$%&|<>~^=_{}\[\]\\@+]+")
MARKS = re.compile(r"[!?]+")
STATISTICS = (
    "size word_length letters upper digits signs marks distinct top_word same_next same_line"
).split()

SHORT = 64  # characters
SHRINK_TO_POOLED = 0.05  # share of the pooled covariance in each class's
SHRINK_TO_DIAGONAL = 0.02  # share of its own diagonal
RIDGE = 1e-3  # of the pooled variance, plus a floor for constant statistics
FLOOR = 1e-6
TEMPERATURE = 4.0


def _share(pattern: re.Pattern, text: str, usual: float = 0.0) -> float:
    """Share of a text's characters, drawn towards the usual share if the text is short."""
    found = sum(map(len, pattern.findall(text)))
    return (found + usual * SHORT) / (len(text) + SHORT)


def statistics_of(text: str) -> list[float]:
    """Transformed statistics of a text, in the order of STATISTICS."""
    words = WORD.findall(text)
    n = len(words)
    if not n:
        return [0.0] * 7 + [1.0, 0.0, 0.0, 0.0]
    counts = Counter(words)
    same = sum(map(str.__eq__, words, words[1:]))
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    return [
        np.log1p(n),
        np.log(sum(map(len, words)) / n),
        _share(LETTERS, text, 0.8),
        np.sqrt(_share(UPPER, text, 0.02)),
        np.sqrt(_share(DIGITS, text)),
        np.sqrt(_share(SIGNS, text)),
        np.sqrt(_share(MARKS, text)),
        np.log1p(len(counts)) / np.log1p(n),
        np.sqrt(max(counts.values()) / n) if n > 20 else 0.0,
        np.sqrt(same / (n + 10)),
        np.sqrt((len(lines) - len(set(lines))) / (len(lines) + 4)),
    ]


def document_statistics(text: Column) -> Column:
    """Transformed statistics of whole texts, an array of doubles."""

    @F.arrow_udf(ArrayType(DoubleType()))
    def statistics(texts: pa.Array) -> pa.Array:
        found = [statistics_of(t or "") for t in texts.to_pylist()]
        return pa.array(found, pa.list_(pa.float64()))

    return statistics(text)


@dataclass(frozen=True)
class Discriminant:
    """Per class (0, 1): log prior, mean, inverse Cholesky factor and half log determinant."""

    priors: tuple[float, float]
    means: np.ndarray
    factors: np.ndarray
    half_logs: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not np.isfinite(self.priors).all():
            known = [p == 0 for p in self.priors]
            return np.full(len(rows), 0.5 if not any(known) else float(known[1]))
        logs = []
        for prior, mean, factor, half in zip(
            self.priors, self.means, self.factors, self.half_logs
        ):
            lengths = (((rows - mean) @ factor.T) ** 2).sum(1)
            logs.append(prior - half - lengths / 2)
        odds = np.clip((logs[1] - logs[0]) / TEMPERATURE, -30, 30)
        return 1 / (1 + np.exp(-odds))


def fit_discriminant(labelled: DataFrame, stats: str = "stats", label: str = "label") -> Discriminant:
    """Fitted on every row with label 0 or 1; only sums of products reach the driver."""
    d = len(STATISTICS)
    x = [F.col(stats)[i] for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    rows = (
        labelled.where(F.col(label).isin(0, 1))
        .groupBy(F.col(label).cast("int").alias("label"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.sum(v) for v in x]).alias("sums"),
            F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("products"),
        )
        .collect()
    )
    n, sums, products = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for row in rows:
        k = row["label"]
        n[k], sums[k] = row["n"], row["sums"]
        for (i, j), value in zip(pairs, row["products"]):
            products[k, i, j] = products[k, j, i] = value
    with np.errstate(divide="ignore"):
        priors = tuple(np.log(n / max(n.sum(), 1)))
    pooled_mean = sums.sum(0) / max(n.sum(), 1)
    pooled = products.sum(0) / max(n.sum(), 1) - np.outer(pooled_mean, pooled_mean)
    means, factors, halves = np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2)
    for k in (0, 1):
        means[k] = sums[k] / max(n[k], 1)
        own = products[k] / max(n[k], 1) - np.outer(means[k], means[k])
        own = (1 - SHRINK_TO_POOLED) * own + SHRINK_TO_POOLED * pooled
        own = (1 - SHRINK_TO_DIAGONAL) * own + SHRINK_TO_DIAGONAL * np.diag(np.diag(own))
        own += np.diag(RIDGE * np.diag(pooled).clip(0) + FLOOR)
        lower = np.linalg.cholesky(own)
        factors[k] = np.linalg.inv(lower)
        halves[k] = np.log(np.diag(lower)).sum()
    return Discriminant(priors, means, factors, halves)


def quality_score(df: DataFrame, stats: Column, model: Discriminant) -> Column:
    """Score from 0 to 1 of a column of statistics; higher means label 1 is likelier."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(rows: pa.Array) -> pa.Array:
        if not len(rows):
            return pa.array([], pa.float64())
        table = np.array(rows.to_pylist(), float).reshape(len(rows), len(STATISTICS))
        return pa.array(shared.value.scores(table), pa.float64())

    return score(stats)


def fit_quality(docs: DataFrame, taught: DataFrame, doc_id: str = "doc_id", text: str = "text"):
    """A model fitted on all documents with a label; ``taught`` has the id and ``label``."""
    stats = docs.select(doc_id, document_statistics(F.col(text)).alias("stats"))
    return fit_discriminant(stats.join(taught, doc_id))
