"""Quality: positive-unlabelled learning with a non-negative risk estimate.

Documents marked good are trusted positives; web text without a mark is a mixture of good
and bad. A classifier minimises the unbiased estimate of the risk over positives and
unlabelled texts, kept from becoming negative; the class prior is estimated from the same
two samples. Marks of bad quality are never learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspan.llm.common import held_out, table
from wattspan.llm.toxicity import labelled_sample, sigmoid

# At most about this many trusted positives, and as many unlabelled texts, are learnt from.
SAMPLE = 12_000
HIDDEN = 24
EXTRA = 8


def features(text: str | None) -> np.ndarray:
    """What a whole text is made of: its bytes, repetition, lengths and cases of words."""
    result = np.zeros(256 + EXTRA, np.float32)
    if not text:
        return result
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    result[:256] = np.sqrt(np.bincount(raw, minlength=256) / len(raw))
    words = text.split()
    if words:
        count = len(words)
        result[256:] = (
            sum(map(eq, words, words[1:])) / count,
            len(set(words)) / count,
            len(raw) / count / 16,
            np.log1p(count) / 8,
            sum(map(str.isupper, words)) / count,
            sum(map(str.isalpha, words)) / count,
            text.count("\n") / count,
            max(map(len, words)) / 64,
        )
    return result


def feature_column(text: str) -> Column:
    @F.pandas_udf("array<float>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    return found(text)


@dataclass
class QualityModel:
    mean: np.ndarray
    deviation: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    bias: float
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.deviation @ self.inner + self.inner_bias)
        return hidden @ self.outer + self.bias


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from scores that tell the two samples apart.

    For any set of scores, unlabelled texts fall into it at least ``prior`` times as often
    as positives. The least such ratio over upper score ranges, with a margin for the
    size of the samples, bounds the prior from above and is near it where some range
    holds positives alone.
    """
    if not len(positive) or not len(unlabelled):
        return 0.5
    cuts = np.quantile(positive, np.linspace(0, 0.9, 91))
    p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    margin = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled)))
    best = int(np.argmin((u + margin) / np.maximum(p, 1e-9)))
    return float(np.clip(u[best] / max(p[best], 1e-9), 0.05, 0.95))


def train(
    positive: np.ndarray,
    unlabelled: np.ndarray,
    prior: float | None,
    epochs: int = 30,
    seed: int = 7,
) -> QualityModel:
    """Adam on the non-negative risk with the logistic loss.

    Without a ``prior`` the samples are just told apart, positives against unlabelled.
    Where the estimated risk of negatives falls below 0, its gradient is reversed.
    """
    random = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled])
    mean, deviation = both.mean(axis=0), both.std(axis=0) + 1e-2
    width = both.shape[1]
    weights = [
        random.normal(0, 1 / np.sqrt(width), (width, HIDDEN)),
        np.zeros(HIDDEN),
        random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        np.zeros(1),
    ]
    p_all, u_all = (positive - mean) / deviation, (unlabelled - mean) / deviation
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step, batches = 0, max(1, min(len(p_all), len(u_all)) // 256)
    for _ in range(epochs):
        p_order = np.array_split(random.permutation(len(p_all)), batches)
        u_order = np.array_split(random.permutation(len(u_all)), batches)
        for p_rows, u_rows in zip(p_order, u_order):
            x = np.concatenate([p_all[p_rows], u_all[u_rows]])
            hidden = np.tanh(x @ weights[0] + weights[1])
            g = hidden @ weights[2] + weights[3][0]
            up = sigmoid(g)
            n, m = len(p_rows), len(u_rows)
            if prior is None:
                flow = np.concatenate([(up[:n] - 1) / (2 * n), up[n:] / (2 * m)])
            else:
                as_negative = np.logaddexp(0, g)
                negatives = as_negative[n:].mean() - prior * as_negative[:n].mean()
                of_negatives = np.concatenate([-prior * up[:n] / n, up[n:] / m])
                of_positives = np.concatenate([prior * (up[:n] - 1) / n, np.zeros(m)])
                flow = of_positives + of_negatives if negatives >= 0 else -of_negatives
            back = flow[:, None] * weights[2] * (1 - hidden**2)
            grads = [x.T @ back, back.sum(axis=0), hidden.T @ flow, np.array([flow.sum()])]
            step += 1
            for k, grad in enumerate(grads):
                grad = grad + 1e-4 * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.99 * second[k] + 0.01 * grad**2
                scale = np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7
                weights[k] = weights[k] - 0.004 * first[k] / (1 - 0.9**step) / scale
    return QualityModel(mean, deviation, *weights[:3], float(weights[3][0]), prior or 0.5)


def _matrix(rows: DataFrame) -> np.ndarray:
    found = rows.select("doc_id", "x").toArrow().sort_by("doc_id").column("x").combine_chunks()
    return found.flatten().to_numpy(zero_copy_only=False).reshape(-1, 256 + EXTRA).astype(np.float64)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """Learn from the positives of ``labels.quality`` and from documents without a label.

    Both samples are at most about ``sample`` documents outside the held-out fifth; their
    features go to the driver. With an empty one the score is 0.5 everywhere.
    """
    good = labelled_sample(docs, labels, "quality", sample, only=1)
    p = _matrix(good.withColumn("x", feature_column("text")))
    marked = labels.select(F.col("doc_id").cast("long")).distinct()
    free = docs.select(F.col("doc_id").cast("long")).distinct().join(marked, "doc_id", "left_anti")
    free = free.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    web = docs.select(F.col("doc_id").cast("long"), "text").join(free, "doc_id").dropDuplicates(["doc_id"])
    u = _matrix(web.withColumn("x", feature_column("text")))
    if not len(p) or not len(u):
        width = 256 + EXTRA
        return QualityModel(
            np.zeros(width), np.ones(width), np.zeros((width, HIDDEN)), np.zeros(HIDDEN),
            np.zeros(HIDDEN), 0.0, 0.5,
        )
    # The prior is estimated on texts that the first classifier has not seen.
    apart = train(p[::2], u[::2], None, epochs=12)
    prior = class_prior(apart.logits(p[1::2]), apart.logits(u[1::2]))
    return train(p, u, prior)


def quality(text: Column, model: QualityModel) -> Column:
    """The probability that a whole text is good; null and empty texts have no features."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype="float64")
        return pd.Series(sigmoid(model.logits(np.stack([features(t) for t in texts]))))

    return scored(text)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every one of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.withColumn("score", quality(F.col("text"), model))
    return scored.select(
        F.col("doc_id").cast("long"),
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
