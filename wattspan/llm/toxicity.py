"""Toxicity: a convolutional text classifier in numpy.

A word's embedding is the sum of the table rows that it and its first letters are hashed
to; filters of several widths run over the whole text, each keeps its maximum, and a
logistic layer turns the maxima into a score.
The model is trained on a bounded sample of labelled documents and scores texts in tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspan.llm.common import free_name, held_out, stage, table, words_of
from wattspan.session import session_conf

BUCKETS = 1 << 17
PREFIXES = (4, 5, 6)
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 12
# Training uses at most about this many labelled documents, chosen by a hash of the id.
SAMPLE = 12_000
# One in this many documents of the sample is not trained on. These and all labelled documents
# beyond the sample calibrate scores and thresholds, as histograms of logits.
CALIBRATION = 5
BINS_PER_LOGIT = 20
# A language's threshold counts as much as the common one at this many examples of its rarer label.
SMOOTHING = 20
TEXTS_AT_ONCE = 64
# Spark and Python hold a batch of texts several times over; some of these that are scored at once.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(16 * TEXTS_AT_ONCE)}
PAD = 0


class Vocabulary:
    """Numbers of words, and the table rows of each: the word's and its prefixes'.

    Number 0 is the padding. A word shorter than a prefix has the row ``BUCKETS`` of
    zeros there. :meth:`trim` empties a vocabulary of over ``limit`` words.
    """

    def __init__(self, limit: int = 150_000) -> None:
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.numbers = {"": PAD}
        self.rows = np.full((1024, 1 + len(PREFIXES)), BUCKETS, np.int32)

    def trim(self) -> None:
        if len(self.numbers) > self.limit:
            self.clear()

    def __call__(self, text: str | None) -> np.ndarray:
        words, numbers = words_of(text), self.numbers
        for word in set(words).difference(numbers):
            at = numbers[word] = len(numbers)
            if at == len(self.rows):
                self.rows = np.concatenate([self.rows, np.full_like(self.rows, BUCKETS)])
            parts = [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]
            self.rows[at, : len(parts)] = [zlib.crc32(p.encode("utf-8", "replace")) % BUCKETS for p in parts]
        return np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))


@dataclass
class ConvModel:
    """Weights; the row ``BUCKETS`` of the table is zero, as padding after each text is."""

    table: np.ndarray
    filters: dict[int, np.ndarray]
    filter_bias: dict[int, np.ndarray]
    out: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0

    def maxima(
        self, docs: list[np.ndarray], words: Vocabulary
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximum of each filter over each document, where it starts, and all padded words.

        A text without words has maxima 0, as have filters that never exceed 0.
        """
        most = max(WIDTHS) - 1
        pad = np.full(most, PAD, np.int32)
        ids = np.concatenate([x for d in docs for x in (d, pad)])
        sizes = np.array([len(d) for d in docs])
        starts = np.concatenate([[0], np.cumsum(sizes + most)[:-1]])
        result = np.zeros((len(docs), len(WIDTHS) * FILTERS), np.float32)
        where = np.repeat(starts[:, None], result.shape[1], 1)
        filled = np.flatnonzero(sizes)
        span = len(ids) - most
        distinct, place = np.unique(ids, return_inverse=True)
        vectors = self.table[words.rows[distinct]].sum(axis=1)
        for n, width in enumerate(WIDTHS):
            values = np.empty((span, FILTERS), np.float32)
            values[:] = self.filter_bias[width]
            for tap in range(width):
                values += (vectors @ self.filters[width][tap])[place[tap : tap + span]]
            columns = slice(n * FILTERS, (n + 1) * FILTERS)
            if self.training:
                for d in filled:
                    part = values[starts[d] : starts[d] + sizes[d]]
                    at = part.argmax(axis=0)
                    where[d, columns] = starts[d] + at
                    result[d, columns] = part[at, np.arange(FILTERS)]
            elif len(filled):
                cuts = np.stack([starts[filled], starts[filled] + sizes[filled]], 1).ravel()
                ends = cuts[:-1] if cuts[-1] >= span else cuts
                result[filled, columns] = np.maximum.reduceat(values, ends, axis=0)[::2]
        return np.maximum(result, 0), where, ids

    training = False

    def logits(self, docs: list[np.ndarray], words: Vocabulary) -> np.ndarray:
        """Before calibration, a few documents at a time."""
        found = [np.zeros(0)]
        for low in range(0, len(docs), TEXTS_AT_ONCE):
            best = self.maxima(docs[low : low + TEXTS_AT_ONCE], words)[0]
            found.append(best @ self.out + self.bias)
        return np.concatenate(found)

    def scores(self, docs: list[np.ndarray], words: Vocabulary) -> np.ndarray:
        return sigmoid(self.scale * self.logits(docs, words) + self.shift)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def platt(logits: np.ndarray, labels: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift that fit ``labels`` best, with smoothed targets (Newton steps)."""
    positive = (labels * counts).sum()
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (counts.sum() - positive + 2))
    beta = np.array([1.0, 0.0])
    x = np.stack([logits, np.ones_like(logits)], 1)
    for _ in range(rounds):
        p = sigmoid(x @ beta)
        hessian = (x * (counts * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        beta -= np.linalg.solve(hessian, x.T @ (counts * (p - target)) + 1e-3 * (beta - [1.0, 0.0]))
    return float(max(beta[0], 1e-3)), float(beta[1])


def train(
    docs: list[np.ndarray], words: Vocabulary, labels: np.ndarray, epochs: int = 4, seed: int = 7
) -> ConvModel:
    """Adam on the logistic loss; only the windows at the maxima pass gradients on.

    The first embedding dimension starts from the smoothed log-odds of the bucket among
    training documents, so that rare words need not be found by chance.
    """
    random = np.random.default_rng(seed)
    labels = np.asarray(labels, np.float64)
    held = [np.zeros(BUCKETS), np.zeros(BUCKETS)]
    for d, y in zip(docs, labels):
        buckets = np.unique(words.rows[d])
        held[int(y)][buckets[buckets < BUCKETS]] += 1
    ones, zeros = max(labels.sum(), 1), max((1 - labels).sum(), 1)
    odds = np.log((held[1] + 0.5) / (ones + 1)) - np.log((held[0] + 0.5) / (zeros + 1))
    odds *= (held[0] + held[1]) / (held[0] + held[1] + 10)
    table_ = np.zeros((BUCKETS + 1, DIM), np.float32)
    table_[:-1] = random.normal(0, 0.05, (BUCKETS, DIM))
    table_[:-1, 0] = odds / 2
    filters = {w: random.normal(0, 0.2, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS}
    for w in WIDTHS:
        filters[w][:, 0, ::2] = np.abs(filters[w][:, 0, ::2]) + 0.4
    weights = {"table": table_, "out": random.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)}
    weights |= {f"f{w}": filters[w] for w in WIDTHS} | {f"b{w}": np.zeros(FILTERS, np.float32) for w in WIDTHS}
    weights["bias"] = np.array([np.log(ones / zeros)], np.float32)
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    model = ConvModel(
        weights["table"], {w: weights[f"f{w}"] for w in WIDTHS}, {w: weights[f"b{w}"] for w in WIDTHS},
        weights["out"], 0.0,
    )
    model.training = True
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(docs))
        for low in range(0, len(order), TEXTS_AT_ONCE):
            batch = order[low : low + TEXTS_AT_ONCE]
            model.bias = float(weights["bias"][0])
            best, where, ids = model.maxima([docs[i] for i in batch], words)
            error = (sigmoid(best @ model.out + model.bias) - labels[batch]) / len(batch)
            back = (error[:, None] * model.out) * (best > 0)
            grads = {k: np.zeros_like(v) for k, v in weights.items() if k != "table"}
            touched, changes = [], []
            grads["out"] = best.T @ error + 1e-4 * weights["out"]
            grads["bias"] = np.array([error.sum()])
            for n, w in enumerate(WIDTHS):
                columns = slice(n * FILTERS, (n + 1) * FILTERS)
                flow, at = back[:, columns], where[:, columns]
                grads[f"b{w}"] = flow.sum(axis=0)
                for tap in range(w):
                    rows = words.rows[ids[at + tap]]
                    vectors = weights["table"][rows].sum(axis=2)
                    grads[f"f{w}"][tap] = np.einsum("dfe,df->ef", vectors, flow)
                    change = flow[:, :, None] * weights[f"f{w}"][tap].T[None]
                    touched.append(rows.reshape(-1))
                    changes.append(np.repeat(change, rows.shape[2], axis=1).reshape(-1, DIM))
            # Rows of the table that no window used keep their moments.
            used, place = np.unique(np.concatenate(touched), return_inverse=True)
            grads["table"] = np.zeros((len(used), DIM), np.float32)
            np.add.at(grads["table"], place, np.concatenate(changes))
            grads["table"][used == BUCKETS] = 0
            step += 1
            for k, g in grads.items():
                view = used if k == "table" else slice(None)
                first[k][view] = 0.9 * first[k][view] + 0.1 * g
                second[k][view] = 0.99 * second[k][view] + 0.01 * g * g
                mean = first[k][view] / (1 - 0.9**step)
                weights[k][view] -= 0.01 * mean / (np.sqrt(second[k][view] / (1 - 0.99**step)) + 1e-6)
    model.bias = float(weights["bias"][0])
    model.training = False
    return model


def best_threshold(scores: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> float:
    """The score at which F1 is highest, halfway to the next lower one; 0.5 without both labels."""
    if len(set(labels.tolist())) < 2:
        return 0.5
    order = np.argsort(-scores, kind="stable")
    ranked, hits = scores[order], np.cumsum((labels * counts)[order])
    f1 = 2 * hits / (np.cumsum(counts[order]) + hits[-1])
    f1[:-1][ranked[:-1] == ranked[1:]] = -1
    best = int(np.argmax(f1))
    low = ranked[best + 1] if best + 1 < len(ranked) else 0.0
    return float(np.clip((ranked[best] + low) / 2, 0.05, 0.95))


@dataclass
class ToxicityModel:
    model: ConvModel
    thresholds: dict[str, float]
    default: float


def training_labels(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id`` and ``label`` of the examples.

    Documents of the held-out fifth, null ids, null labels and ids with two labels are none.
    """
    marks = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("label"))
    marks = marks.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    return marks.where("label = other").drop("other")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, limit: int, only: int | None = None
) -> DataFrame:
    """At most about ``limit`` labelled training documents, those lowest by a hash.

    With ``only`` all have that label. Of rows with one id that with the least text serves.
    """
    marks = training_labels(labels, label)
    if only is not None:
        marks = marks.where(F.col("label") == only)
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    found = docs.select(F.col("doc_id").cast("long"), "text").join(chosen, "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def _features(model: ConvModel):
    """A function column of the whole text: the logit of the model."""

    @F.pandas_udf("double")
    def logit(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = Vocabulary()
        for texts in frames:
            found = [np.zeros(0)]
            for low in range(0, len(texts), TEXTS_AT_ONCE):
                words.trim()
                part = [words(t) for t in texts.iloc[low : low + TEXTS_AT_ONCE]]
                found.append(model.logits(part, words))
            yield pd.Series(np.concatenate(found))

    return logit


def histogram(logits: DataFrame, labels: DataFrame, trained: list[int]) -> pd.DataFrame:
    """``lang``, ``label``, ``logit`` and ``n`` of all examples but those ``trained`` on.

    ``logits`` has ``doc_id``, ``lang`` and ``logit``; no text is shuffled. Of rows with one id
    the least logit counts, and the least language. The driver gets the mean logit and the
    number of each language's examples by label and bin, not the examples.
    """
    used = logits.sparkSession.createDataFrame([(i,) for i in trained], "doc_id long")
    marks = training_labels(labels, "toxic").join(used, "doc_id", "left_anti")
    slim = logits.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), "logit").join(marks, "doc_id")
    each = slim.groupBy("doc_id", "label").agg(F.min("lang").alias("lang"), F.min("logit").alias("logit"))
    binned = each.groupBy("lang", "label", F.floor(F.col("logit") * BINS_PER_LOGIT).alias("bin"))
    counted = binned.agg(F.avg("logit").alias("logit"), F.count("*").alias("n"))
    return counted.orderBy("lang", "label", "bin").toPandas()


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[ConvModel, list[int]]:
    """A model of at most ``sample`` labelled texts, which the driver gets, and their ids.

    Every fifth of them is left for calibration. Without any example the model keeps its
    random start, and its scores mean nothing.
    """
    rows = (
        labelled_sample(docs, labels, "toxic", sample)
        .select("doc_id", "text", "label")
        .toArrow()
        .sort_by("doc_id")
    )
    ids = rows.column("doc_id").to_pylist()
    words = Vocabulary()
    arrays = [words(t.as_py()) for t in rows.column("text")]
    y = rows.column("label").to_numpy().astype(np.float64)
    del rows
    index = np.arange(len(arrays))
    rest = index[index % CALIBRATION != 0]
    model = train([arrays[i] for i in rest], words, y[rest])
    return model, [ids[i] for i in rest]


def calibrated(model: ConvModel, tune: pd.DataFrame) -> ToxicityModel:
    """The model with its scale and the thresholds of all languages in ``tune``.

    A language's threshold is drawn towards the common one, and that towards 0.5, the more
    the fewer examples of its rarer label there are. Scale and shift need examples of both
    labels, and with few stay near 1 and 0.
    """
    logits, marks, counts = (tune[c].to_numpy(np.float64) for c in ("logit", "label", "n"))

    def drawn(own: np.ndarray, towards: float) -> float:
        toxic = (marks * counts)[own].sum()
        rarer = min(toxic, counts[own].sum() - toxic)
        value = best_threshold(scores[own], marks[own], counts[own])
        return float((rarer * value + SMOOTHING * towards) / (rarer + SMOOTHING))

    if len(set(marks)) == 2:
        model.scale, model.shift = platt(logits, marks, counts)
    scores = sigmoid(model.scale * logits + model.shift)
    default = drawn(np.ones(len(marks), bool), 0.5)
    langs = tune.lang.dropna().unique()
    thresholds = {str(lang): drawn((tune.lang == lang).to_numpy(), default) for lang in langs}
    return ToxicityModel(model, thresholds, default)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Train on ``labels.toxic`` and calibrate on all other examples among ``docs``."""
    model, ids = trained(docs, labels, sample)
    logits = docs.select("doc_id", "lang", _features(model)("text").alias("logit"))
    return calibrated(model, histogram(logits, labels, ids))


def _limit(fitted: ToxicityModel) -> Column:
    limit = F.lit(fitted.default)
    for lang, value in sorted(fitted.thresholds.items()):
        limit = F.when(F.col("lang") == lang, value).otherwise(limit)
    return limit


def _judged(rows: DataFrame, logit: str, fitted: ToxicityModel, names: tuple[str, str]) -> DataFrame:
    """Score and verdict from the logit of every row."""
    value = 1 / (1 + F.exp(-(fitted.model.scale * F.col(logit) + fitted.model.shift)))
    scored = rows.withColumn(names[0], value)
    return scored.withColumn(names[1], F.col(names[0]) >= _limit(fitted))


def score(docs: DataFrame, fitted: ToxicityModel, names: tuple[str, str] = ("toxicity", "toxic")) -> DataFrame:
    """``docs`` with a score of each whole text and whether it is toxic, by the given names.

    The score depends on the text alone; the verdict applies the threshold of the row's
    ``lang``, or the common one where the language is null or has no example. Null and empty
    texts get the score of no words. Repeated rows and null ids stay. Columns of ``docs`` that
    have one of the names are replaced.
    """
    logit = free_name([*docs.columns, *names], "logit")
    rows = docs.withColumn(logit, _features(fitted.model)("text"))
    return _judged(rows, logit, fitted, names).drop(logit)


def scored_once(
    docs: DataFrame, labels: DataFrame, kept: list[str], names: tuple[str, str] = ("toxicity", "toxic")
) -> DataFrame:
    """Train, calibrate and judge with a single pass of scoring over ``docs``.

    The logit of every row is stored with the columns ``kept``, among them ``doc_id`` and
    ``lang``; calibration and verdict read it from there.
    """
    model, ids = trained(docs, labels)
    logit = free_name([*docs.columns, *names], "logit")
    logits = docs.withColumn(logit, _features(model)("text")).select(*kept, logit)
    with session_conf(docs.sparkSession, BATCHES):
        stored = stage(logits, "toxicity-logits")
    tune = histogram(stored.select("doc_id", "lang", F.col(logit).alias("logit")), labels, ids)
    return _judged(stored, logit, calibrated(model, tune), names).drop(logit)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every one of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    scored = scored_once(docs, table(spark, sf_dir, "labels"), ["doc_id", "lang"])
    return scored.select(
        F.col("doc_id").cast("long"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        "toxic",
    )
