"""Quality classifier by positive-unlabelled learning.

A small network over statistics of the whole text minimises the non-negative unbiased risk
  prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])
over trusted positives P (rows labelled 1) and unlabelled text U, with logistic loss l; no row labelled 0 enters the risk. The class prior is estimated as the
share of label 1 among the labelled rows of the training folds, less two standard errors.

Fitting takes a bounded sample, chosen by a hash of the id: at most MOST_P positives and MOST_U unlabelled documents; statistics of those
rows alone come to the driver. Scoring covers every document where it lies. Folds: a document is held out when crc32 of its id as text leaves HELD_OUT modulo FOLDS;
labels and unlabelled text of held-out documents take no part in fitting. Labels, language, source and id are never features.

Cases: null text scores as the empty text; null ids are not held out and never fitted on; several labels of one id count as their smallest;
repeated rows get equal scores; very long texts are taken whole; without positives or unlabelled rows the score is the prior (0.5 without labels); extra columns don't take part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import table

FOLDS, HELD_OUT = 4, 2
MOST_P, MOST_U = 4000, 8000
THRESHOLD = 0.7
HIDDEN, EPOCHS, RATE, DECAY, SEED = 16, 400, 0.02, 1e-3, 7

_CLASSES = np.zeros((256, 7))
_CLASSES[65:91, 0] = _CLASSES[97:123, 1] = _CLASSES[48:58, 2] = 1
_CLASSES[[ord(c) for c in ".,;:?'\"-()"], 3] = 1
_CLASSES[[ord(c) for c in "!#$%&*+/<=>@\\^_`~"], 4] = 1
_CLASSES[[ord(c) for c in "|[]{}"], 6] = 1
_CLASSES[128:, 5] = 1


def statistics(text: str) -> list[float]:
    """Of the whole text: length, shares of kinds of bytes, repetition of words, word pairs and lines, word lengths."""
    raw = np.frombuffer(text.encode(), np.uint8)
    n = max(len(raw), 1)
    words = text.lower().split()
    m = max(len(words), 1)
    seen = Counter(words)
    lines = text.split("\n")
    distinct = len(set(lines))
    return [
        np.log1p(len(raw)),
        np.log1p(len(words)),
        *(np.bincount(raw, minlength=256) @ _CLASSES / n),
        len(seen) / m,
        sum(map(str.__eq__, words, words[1:])) / m,
        max(seen.values(), default=0) / m,
        distinct / len(lines),
        np.log1p(len(lines) / m * 10),
        sum(map(len, words)) / m / 10,
        sum(1 for c in seen.values() if c > 1) / max(len(seen), 1),
    ]


def _features(texts: pd.Series) -> np.ndarray:
    return np.array([statistics(t) for t in texts.fillna("")]).reshape(len(texts), -1)


def gradient(layers: list[np.ndarray], x: np.ndarray, p: int, prior: float) -> list[np.ndarray]:
    """How to go down the non-negative risk of rows x, the first p of them positives, the others unlabelled.

    Where the estimated risk of negatives is below 0, which fitting too closely does, it is that part which is gone back on.
    """
    u = len(x) - p
    hidden = np.tanh(x @ layers[0] + layers[1])
    g = hidden @ layers[2] + layers[3]
    up = 1 / (1 + np.exp(-np.clip(g, -30, 30)))  # derivative of l(-g); that of l(g) is up - 1
    negative = np.mean(np.logaddexp(0, g[p:])) - prior * np.mean(np.logaddexp(0, g[:p]))
    d = np.zeros_like(g)
    if negative >= 0:
        d[:p] = prior * (up[:p] - 1) / p - prior * up[:p] / p
        d[p:] = up[p:] / u
    else:
        d[:p] = prior * up[:p] / p
        d[p:] = -up[p:] / u
    back = np.outer(d, layers[2]) * (1 - hidden**2)
    return [x.T @ back, back.sum(0), hidden.T @ d, np.array([d.sum()])]


class Model:
    """Standardised statistics -> one hidden layer -> log odds."""

    def __init__(self, prior: float):
        self.prior, self.layers = prior, None

    def fit(self, positive: np.ndarray, unlabelled: np.ndarray) -> "Model":
        if not len(positive) or not len(unlabelled):
            return self
        self.mean, self.scale = unlabelled.mean(0), unlabelled.std(0) + 1e-6
        rng = np.random.default_rng(SEED)
        x = self._scaled(np.vstack([positive, unlabelled]))
        p, pi = len(positive), self.prior
        layers = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
        for step in range(1, EPOCHS + 1):
            for i, grad in enumerate(gradient(layers, x, p, pi)):
                grad = grad + DECAY * layers[i] * (i % 2 == 0)
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad**2
                layers[i] = layers[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        self.layers = layers
        return self

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.prior)
        a, b, c, d = self.layers
        return 1 / (1 + np.exp(-np.clip(np.tanh(self._scaled(x) @ a + b) @ c + d, -30, 30)))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, most_p: int = MOST_P, most_u: int = MOST_U) -> Model:
    """docs: doc_id, text; labels: doc_id, quality."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share, n = known.agg(F.avg(F.col("quality").cast("double")), F.count("*")).first()
    # the estimate's lower bound at two standard errors: with too high a prior the least certain negatives would have to pass as positives
    model = Model(0.5 if share is None else min(max(share - 2 * (share * (1 - share) / n) ** 0.5, 0.01), 0.99))
    order = F.xxhash64("doc_id", F.lit(SEED))
    positives = known.where(F.col("quality") == 1).orderBy(order, "doc_id").limit(most_p).select("doc_id", F.lit(1).alias("role"))
    ids = docs.where(F.col("doc_id").isNotNull() & ~held_out()).select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(SEED + 1)), "doc_id").limit(most_u)
    chosen = positives.unionByName(ids.select("doc_id", F.lit(0).alias("role")))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "role": batch["role"], "x": list(_features(batch["text"]))})

    # the chosen ids are bounded by most_p + most_u, and each gives one text, however often it is there
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = met.groupBy("doc_id", "role").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text"))
    sample = one.select(F.col("doc_id").cast("string").alias("doc_id"), "role", "text").mapInPandas(measure, "doc_id string, role int, x array<double>").toPandas()
    sample = sample.assign(key=[tuple(x) for x in sample["x"]]).sort_values(["role", "doc_id", "key"])
    take = lambda role: np.array(sample.loc[sample["role"] == role, "x"].tolist())
    return model.fit(take(1), take(0))


def scored(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """docs with the score of each whole text."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(_features(texts)))

    return docs.withColumn(name, score(F.col(text)))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
