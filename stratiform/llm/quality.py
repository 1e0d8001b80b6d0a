"""Quality classifier: Bradley-Terry ranking of documents from preference pairs.

Every document becomes a small vector of shape features (lengths, character classes, repeats). Of the
labelled training documents, pairs of a better and a worse one are drawn, and weights are fitted by
logistic loss on the difference of their features, so that w·x is the document's strength in a
Bradley-Terry model. The threshold is a quantile of the training strengths, namely the share of documents
labelled bad; the score is the logistic of the distance to it, moved so that the threshold scores `CUT`.

The fit uses at most `MAX_TRAINING` labelled documents (the smallest id hashes) and `PAIRS_PER_DOCUMENT`
pairs for each; only their feature vectors reach the driver. Scoring reads every whole text and shuffles
nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.llm.common import field, map_texts, table, text_bytes

MAX_TRAINING = 20_000
PAIRS_PER_DOCUMENT = 16
RIDGE = 1e-3
CUT = 0.7

#: Character classes whose shares are features.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "space": b" \t",
    "newline": b"\n",
    "stop": b".,;:",
    "shout": b"!?",
    "mark": b"#*$%&",
    "bar": b"|<>\\/",
    "bracket": b"(){}[]=_+@~^`\"'-",
    "other": bytes(range(128, 256)),
}
CLASS_MATRIX = np.array([[c in members for members in CLASSES.values()] for c in range(256)], np.float64)
FEATURES = (
    "words", "characters", "word_length", "distinct_words", "same_as_before", "repeated_pairs", "lines",
    "words_per_line", "repeated_lines", "capital_starts", "marked_words", *CLASSES,
)


def features(texts: list[bytes]) -> np.ndarray:
    """One row per text. Shares are scaled as log(1 + 100 x), counts as log(1 + x); an empty text is all zero."""
    counts = np.zeros((len(texts), 256))
    out = np.zeros((len(texts), 11))
    for i, text in enumerate(texts):
        if not text:
            continue
        counts[i] = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        words = text.split()
        lines = [x for x in text.split(b"\n") if x.strip()]
        n, m = max(1, len(words)), max(1, len(lines))
        pairs = list(zip(words, words[1:]))
        out[i] = (
            np.log1p(len(words)),
            np.log1p(len(text)),
            np.log1p(len(text) / n),
            len(set(words)) / n,
            sum(map(bytes.__eq__, words, words[1:])) / n,
            1 - len(set(pairs)) / max(1, len(pairs)),
            np.log1p(len(lines)),
            np.log1p(n / m),
            1 - len(set(lines)) / m,
            sum(w[:1].isupper() for w in words) / n,
            sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / n,
        )
    shares = counts @ CLASS_MATRIX / np.maximum(1, counts.sum(1, keepdims=True))
    for k in (3, 4, 5, 8, 9, 10):
        out[:, k] = np.log1p(100 * out[:, k])
    return np.hstack([out, np.log1p(100 * shares)])


@dataclass
class Ranking:
    """Strength w·(x - centre) / spread; `threshold` and `unit` turn it into a score."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    unit: float
    cut: float = CUT

    def strength(self, x: np.ndarray) -> np.ndarray:
        return (np.clip((x - self.centre) / self.spread, -8, 8)) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        logit = (self.strength(x) - self.threshold) / self.unit + np.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit_pairs(better: np.ndarray, worse: np.ndarray, ridge: float = RIDGE, rounds: int = 50) -> np.ndarray:
    """Weights that minimise the mean of log(1 + exp(-w·(better - worse))) plus a ridge, by Newton steps."""
    d = better - worse
    w = np.zeros(d.shape[1])

    def loss(v: np.ndarray) -> float:
        return float(np.logaddexp(0, -(d @ v)).mean() + ridge * (v @ v))

    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        gradient = -(d * p[:, None]).mean(0) + 2 * ridge * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + 2 * ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def fit(x: np.ndarray, good: np.ndarray, seed: int = 7) -> Ranking:
    """A ranking from feature rows and their labels; with one label only, all strengths are equal."""
    if not len(x) or good.all() or not good.any():
        width = x.shape[1] if x.ndim == 2 else len(FEATURES)
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 1.0)
    centre, spread = x.mean(0), x.std(0)
    spread[spread < 1e-9] = 1.0
    z = np.clip((x - centre) / spread, -8, 8)
    random = np.random.default_rng(seed)
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    n = PAIRS_PER_DOCUMENT * min(len(up), len(down)) + max(len(up), len(down))
    # Every document of either label takes part before any is drawn again.
    better = up[random.permutation(n) % len(up)]
    worse = down[random.permutation(n) % len(down)]
    weights = fit_pairs(z[better], z[worse])
    strength = z @ weights
    ranked = np.sort(strength)
    share = int((~good).sum())
    threshold = float((ranked[share - 1] + ranked[share]) / 2)
    unit = float(np.median(strength[up]) - np.median(strength[down])) / 8
    return Ranking(centre, spread, weights, threshold, max(unit, 1e-9))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", max_training: int = MAX_TRAINING) -> Ranking:
    """Fit on labelled documents that are not held out; rows without id, label or document are left out."""
    chosen = (
        labels.select(field(labels, doc_id).alias("id"), field(labels, "quality").alias("quality"))
        .where(F.col("id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("id")))
        .orderBy(F.xxhash64("id"), "id", "quality")
        .limit(max_training)
    )
    known = docs.select(field(docs, doc_id).alias("id"), field(docs, text).alias("text")).join(F.broadcast(chosen), "id")
    rows = vectors(known, "text").select("id", "quality", "features").orderBy(F.xxhash64("id"), "id", "quality").limit(max_training).toPandas()
    x = np.array(rows["features"].tolist(), np.float64).reshape(len(rows), len(FEATURES))
    return fit(x, rows["quality"].to_numpy() == 1)


def vectors(docs: DataFrame, text: str) -> DataFrame:
    derived = T.StructType([T.StructField("features", T.ArrayType(T.DoubleType()))])
    return map_texts(docs, text, derived, lambda texts: {"features": list(features(text_bytes(texts)))})


def score_documents(docs: DataFrame, ranking: Ranking, text: str = "text") -> DataFrame:
    """`docs` with score and predicted (1 from the cut on).

    Null and empty texts are scored like any other, from features that are all zero. Repeated rows get equal
    scores. Input columns named score or predicted are replaced.
    """
    derived = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(texts: pa.Array) -> dict[str, object]:
        score = ranking.score(features(text_bytes(texts)))
        return {"score": score, "predicted": (score >= ranking.cut).astype(np.int32)}

    return map_texts(docs, text, derived, run)


def op2_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranking = train(docs, table(spark, sf_dir, "labels"))
    scored = score_documents(docs, ranking)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts."""
    scored = score_documents(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.where(F.col("predicted") == 1).select(*docs.columns)
