"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are all that is learned from, with an
estimate of the share of positives in the corpus (the class prior).  A small
network is fitted by minimising the non-negative unbiased risk: the risk of the
unlabelled texts as negatives less the part that their positives cause; when
that difference turns negative on a batch (the network is fitting single
texts), the step goes the other way.

Features are figures of the whole text: shares of character classes, words and
their repetition, lines and their repetition.  The sample that is fitted is
bounded (about ``max_positives`` and ``max_unlabelled`` documents, chosen by their
hashed ids) and so is what reaches the driver; every whole text is scored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, ship

MAX_POSITIVES = 4000
MAX_UNLABELLED = 8000
HIDDEN = 16
EPOCHS = 60
BATCH = 512
RATE = 0.01
DECAY = 1e-4

_CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789",
    "space": b" ", "line": b"\n", "other_space": b"\t\r\x0b\x0c", "stop": b".,;:", "ask": b"!?",
    "quote": b"'\"()", "bracket": b"[]{}<>", "bar": b"|", "symbol": b"#$%&*+=@^~_`", "slash": b"/\\-",
}


def features(text: str | None) -> np.ndarray:
    """Figures of a whole text; a null text is an empty one."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = max(1, len(raw))
    shares = [counts[list(chars)].sum() / n for chars in _CLASSES.values()]
    shares.append(counts[128:].sum() / n)
    words = raw.lower().split()
    often = Counter(words)
    w = max(1, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    sizes = np.fromiter(map(len, words), np.float64, len(words))
    pairs = Counter(zip(words, words[1:]))
    p = counts[counts > 0] / n
    caps = sum(1 for x in text.split() if len(x) > 1 and x.isupper())
    return np.array([
        *shares, np.log1p(len(raw)), np.log1p(len(words)), len(often) / w, max(often.values(), default=0) / w,
        (max(pairs.values(), default=0) / w), len(pairs) / w, sum(a == b for a, b in zip(words, words[1:])) / w,
        sizes.mean() if len(sizes) else 0.0, sizes.std() if len(sizes) else 0.0, sizes.max(initial=0.0) / 100,
        len(set(lines)) / max(1, len(lines)), np.log1p(len(lines)), np.log1p(len(raw) / max(1, len(lines))),
        -(p * np.log2(p)).sum(), caps / w])


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]       # hidden weights and biases, output weights and bias
    prior: float

    def prepared(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-_forward(self.weights, self.prepared(x))[1]))


def _forward(w: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(x @ w[0] + w[1])
    return hidden, np.clip(hidden @ w[2] + w[3][0], -30, 30)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 5) -> QualityModel:
    """Minimise the non-negative unbiased risk with the logistic loss (Adam)."""
    both = np.concatenate([positive, unlabelled])
    model = QualityModel(both.mean(axis=0), both.std(axis=0) + 1e-6, [], prior)
    rng = np.random.default_rng(seed)
    d = both.shape[1]
    w = [rng.standard_normal((d, HIDDEN)) / np.sqrt(d), np.zeros(HIDDEN), rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)]
    m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    p_all, u_all = model.prepared(positive), model.prepared(unlabelled)
    for _ in range(EPOCHS):
        order = rng.permutation(len(u_all))
        for at in range(0, len(order), BATCH):
            u = u_all[order[at: at + BATCH]]
            p = p_all[rng.integers(0, len(p_all), min(BATCH, max(1, len(p_all))))]
            x = np.concatenate([p, u])
            hidden, z = _forward(w, x)
            s = _sigmoid(z)
            n_p, n_u = len(p), len(u)
            as_negative = np.logaddexp(0, z)        # loss of a text taken for a negative
            rest = as_negative[n_p:].mean() - prior * as_negative[:n_p].mean()
            slope = np.zeros(len(x))
            if rest >= 0:
                slope[:n_p] = prior * ((s[:n_p] - 1) - s[:n_p]) / n_p
                slope[n_p:] = s[n_p:] / n_u
            else:
                slope[:n_p] = prior * s[:n_p] / n_p
                slope[n_p:] = -s[n_p:] / n_u
            back = slope[:, None] * w[2][None, :] * (1 - hidden ** 2)
            grads = [x.T @ back + DECAY * w[0], back.sum(axis=0), hidden.T @ slope + DECAY * w[2], np.array([slope.sum()])]
            t += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - RATE * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    model.weights = w
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_positives: int = MAX_POSITIVES, max_unlabelled: int = MAX_UNLABELLED) -> QualityModel:
    """Fit on documents whose label is 1 and on unlabelled ones (any documents).

    A document with several labels is positive if all are 1; null ids and labels
    are left out.  The prior is the share of positives among the labelled, with one
    added to either side.  Without positives or without documents the model scores
    every text with the prior."""
    ship(docs.sparkSession)
    labelled = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
                .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("y")))
    n = labelled.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") == 1).alias("p")).first()
    prior = (n["p"] + 1) / (n["n"] + 2)
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = bounded_sample(labelled.where("y = 1").select("id"), max_positives, "id").withColumn("positive", F.lit(True))
    other = bounded_sample(texts.select("id"), max_unlabelled, "id").distinct().withColumn("free", F.lit(True))
    chosen = known.join(other, "id", "full")        # at most twice max_positives + max_unlabelled rows

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "positive": b["positive"].fillna(False).astype(bool),
                                "free": b["free"].fillna(False).astype(bool), "x": [features(t) for t in b["text"]]})

    id_type = texts.schema["id"].dataType.simpleString()
    found = (texts.join(F.broadcast(chosen), "id")
             .mapInPandas(compute, f"id {id_type}, positive boolean, free boolean, x array<double>")
             .groupBy("id", "positive", "free").agg(F.min("x").alias("x")).orderBy("id").toPandas())
    width = len(features(""))
    x = np.stack(found["x"]) if len(found) else np.zeros((0, width))
    positive, free = found["positive"].to_numpy(bool), found["free"].to_numpy(bool)
    if not positive.any() or not free.any():
        return QualityModel(np.zeros(width), np.ones(width), [], prior)
    return train(x[positive], x[free], prior)


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is good as ``out`` (0 to 1).

    Null and empty texts are scored as empty texts; an input column named ``out`` is
    replaced, all others stay; an empty table stays empty."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = [features(t.as_py()) for t in batch]
            yield pa.array(shared.value.scores(np.stack(x)) if x else np.zeros(0))

    return docs.withColumn(out, scores(F.col(text_col)))
