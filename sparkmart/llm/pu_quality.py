"""Quality classification from trusted positives and unlabelled web text.

Positive-unlabelled learning: with the class prior p, the risk on negatives is the risk of the
unlabelled texts as negatives less p times that of the positives as negatives.  Where this
estimate falls below zero the model has overfitted, and the step goes the other way (the
non-negative risk estimator).  A small network over features of the whole text minimises it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import appended, hold, share_of_ids, written

#: Bounds of the training sample: documents to expect in it.
MAX_POSITIVE, MAX_UNLABELLED = 4000, 8000
THRESHOLD = 0.7

#: Classes of characters, whose pairs are counted; letters, digits and spaces come before them.
MARKS = (".", ",", ";:", "!", "?", "'\"()-", "#*$%&", "|", "<>@/\\_=+")
N_CLASSES = 7 + len(MARKS)
N_PAIRS = N_CLASSES * N_CLASSES
N_FEATURES = N_PAIRS + 8


def _class_table() -> np.ndarray:
    table = np.zeros(256, dtype=np.int64)  # 0: other characters
    for c in range(256):
        x = chr(c)
        table[c] = 1 if x.islower() else 2 if x.isupper() else 3 if x.isdigit() else 4 if x in " \t\r\f\v" else 5 if x == "\n" else 0
    for i, some in enumerate(MARKS):
        for x in some:
            table[ord(x)] = 7 + i
    return table


_CLASSES = _class_table()
_SEGMENT = 2**18


def features(text: str) -> np.ndarray:
    """Of the whole text: shares of pairs of character classes, and figures of its words and lines."""
    out = np.zeros(N_FEATURES, dtype=np.float32)
    if not text:
        return out
    pairs = np.zeros(N_PAIRS)
    for at in range(0, len(text), _SEGMENT):
        codes = np.frombuffer(text[at : at + _SEGMENT + 1].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        classes = np.where(codes < 256, _CLASSES[np.minimum(codes, 255)], 6)
        pairs += np.bincount(classes[:-1] * N_CLASSES + classes[1:], minlength=N_PAIRS)
    out[:N_PAIRS] = np.sqrt(pairs / max(1.0, pairs.sum()))
    words, lines = text.split(), [x for x in text.split("\n") if x]
    n = max(1, len(words))
    out[N_PAIRS:] = (
        np.log1p(len(words)),
        len("".join(words)) / n / 10,
        sum(map(eq, words, words[1:])) / n,
        sum(map(eq, words, words[2:])) / n,
        len(set(words)) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(len(lines)),
        min(1.0, 50 / n) * len(set(words)) / n,
    )
    return out


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh(((x - self.mean) / self.scale) @ self.hidden + self.hidden_bias)
        return 1 / (1 + np.exp(-np.clip(h @ self.out + self.bias, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 7, epochs: int = 40) -> QualityModel:
    """Minimise the non-negative risk with logistic loss by Adam."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled]).astype(np.float64)
    mean, scale = both.mean(axis=0), both.std(axis=0) + 0.02
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    width = 24
    w = [rng.normal(0, 1 / np.sqrt(p.shape[1]), (p.shape[1], width)), np.zeros(width), rng.normal(0, 0.3, width), np.zeros(1)]
    first, second = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    steps, size = 0, 512
    for _ in range(epochs):
        for _ in range(max(1, len(u) // size)):
            xp, xu = p[rng.integers(0, len(p), size // 2)], u[rng.integers(0, len(u), size)]
            x = np.concatenate([xp, xu])
            h = np.tanh(x @ w[0] + w[1])
            g = np.clip(h @ w[2] + w[3], -30, 30)
            s = 1 / (1 + np.exp(-g))
            loss = np.logaddexp(0, g)
            n_p, n_u = len(xp), len(xu)
            negative_risk = loss[n_p:].mean() - prior * loss[:n_p].mean()
            if negative_risk >= 0:
                dg = np.concatenate([np.full(n_p, -prior / n_p), s[n_p:] / n_u])
            else:
                dg = np.concatenate([prior * s[:n_p] / n_p, -s[n_p:] / n_u])
            dh = np.outer(dg, w[2]) * (1 - h * h)
            grads = [x.T @ dh, dh.sum(axis=0), h.T @ dg, np.array([dg.sum()])]
            steps += 1
            for i, grad in enumerate(grads):
                grad = grad + (2e-4 * w[i] if i % 2 == 0 else 0)
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad**2
                w[i] = w[i] - 3e-3 * (first[i] / (1 - 0.9**steps)) / (np.sqrt(second[i] / (1 - 0.999**steps)) + 1e-8)
    return QualityModel(mean, scale, w[0], w[1], w[2], float(w[3][0]), prior)


def _vectors(batches) -> Iterator:
    import pyarrow as pa

    hold()
    for batch in batches:
        vectors = [features(t or "").tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("positive"), pa.array(vectors, pa.binary())], names=["doc_id", "positive", "vector"])


def train(docs: DataFrame, labels: DataFrame, positives: int = MAX_POSITIVE, unlabelled: int = MAX_UNLABELLED) -> QualityModel | None:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality), both already restricted.

    Labels of documents that are not in ``docs`` count for nothing.
    Trusted positives are documents with label 1 (of several labels, the greatest); the
    unlabelled texts are a sample of all documents.  The prior is the smoothed share of label 1
    among the labels, which is the only use of label 0.  Both samples take ids by a hash and
    are bounded by parameters.  None if there is no positive or no document.
    """
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    marked = written(marked.join(docs.select("doc_id"), "doc_id", "left_semi"), "labels")
    counts = {r["quality"]: r["n"] for r in marked.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    n_docs = docs.count()
    n_positive = counts.get(1, 0)
    if not n_positive or not n_docs:
        return None
    prior = (n_positive + 1) / (sum(counts.values()) + 2)
    texts = docs.select("doc_id", "text")
    chosen = marked.where((F.col("quality") == 1) & (share_of_ids("doc_id", 3) < positives / n_positive)).select("doc_id")
    trusted = texts.join(F.broadcast(chosen), "doc_id").withColumn("positive", F.lit(True))
    drawn = texts.where(share_of_ids("doc_id", 4) < unlabelled / n_docs).withColumn("positive", F.lit(False))
    found = (
        trusted.unionByName(drawn).mapInArrow(_vectors, "doc_id long, positive boolean, vector binary").toPandas().sort_values(["positive", "doc_id", "vector"])
    )
    x = np.frombuffer(b"".join(found["vector"]), dtype=np.float32).reshape(-1, N_FEATURES)
    is_positive = found["positive"].to_numpy(dtype=bool)
    if not is_positive.any() or is_positive.all():
        return None
    return fit(x[is_positive], x[~is_positive], prior)


def classify(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """All rows with score and predicted, which replace columns of these names.

    Null text is scored as empty text.  Without a model every document has score 1: nothing
    is known against it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch):
        hold()
        model, texts = shared.value, batch.column("text").to_pylist()
        if model is None:
            score = np.ones(len(texts))
        else:
            score = model.score(np.stack([features(t or "") for t in texts]))
        return [score, (score >= THRESHOLD).astype(np.int32)]

    return appended(docs, [("score", "double"), ("predicted", "int")], compute)
