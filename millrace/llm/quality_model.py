"""Quality classifier: ordinal cumulative-link regression on hashed text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import BLANK_WORDS, Words, map_batches, mix, pieces, texts

#: Rows that the model is fitted on at most: those with the smallest hash of their id.
MAX_ROWS = 8000
#: Hashed features: 2 to this power.
WIDTH = 18
#: Lengths in bytes of the word beginnings that are features.
PREFIXES = (4, 5)
ROUNDS, RATE, DECAY = 250, 0.05, 2e-4


def features(data: bytes, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's features: beginnings and the last two bytes of its words, hashed, each with
    the logarithm of 1 + its count, relative to the length of the whole vector."""
    shift, found = np.uint64(64 - width), []
    for _, part in pieces(data.lower(), BLANK_WORDS):
        words = Words(part, BLANK_WORDS)
        a, b = words.starts, words.ends
        if not len(a):
            continue
        kinds = []
        for n in PREFIXES:
            long = b - a >= n
            kinds.append(mix(words.hashes(a[long], a[long] + n) + np.uint64(n)))
        kinds.append(mix(words.hashes(np.maximum(a, b - 2), b) + np.uint64(99)))
        found += [(h * np.uint64(0x9E3779B97F4A7C15)) >> shift for h in kinds]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0)
    at, counts = np.unique(np.concatenate(found).astype(np.int64), return_counts=True)
    values = np.log1p(counts)
    return at, values / np.sqrt((values ** 2).sum())


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class OrdinalModel:
    """P(grade >= j) = sigmoid(score - thresholds[j - 1]): one set of weights, ordered thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray
    width: int = WIDTH

    def score(self, data: bytes) -> float:
        at, values = features(data, self.width)
        return float(self.weights[at] @ values) if len(at) else 0.0

    def tails(self, scores) -> np.ndarray:
        """Column j - 1: P(grade >= j)."""
        return _sigmoid(np.asarray(scores, float)[:, None] - self.thresholds[None, :])


def fit_ordinal(rows: list[tuple[bytes, int]], grades: int, width: int = WIDTH, rounds: int = ROUNDS, rate: float = RATE,
                decay: float = DECAY) -> OrdinalModel:
    """Fit by maximum likelihood (Adam on all rows, grades weighted by the root of their inverse share).

    The first threshold is free, the others are sums of positive steps, so their order holds.  Without
    rows, or with one grade only, the weights are zero and the thresholds follow the shares.
    """
    y = np.array([g for _, g in rows], np.int64)
    share = (np.bincount(y, minlength=grades) + 1) / (len(y) + grades)
    above = 1 - np.cumsum(share)[:-1]
    theta = -np.log(above / (1 - above))
    theta = np.maximum.accumulate(theta + 1e-3 * np.arange(grades - 1))
    if len(set(y.tolist())) < 2:
        return OrdinalModel(np.zeros(1 << width), theta, width)
    sizes, at, values = [], [], []
    for data, _ in rows:
        found, worth = features(data, width)
        sizes.append(len(found))
        at.append(found.astype(np.int32))
        values.append(worth.astype(np.float32))
    row = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
    at, values = np.concatenate(at), np.concatenate(values)
    used = np.zeros(1 << width, bool)
    used[at] = True
    places = np.flatnonzero(used)
    at = (np.cumsum(used, dtype=np.int32) - 1)[at]
    importance = (1 / np.sqrt(share))[y]
    importance /= importance.mean() * len(y)
    state = np.zeros(len(places) + grades - 1)
    state[len(places)] = theta[0]
    state[len(places) + 1:] = np.log(np.maximum(np.diff(theta), 1e-3))
    m, v, scale = np.zeros_like(state), np.zeros_like(state), 30.0
    for step in range(1, rounds + 1):
        w, steps = state[:len(places)], np.exp(state[len(places) + 1:])
        theta = state[len(places)] + np.concatenate([[0], np.cumsum(steps)])
        score = scale * np.bincount(row, weights=w[at] * values, minlength=len(rows))
        tail = np.concatenate([np.ones((len(y), 1)), _sigmoid(score[:, None] - theta), np.zeros((len(y), 1))], axis=1)
        index = np.arange(len(y))
        chance = np.maximum(tail[index, y] - tail[index, y + 1], 1e-12)
        slope = tail * (1 - tail)  # of each tail by the score; 0 at both ends
        by_score = -importance * (slope[index, y] - slope[index, y + 1]) / chance
        by_theta = np.zeros((len(y), grades + 1))
        by_theta[index, y] += importance * slope[index, y] / chance
        by_theta[index, y + 1] -= importance * slope[index, y + 1] / chance
        by_theta = by_theta.sum(0)[1:grades]
        gradient = np.concatenate([
            scale * np.bincount(at, weights=by_score[row] * values, minlength=len(places)) + decay * w,
            [by_theta.sum()], steps * by_theta[::-1].cumsum()[::-1][1:]])
        m += 0.1 * (gradient - m)
        v += 0.01 * (gradient ** 2 - v)
        state -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    weights = np.zeros(1 << width)
    weights[places] = scale * state[:len(places)]
    return OrdinalModel(weights, state[len(places)] + np.concatenate([[0], np.cumsum(np.exp(state[len(places) + 1:]))]), width)


def train_quality(docs: DataFrame, labels: DataFrame, grade: Column, grades: int, id_col: str = "doc_id",
                  text_col: str = "text", max_rows: int = MAX_ROWS) -> OrdinalModel:
    """The model of graded rows: ``grade`` is 0 .. ``grades`` - 1 over the columns of ``labels``.

    Rows without an id, grade or text don't count; of several grades of one id the lowest does.  At most
    ``max_rows`` rows reach the driver: those whose ids have the smallest hashes.
    """
    graded = (labels.select(F.col(id_col).alias("__id"), grade.cast("int").alias("__grade"))
              .where(F.col("__id").isNotNull() & F.col("__grade").between(0, grades - 1))
              .groupBy("__id").agg(F.min("__grade").alias("__grade")))
    known = docs.select(F.col(id_col).alias("__id")).distinct()
    chosen = graded.join(known, "__id", "left_semi").orderBy(F.xxhash64("__id"), "__id").limit(max_rows)
    rows = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("binary").alias("__text"))
            .where(F.col("__text").isNotNull()).join(F.broadcast(chosen), "__id")
            .groupBy("__id", "__grade").agg(F.min("__text").alias("__text")).orderBy("__id").select("__text", "__grade").collect())
    return fit_ordinal([(bytes(r[0]), r[1]) for r in rows], grades)


def grade_documents(docs: DataFrame, model: OrdinalModel, at_least: int | None = None, least_tail: float = 0.5,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, expected (grade), tail = P(grade >= ``at_least``), kept = tail >= ``least_tail``.

    ``at_least`` is the highest grade if not given.  Whole texts are scored; a null or empty text has
    score 0, so the thresholds alone judge it.  Repeated rows come back as they came.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    level = len(model.thresholds) if at_least is None else at_least

    def make():
        model = shared.value

        def grade(batch):
            scores = [model.score(t) for t in batch["text"]]
            tails = model.tails(scores)
            tail = tails[:, level - 1]
            return {"doc_id": batch["doc_id"], "score": scores, "expected": tails.sum(1).tolist(), "tail": tail.tolist(),
                    "kept": (tail >= least_tail).tolist()}
        return grade

    kind = dict(docs.dtypes)[id_col]
    return map_batches(texts(docs, id_col, text_col), make,
                       f"doc_id {kind}, score double, expected double, tail double, kept boolean").withColumnRenamed("doc_id", id_col)
