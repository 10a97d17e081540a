"""Quality classifier: a factorisation machine over hashed words, structure and length.

The score of a text is ``sigmoid(b + w.x + 1/2 sum_f((V_f.x)^2 - V_f^2.x^2))``: every pair of
features interacts through two low-rank vectors, and the sum-of-squares identity makes a
score linear in the number of features. Features are the text's hashed words (log counts
of unit length), statistics of its structure and its length; nothing else of a row is read.

Nulls and empty texts have no words and zero statistics, and get the score of that
feature vector. Repeated rows get equal scores. Labels without a value or a document are
ignored, repeated labels of a document count as their mean. Without any label every text
scores 0.5; with one kind of label only, the score is near that label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import LOWER, SEPARATORS, chunks, text_of, word_hashes, words_of

BUCKETS = 1 << 14
RANK = 8
#: Labelled rows that a model is fitted on at most, those of least id hash: they and their
#: features fit in the driver. Scoring covers every row.
MAX_FIT_ROWS = 6_000
ACCEPT = 0.3

STATISTICS = (
    "upper", "digit", "other", "non_ascii", "blank", "word_length", "distinct", "top_share",
    "bare_punctuation", "repeat_next", "line_words", "log_words", "log_bytes",
)
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
OTHER = np.ones(256, bool)
OTHER[128:] = OTHER[48:58] = OTHER[65:91] = OTHER[97:123] = False
OTHER &= ~SEPARATORS


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(np.float64)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, bucket and value of each hashed word, and one row of statistics per text."""
    data, starts, ends, first = words_of(texts, lower=False)
    n = len(texts)
    bounds = np.zeros(n + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    size = np.maximum(bounds[1:] - bounds[:-1] - 1, 1)
    count = (first[1:] - first[:-1]).astype(np.float64)
    words = np.maximum(count, 1)
    hashes = word_hashes(LOWER[data], starts, ends)
    owner = np.repeat(np.arange(n), first[1:] - first[:-1])

    key = (owner.astype(np.uint64) << np.uint64(14)) | (hashes & np.uint64(BUCKETS - 1))
    cell, times = np.unique(key, return_counts=True)
    text, bucket = (cell >> np.uint64(14)).astype(np.int64), (cell & np.uint64(BUCKETS - 1)).astype(np.int64)
    value = 1 + np.log(times)
    norm = np.sqrt(np.bincount(text, value * value, minlength=n))
    value = value / norm[text]

    again = np.zeros(len(hashes), bool)
    if len(hashes) > 1:
        again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    top = np.zeros(n)
    np.maximum.at(top, text, times)
    bare = OTHER[data[starts]] & OTHER[data[np.maximum(ends - 1, 0)]]
    stats = np.stack([
        _per_text(UPPER[data], bounds) / size, _per_text(DIGIT[data], bounds) / size,
        _per_text(OTHER[data], bounds) / size, _per_text(data >= 128, bounds) / size,
        np.maximum(_per_text(SEPARATORS[data], bounds) - 1, 0) / size,
        np.bincount(owner, ends - starts, minlength=n) / words / 10,
        np.bincount(text, minlength=n) / words, top / words,
        np.bincount(owner, bare, minlength=n) / words, np.bincount(owner, again, minlength=n) / words,
        np.log1p(words / (_per_text(data == 10, bounds) + 1)) / 5, np.log1p(count) / 10, np.log(size) / 10,
    ], axis=1)
    stats[count == 0] = 0
    return text, bucket, value, stats


class Model:
    """Weights of words and statistics: column 0 is linear, the others are the low-rank part."""

    def __init__(self, bias: float, weights: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        self.bias, self.weights, self.mean, self.scale = bias, weights, mean, scale

    def margin(self, text, bucket, value, stats) -> np.ndarray:
        n = len(stats)
        dense = (stats - self.mean) / self.scale
        tail = self.weights[BUCKETS:]
        sums, squares = dense @ tail, (dense * dense) @ (tail * tail)
        got = self.weights[bucket] * value[:, None].astype(np.float32)
        for f in range(got.shape[1]):
            sums[:, f] += np.bincount(text, got[:, f], minlength=n)
            if f:
                squares[:, f] += np.bincount(text, got[:, f] * got[:, f], minlength=n)
        return self.bias + sums[:, 0] + 0.5 * (sums[:, 1:] ** 2 - squares[:, 1:]).sum(1)

    def score(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros(len(texts))
        for a, b in chunks(texts):
            out[a:b] = 1 / (1 + np.exp(-np.clip(self.margin(*features(texts[a:b])), -30, 30)))
        return out


def _fit(rows: list, epochs: int = 12, batch: int = 128, rate: float = 0.08, decay: float = 1e-4) -> Model:
    """Adagrad on the logistic loss over the bounded sample."""
    width = BUCKETS + len(STATISTICS)
    rng = np.random.RandomState(11)
    weights = np.zeros((width, 1 + RANK), np.float32)
    zero, one = np.zeros(len(STATISTICS)), np.ones(len(STATISTICS))
    if not rows:
        return Model(0.0, weights, zero, one)
    weights[:, 1:] = rng.normal(0, 0.02, (width, RANK))
    y = np.array([r["y"] for r in rows])
    stats = np.stack([np.frombuffer(r["stats"], np.float64) for r in rows])
    mean, scale = stats.mean(0), stats.std(0) + 1e-3
    buckets = [np.frombuffer(r["buckets"], np.int32) for r in rows]
    values = [np.frombuffer(r["vals"], np.float32) for r in rows]
    share = min(max(y.mean(), 0.02), 0.98)
    model = Model(float(np.log(share / (1 - share))), weights, mean, scale)
    seen, bias_seen = np.full(weights.shape, 1e-2, np.float32), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            part = order[at : at + batch]
            text = np.repeat(np.arange(len(part)), [len(buckets[i]) for i in part])
            bucket = np.concatenate([buckets[i] for i in part]).astype(np.int64)
            value = np.concatenate([values[i] for i in part])
            error = 1 / (1 + np.exp(-np.clip(model.margin(text, bucket, value, stats[part]), -30, 30))) - y[part]
            error = error / len(part)
            dense = (stats[part] - mean) / scale
            tail = weights[BUCKETS:]
            sums = dense @ tail
            got = weights[bucket] * value[:, None]
            for f in range(1, 1 + RANK):
                sums[:, f] += np.bincount(text, got[:, f], minlength=len(part))
            slope = np.zeros_like(weights)
            pull = error[text] * value
            for f in range(1 + RANK):
                own = pull if f == 0 else pull * (sums[text, f] - got[:, f])
                slope[:BUCKETS, f] = np.bincount(bucket, own, minlength=BUCKETS)
                if f == 0:
                    slope[BUCKETS:, 0] = dense.T @ error
                else:
                    slope[BUCKETS:, f] = dense.T @ (error * sums[:, f]) - ((dense**2).T @ error) * tail[:, f]
            slope += decay * weights * (slope != 0)
            seen += slope * slope
            weights -= (rate * slope / np.sqrt(seen)).astype(np.float32)
            bias_seen += error.sum() ** 2
            model.bias -= rate * error.sum() / np.sqrt(bias_seen)
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_FIT_ROWS) -> Model:
    """A model of the labelled documents; ``labels`` has ``doc_id`` and a 0/1 column."""
    ids = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("double").alias("_y")).dropna()
    ids = ids.groupBy("_id").agg((F.avg("_y") >= 0.5).cast("double").alias("_y"))
    ids = ids.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, rows = [t.encode() for t in pdf["text"]], []
            for a, b in chunks(texts):
                text, bucket, value, stats = features(texts[a:b])
                cut = np.searchsorted(text, np.arange(b - a + 1))
                for i in range(b - a):
                    own = slice(cut[i], cut[i + 1])
                    rows.append((bucket[own].astype(np.int32).tobytes(), value[own].astype(np.float32).tobytes(), stats[i].tobytes()))
            yield pd.DataFrame(rows, columns=["buckets", "vals", "stats"]).assign(id=pdf["id"].values, y=pdf["y"].values)

    chosen = docs.select(F.col("doc_id").alias("id"), text_of().alias("text")).join(F.broadcast(ids), F.col("id") == F.col("_id"))
    # A text that repeats under one id is learned once; its repeats go before features are made.
    chosen = chosen.groupBy("id", F.sha2(F.col("text").cast("binary"), 256).alias("_text")).agg(F.first("_y").alias("y"), F.first("text").alias("text"))
    rows = chosen.select("id", "y", "text").mapInPandas(reduced, "buckets binary, vals binary, stats binary, id long, y double")
    own = {(r["id"], r["buckets"], r["stats"]): r for r in rows.collect()}
    return _fit([own[k] for k in sorted(own)])


def score(model: Model, text: Column) -> Column:
    """Score of each text, 0 to 1."""

    @F.pandas_udf("double")
    def scored(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            yield pd.Series(model.score([t.encode() for t in texts]))

    return scored(text)
