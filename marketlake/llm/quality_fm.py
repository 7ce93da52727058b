"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f [(sum v_if x_i)^2 - sum v_if^2 x_i^2]):
all pairwise interactions at rank RANK in time linear in a document's features
(the sum-of-squares identity).

The model is fitted on a sample of labelled rows bounded by TRAIN_ROWS (rows of
least id hash), whose features are computed on the executors; it has
(BUCKETS + statistics) * (RANK + 1) numbers, whatever the corpus, and is
broadcast.  Scoring is one pass over the whole texts without a shuffle.

Defined results: null or empty text: no words, statistics of nothing, scored all
the same; null or missing n_chars: the text's own length; null labels are ignored, repeated labels vote
(a draw counts as 1); of documents with one id the least by text hash is learned from; null ids are never held out nor learned from; no usable
labels: every score 0.5 (one class only: its rate, smoothed); repeated rows score alike; empty
table: no rows; other columns are not read.
"""

from __future__ import annotations

import sys
from collections import Counter
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType

from .shared import col

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: labelled rows the model is fitted on, at most
TRAIN_ROWS = 8192
BUCKETS = 1 << 16
RANK = 8
EPOCHS = 6
BATCH = 128
RATE = 0.08
DECAY = 1e-5
SEED = 7

STATISTICS = ("words", "word_length", "upper", "digits", "symbols", "bars", "shouts", "points", "distinct_words",
              "repeated_lines", "line_words", "characters")
UPPER, DIGITS = bytes(range(65, 91)), b"0123456789"


def features(text: str | None, n_chars: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, their values, statistics) of a document."""
    raw = (text or "").encode("utf-8", "replace")
    size = max(1, len(raw))
    words = Counter(raw.lower().split())
    total = sum(words.values())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    count = lambda chars: (len(raw) - len(raw.translate(None, chars))) / size
    chars = len(text or "") if n_chars is None or n_chars != n_chars else max(0.0, n_chars)
    stats = np.array([
        np.log1p(total), sum(map(len, words)) / max(1, len(words)), count(UPPER), count(DIGITS), count(b"#*$%&<>@^~{}"),
        count(b"|"), count(b"!?"), count(b".,;:"), len(words) / max(1, total),
        1 - len(set(lines)) / max(1, len(lines)), np.log1p(total / max(1, len(lines))), np.log1p(chars)])
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32), stats
    bucket = np.fromiter((crc32(w) for w in words), dtype=np.int64, count=len(words)) % BUCKETS
    value = np.log1p(np.fromiter(words.values(), dtype=np.float64, count=len(words)))
    bucket, where = np.unique(bucket, return_inverse=True)
    value = np.bincount(where, weights=value)
    return bucket.astype(np.int32), (value / np.linalg.norm(value)).astype(np.float32), stats


class FactorisationMachine:
    def __init__(self, seed: int = SEED):
        n = BUCKETS + len(STATISTICS)
        self.bias = 0.0
        self.linear = np.zeros(n)
        self.factors = np.random.default_rng(seed).normal(0, 0.01, (n, RANK))
        self.mean, self.spread = np.zeros(len(STATISTICS)), np.ones(len(STATISTICS))

    def inputs(self, bucket, value, stats):
        """Feature numbers and values of one document."""
        scaled = np.clip((stats - self.mean) / self.spread, -4, 4) / 2
        return (np.concatenate([bucket, np.arange(BUCKETS, BUCKETS + len(STATISTICS))]),
                np.concatenate([value.astype(np.float64), scaled]))

    def margin(self, at, x) -> float:
        v = self.factors[at]
        one, two = x @ v, (x * x) @ (v * v)
        return self.bias + float(x @ self.linear[at]) + 0.5 * float((one * one - two).sum())

    def score(self, bucket, value, stats) -> float:
        return 1 / (1 + float(np.exp(-np.clip(self.margin(*self.inputs(bucket, value, stats)), -30, 30))))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray) -> "FactorisationMachine":
        """Mini-batch AdaGrad on the logistic loss."""
        stats = np.array([r[2] for r in rows])
        self.mean, self.spread = stats.mean(axis=0), stats.std(axis=0) + 1e-6
        docs = [self.inputs(*r) for r in rows]
        rate = np.clip(labels.mean(), 0.5 / (len(labels) + 1), 1 - 0.5 / (len(labels) + 1))
        self.bias = float(np.log(rate / (1 - rate)))
        if labels.min() == labels.max():
            self.factors[:] = 0
            return self
        rng = np.random.default_rng(SEED)
        square_l, square_f, square_b = np.full(len(self.linear), 1e-3), np.full(self.factors.shape, 1e-3), 1e-3
        for _ in range(EPOCHS):
            order = rng.permutation(len(docs))
            for begin in range(0, len(order), BATCH):
                mine = order[begin:begin + BATCH]
                sizes = np.array([len(docs[i][0]) for i in mine])
                at, x = np.concatenate([docs[i][0] for i in mine]), np.concatenate([docs[i][1] for i in mine])
                first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                v = self.factors[at]
                vx = v * x[:, None]
                one = np.add.reduceat(vx, first)
                two = np.add.reduceat(vx * vx, first)
                margin = self.bias + np.add.reduceat(self.linear[at] * x, first) + 0.5 * (one * one - two).sum(axis=1)
                error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[mine]) / len(mine)
                each = np.repeat(error, sizes)
                grad_f = (each * x)[:, None] * (np.repeat(one, sizes, axis=0) - vx)
                used, where = np.unique(at, return_inverse=True)
                g = np.bincount(where, weights=each * x) + DECAY * self.linear[used]
                square_l[used] += g * g
                self.linear[used] -= RATE * g / np.sqrt(square_l[used])
                by_feature = np.argsort(where, kind="stable")
                starts = np.searchsorted(where[by_feature], np.arange(len(used)))
                g = np.add.reduceat(grad_f[by_feature], starts) + DECAY * self.factors[used]
                square_f[used] += g * g
                self.factors[used] -= RATE * g / np.sqrt(square_f[used])
                g = error.sum()
                square_b += g * g
                self.bias -= RATE * g / np.sqrt(square_b)
        return self


FEATURES = StructType([StructField("bucket", ArrayType(IntegerType())), StructField("value", ArrayType(FloatType())),
                       StructField("stats", ArrayType(DoubleType()))])


def _features_udf():
    @F.pandas_udf(FEATURES)
    def features_of(texts: pd.Series, sizes: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([tuple(a.tolist() for a in features(t, n)) for t, n in zip(texts, sizes)],
                            columns=["bucket", "value", "stats"])
    return features_of


def _score_udf(model):
    @F.pandas_udf(DoubleType())
    def score_of(texts: pd.Series, sizes: pd.Series) -> pd.Series:
        machine = model.value
        return pd.Series([machine.score(*features(t, n)) for t, n in zip(texts, sizes)], dtype="float64")
    return score_of


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """At most ``rows`` labelled documents that are not held out, one of each id: doc_id, label, text, n_chars."""
    votes = (labels.select(F.col("doc_id"), col(label).cast("double").alias("label"))
             .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .join(docs.select("doc_id"), "doc_id", "left_semi")  # the bound is one of documents, not of labels
             .groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("double").alias("label")))
    rank = F.xxhash64(F.lit(SEED), "doc_id")
    usable = votes.count()
    # cut by hash first, so that the ordered limit sees little more than it keeps
    near = votes.where(F.pmod(rank, F.lit(max(1, usable))) < 2 * rows) if usable else votes
    chosen = near.orderBy(F.pmod(rank, F.lit(max(1, usable))), "doc_id").limit(rows)
    # of the documents of an id the least by text hash, so that a repeated id is one row
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "n_chars")).alias("doc")
    return docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(least).select(
        "doc_id", "label", "doc.text", "doc.n_chars")


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> FactorisationMachine:
    sample = training_sample(docs, labels, label, rows)
    got = sample.select("doc_id", "label", _features_udf()("text", "n_chars").alias("f")).select(
        "doc_id", "label", "f.*").toPandas().sort_values("doc_id", kind="stable")
    machine = FactorisationMachine()
    if not len(got):
        machine.factors[:] = 0
        return machine
    data = [(np.asarray(b, np.int32), np.asarray(v, np.float32), np.asarray(s, np.float64))
            for b, v, s in zip(got["bucket"], got["value"], got["stats"])]
    return machine.fit(data, got["label"].to_numpy(dtype=np.float64))


def score_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  n_chars: str = "n_chars", label: str = "quality", rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    size = col(n_chars).cast("double") if n_chars in docs.columns else F.lit(None).cast("double")
    d = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"), size.alias("n_chars"))
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(d, labels, label, rows))
    return d.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), _score_udf(model)("text", "n_chars").alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
