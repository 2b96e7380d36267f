"""Quality classifier: attention-based multiple-instance learning over passages.

A text is a bag of passages of ``PASSAGE`` words. Every passage is encoded: byte
class shares, word lengths, repetition and a signed projection of its word
hashes pass through a tanh layer. Gated attention (a tanh branch times a sigmoid
branch) weighs the passages, and a logistic output scores the weighted passage
representation. All weights are learned together from document labels, by Adam
on at most ``TRAIN_DOCS`` labelled documents (those with the least id hashes).

Defined cases: null, empty and blank texts are one passage without words; with
fewer than one labelled row of each class the score is the share of label 1
(0.5 without labels); repeated rows score alike; ids with several labels count
each of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import words
from ledgerlake.llm.store import checkpointed, small_batches

PASSAGE = 64
PROJECTED = 24
HIDDEN = 24
GATE = 12
TRAIN_DOCS = 8000     # the documented bound of the training sample
EPOCHS = 60
BATCH = 256
_BUCKETS = 1 << 12
_SIGNS = np.random.default_rng(11).choice([-1.0, 1.0], (_BUCKETS, PROJECTED)).astype(np.float32) / np.sqrt(PROJECTED)
_KINDS = np.zeros((7, 256), bool)  # capitals, small letters, digits, plain marks, other marks, bytes beyond ASCII, line ends
_KINDS[0, 65:91] = _KINDS[1, 97:123] = _KINDS[2, 48:58] = _KINDS[5, 128:] = True
_KINDS[3, list(b".,;:?'\"()-")] = True
_KINDS[4, [b for b in range(33, 127) if not chr(b).isalnum() and b not in b".,;:?'\"()-"]] = True
_KINDS[6, 10] = True
FEATURES = 7 + 5 + PROJECTED


def bags(column: pa.Array):
    """(row, features of its passages)."""
    for start, stop, w in words.blocks(column, lower=False):
        first = w.first
        size = np.diff(first)
        parts = np.maximum(1, -(-size // PASSAGE))
        bag = np.repeat(np.arange(stop - start), parts)
        nth = np.arange(len(bag)) - np.repeat(np.cumsum(parts) - parts, parts)
        a = first[bag] + nth * PASSAGE
        b = np.minimum(a + PASSAGE, first[bag + 1])
        n = b - a
        x = np.zeros((len(bag), FEATURES), np.float32)
        full = np.flatnonzero(n)
        if len(full):
            lo, hi = w.starts[a[full]], w.ends[b[full] - 1]
            span = (hi - lo).astype(np.float32)
            for k in range(7):
                total = np.concatenate(([0], np.cumsum(_KINDS[k][w.data])))
                x[full, k] = (total[hi] - total[lo]) / span
            length = (w.ends - w.starts).astype(np.float64)
            sums = np.concatenate(([0], np.cumsum(length)))
            mean = (sums[b[full]] - sums[a[full]]) / n[full]
            x[full, 7] = np.log1p(mean)
            squares = np.concatenate(([0], np.cumsum(length * length)))
            x[full, 8] = np.log1p(np.sqrt(np.maximum((squares[b[full]] - squares[a[full]]) / n[full] - mean * mean, 0)))
            doc = np.repeat(np.arange(stop - start), size)
            again = _again(w.hashes, doc)
            total = np.concatenate(([0], np.cumsum(again)))
            x[full, 9] = (total[b[full]] - total[a[full]]) / n[full]
            rows = _SIGNS[(w.hashes % np.uint64(_BUCKETS)).astype(np.int64)]
            x[full, 12:] = np.add.reduceat(rows, a[full], 0)[:len(full)] / np.sqrt(n[full])[:, None] if len(rows) else 0
        x[:, 10] = np.log1p(n) / 4
        x[:, 11] = np.log1p(size[bag]) / 8
        ends = np.cumsum(parts)
        for row in range(stop - start):
            yield start + row, x[ends[row] - parts[row]:ends[row]]


def _again(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a word occurred earlier in its text."""
    key = words.mixed(hashes + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), bool)
    same[order[1:]] = key[order[1:]] == key[order[:-1]]
    return same


class Model:
    """Parameters by name; ``mean`` and ``scale`` standardise the features."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, rate: float):
        r = np.random.default_rng(5)
        init = lambda *shape: (r.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        self.mean, self.scale, self.rate, self.fitted = mean, scale, rate, False
        self.p = {"w": init(FEATURES, HIDDEN), "b": np.zeros(HIDDEN, np.float32), "v": init(HIDDEN, GATE), "u": init(HIDDEN, GATE),
                  "a": init(GATE), "c": init(HIDDEN), "d": np.array([np.log(rate / (1 - rate))], np.float32)}

    def forward(self, x: np.ndarray, first: np.ndarray) -> tuple:
        p = self.p
        h = np.tanh(((x - self.mean) / self.scale).clip(-6, 6) @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * g) @ p["a"]
        size = np.diff(np.append(first, len(x)))
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), size))
        weight = e / np.repeat(np.add.reduceat(e, first), size)
        z = np.add.reduceat(weight[:, None] * h, first, 0)
        return h, t, g, weight, z, 1 / (1 + np.exp(-(z @ p["c"] + p["d"][0]))), size

    def gradients(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        h, t, g, weight, z, score, size = self.forward(x, first)
        out = (score - y) / len(y)
        dz = np.repeat(out[:, None] * p["c"], size, 0)
        dw = (dz * h).sum(1)
        de = weight * (dw - np.repeat(np.add.reduceat(weight * dw, first), size))
        dt, dg = de[:, None] * p["a"] * g * (1 - t * t), de[:, None] * p["a"] * t * g * (1 - g)
        dh = (weight[:, None] * dz + dt @ p["v"].T + dg @ p["u"].T) * (1 - h * h)
        xs = ((x - self.mean) / self.scale).clip(-6, 6)
        return {"w": xs.T @ dh, "b": dh.sum(0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ de, "c": z.T @ out, "d": np.array([out.sum()])}

    def fit(self, bags_: list[np.ndarray], y: np.ndarray) -> None:
        r, state = np.random.default_rng(3), {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step, rounds = 0, max(EPOCHS, 600 * BATCH // max(len(y), 1) // 4)
        for _ in range(rounds):
            for part in np.array_split(r.permutation(len(y)), max(1, len(y) // BATCH)):
                chosen = [bags_[i] for i in part]
                first = np.cumsum([0, *map(len, chosen[:-1])])
                grads = self.gradients(np.concatenate(chosen), first, y[part])
                step += 1
                for k, d in grads.items():
                    d = d + 1e-4 * self.p[k] * (k in "wvuc")
                    m, v = state[k] = (0.9 * state[k][0] + 0.1 * d, 0.999 * state[k][1] + 0.001 * d * d)
                    self.p[k] = (self.p[k] - 0.004 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        self.fitted = True

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.forward(x, first)[5] if self.fitted else np.full(len(first), self.rate)


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> Model:
    """Fitted on the bounded sample, whose features are made in Spark."""
    pick = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("_id"), F.col(label).cast("double").alias("y")).orderBy(F.xxhash64("_id"), "_id", "y").limit(TRAIN_DOCS)
    pick = checkpointed(spark, pick)

    def run(batches):
        for batch in batches:
            found = [x.tobytes() for _, x in bags(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.binary())], names=["_id", "y", "x"])

    at = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text")).join(F.broadcast(pick), F.col("_doc") == F.col("_id"))
    rows = at.select("_id", "_text", "y").mapInArrow(run, f"_id {pick.schema['_id'].dataType.simpleString()}, y double, x binary").collect()
    rows.sort(key=lambda r: (r["_id"], r["y"], bytes(r["x"])))
    y = np.array([r["y"] for r in rows], np.float32)
    if not len(y) or len(set(y)) < 2:
        return Model(np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32), float(min(0.999, max(0.001, y.mean()))) if len(y) else 0.5)
    x = [np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES) for r in rows]
    every = np.concatenate(x)
    model = Model(every.mean(0), np.maximum(every.std(0), 1e-3), float(y.mean()))
    model.fit(x, y)
    return model


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, learn: Column, keep: list[str], doc_id: str = "doc_id",
          text: str = "text", label: str = "quality") -> DataFrame:
    """``keep`` columns, score and n_passages of every row. ``learn``: a condition on ``labels``, by their doc_id."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(train(spark, docs, labels.where(learn), doc_id, text, label))

    def run(batches):
        m = shared.value
        for batch in batches:
            found, n = [], []
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                chosen = [x for _, x in bags(part.column(len(keep)))]
                n += map(len, chosen)
                found.append(m.score(np.concatenate(chosen), np.cumsum([0, *map(len, chosen[:-1])])))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(keep))), pa.array(np.concatenate(found).astype(np.float64) if found else [], pa.float64()),
                 pa.array(n, pa.int64())], names=[*keep, "score", "n_passages"])

    at = docs.select(*keep, F.col(text).alias("_text"))
    return at.mapInArrow(run, at.select(*keep).schema.add("score", "double").add("n_passages", "long"))
