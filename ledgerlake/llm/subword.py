"""Toxicity classifier: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its byte n-grams (``SIZES`` long, with a mark at either
end) and itself, each hashed to one of ``BUCKETS`` embeddings, so a misspelling
shares most vectors with the word it is made from. A passage of ``PASSAGE``
words is the average of its distinct words' vectors (places of repeated words,
and those a short text leaves free, hold zero vectors), a word the average of
its bag, and a linear softmax gives the passage's classes. A text is as toxic as
its most toxic passage: in a long text few words would not show in one average.

Embeddings and softmax are learned together, in numpy, from document labels, by
gradient descent with momentum on at most ``TRAIN_DOCS`` labelled documents
(those with the least hashes of id), with passages of ``TRAIN_BYTES`` together
of each (by least hash; a shorter text takes part whole). As averaging and the
linear layer commute, every step works with logits of buckets, words and
passages, and the gradient flows to both factors. The first steps use a soft
maximum over a text's passages, so that no passage is picked before the words
have weights. A fifth of the sample is not
learned from: it calibrates the logits, with both classes of equal weight.

Defined cases: null, empty and blank texts have one passage without words, scored
by the bias alone; without labelled rows of both classes every score is the share
of label 1 (0.5 without labels); positive labels count as 1, null ones not at all;
of rows with a repeated id at most ``ID_ROWS`` are learned from; repeated rows
score alike; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm import words
from ledgerlake.llm.store import checkpointed, within_small_batches

SIZES = (3, 4, 5)
BUCKETS = 1 << 18
DIM = 8
PASSAGE = 32
TRAIN_DOCS = 6000        # the documented bounds of the training sample
TRAIN_BYTES = 1 << 15
CHUNK = 1 << 15          # words whose bags are handled at once
ID_ROWS = 4
STEPS = 100
RATE = 1.5
DECAY = 0.002
SOFT = 0.8               # share of the steps with a soft maximum over passages
CUTS = np.zeros(256, bool)
CUTS[list(b".,;:!?\"()[]{}<>|/\\=+~`^")] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


def subwords(w: words.Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words numbered ``at``, one bag after another, and the bags' sizes."""
    size = w.ends[at] - w.starts[at] + 2  # with the marks of begin and end
    first = np.cumsum(size) - size
    own = np.repeat(np.arange(len(at)), size)
    place = np.repeat(w.starts[at] - 1 - first, size) + np.arange(len(own))
    data = w.data[place.clip(0, len(w.data) - 1)].astype(np.uint64)
    data[first], data[first + size - 1] = 1, 2
    codes, owners = [w.hashes[at]], [np.arange(len(at))]
    for n in SIZES:
        x = np.zeros(max(0, len(data) - n + 1), np.uint64)
        for j in range(n):
            x = x * _BASE + data[j:j + len(x)] + np.uint64(1)
        inside = np.flatnonzero(own[:len(x)] == own[len(own) - len(x):])
        codes.append(words.mixed(x[inside]))
        owners.append(own[inside])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return (np.concatenate(codes)[order] % np.uint64(BUCKETS)).astype(np.int32), np.bincount(owner, minlength=len(at))


def passages(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and number of words of every passage, of about equal lengths; ``first``: texts' first words, and the end."""
    size = np.diff(first)
    parts = np.maximum(1, -(-size // PASSAGE))
    text = np.repeat(np.arange(len(size)), parts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    start, stop = (first[text] + (nth + k) * size[text] // parts[text] for k in range(2))
    return text, start, stop - start


def distinct_words(word: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passage and number of every word of a passage, once each."""
    wide = int(word.max()) + 1 if len(word) else 1
    key = np.repeat(np.arange(len(size)) * wide, size) + word
    key.sort()
    key = key[np.append(True, key[1:] != key[:-1])[:len(key)]]
    return (key // wide).astype(np.int32), (key % wide).astype(np.int32)


def _bag_averages(by_bucket: np.ndarray, codes: np.ndarray, size: np.ndarray) -> np.ndarray:
    out, ends = np.zeros(len(size), np.float32), np.append(0, np.cumsum(size))
    for a in range(0, len(size), CHUNK):
        b = min(a + CHUNK, len(size))
        out[a:b] = np.add.reduceat(by_bucket[codes[ends[a]:ends[b]]], ends[a:b] - ends[a])
    return out / size


class Sample:
    """Texts to learn from: the bags of all distinct words, and the words, passages and texts that they make up."""

    def __init__(self, texts: pa.Array):
        known, hashes, codes, sizes = np.zeros(0, np.uint64), [], [], []
        order, firsts, n = [], [np.zeros(1, np.int64)], 0
        for _, _, w in words.blocks(texts, cuts=CUTS):
            distinct, at = np.unique(w.hashes, return_index=True)
            fresh = ~np.isin(distinct, known)
            known = np.union1d(known, distinct)
            code, size = subwords(w, at[fresh])
            codes.append(code)
            sizes.append(size)
            order.append(distinct[fresh])
            hashes.append(w.hashes)
            firsts.append(w.first[1:] + n)
            n += len(w.hashes)
        order = np.concatenate([np.zeros(0, np.uint64), *order])
        by_hash = np.argsort(order)
        hashes = np.concatenate([order[:0], *hashes])
        word = by_hash[np.searchsorted(order[by_hash], hashes)].astype(np.int32)
        del hashes
        self.codes, self.sizes = np.concatenate([np.zeros(0, np.int32), *codes]), np.concatenate([np.zeros(0, np.int64), *sizes])
        self.text, start, size = passages(np.concatenate(firsts))
        self.passage, self.word = distinct_words(word, start, size)
        self.first = np.searchsorted(self.text, np.arange(len(texts)))

    def logits(self, by_bucket: np.ndarray) -> np.ndarray:
        """Of every passage, without the bias."""
        return np.bincount(self.passage, _bag_averages(by_bucket, self.codes, self.sizes)[self.word], len(self.text)) / PASSAGE

    def top(self, z: np.ndarray) -> np.ndarray:
        """Every text's passage with the greatest logit."""
        best = np.repeat(np.maximum.reduceat(z, self.first), np.diff(np.append(self.first, len(z))))
        hit = np.flatnonzero(z == best)
        return hit[np.searchsorted(self.text[hit], np.arange(len(self.first)))]

    def soft(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every text's soft maximum (logarithm of the mean of exponentials), and the passages' shares in it."""
        n = np.diff(np.append(self.first, len(z)))
        most = np.maximum.reduceat(z, self.first)
        e = np.exp(z - np.repeat(most, n))
        total = np.add.reduceat(e, self.first)
        return most + np.log(total / n), e / np.repeat(total, n)

    def back(self, slope: np.ndarray) -> np.ndarray:
        """The buckets' gradient, given that of the passages' logits."""
        by_word = np.bincount(self.word, slope[self.passage] / PASSAGE, len(self.sizes)) / self.sizes
        out, ends = np.zeros(BUCKETS), np.append(0, np.cumsum(self.sizes))
        for a in range(0, len(self.sizes), CHUNK):
            b = min(a + CHUNK, len(self.sizes))
            out += np.bincount(self.codes[ends[a]:ends[b]], np.repeat(by_word[a:b], self.sizes[a:b]), BUCKETS)
        return out


class Model:
    """Embeddings of buckets, weights and bias of the softmax over two classes, and the calibration of its logits."""

    def __init__(self, rate: float):
        r = np.random.default_rng(7)
        self.rate, self.fitted = rate, False
        self.embedding = r.normal(scale=0.01, size=(BUCKETS, DIM)).astype(np.float32)
        self.weight = r.normal(size=(DIM, 2)).astype(np.float32)
        self.bias = float(np.log(rate / (1 - rate)))
        self.slope, self.shift = 1.0, 0.0

    def by_bucket(self) -> np.ndarray:
        """Logits of class 1 against class 0."""
        return self.embedding @ (self.weight[:, 1] - self.weight[:, 0])

    def fit(self, sample: Sample, y: np.ndarray) -> None:
        held = None
        for step in range(STEPS):
            z = sample.logits(self.by_bucket()) + self.bias
            off = np.zeros(len(z))
            if step < STEPS * SOFT:
                pooled, share = sample.soft(z)
                off = ((1 / (1 + np.exp(-pooled)) - y) / len(y))[sample.text] * share
            else:
                top = sample.top(z)
                off[top] = (1 / (1 + np.exp(-z[top])) - y) / len(y)
            g = sample.back(off).astype(np.float32)
            grads = [np.outer(g, self.weight[:, 1] - self.weight[:, 0]), np.outer(self.embedding.T @ g, [-1, 1]), off.sum()]
            held = grads if held is None else [0.9 * a + b for a, b in zip(held, grads, strict=True)]
            pace = RATE * (1 - step / STEPS)
            self.embedding = self.embedding * np.float32(1 - DECAY) - pace * held[0] / max(np.abs(held[0]).max(), 1e-12)
            self.weight -= (pace * held[1] / max(np.abs(held[1]).max(), 1e-12) / 10).astype(np.float32)
            self.bias -= pace * np.sign(held[2]) / 10
        self.fitted = True

    def calibrate(self, z: np.ndarray, y: np.ndarray) -> None:
        """Logistic regression of y on the logits of texts not learned from, classes of equal weight (a little prior keeps it finite)."""
        if 0 < y.mean() < 1:
            x = np.stack([z / 10, np.ones(len(z))], 1)
            n = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
            p = np.array([1.0, 0.0])
            for _ in range(50):
                q = 1 / (1 + np.exp(-x @ p))
                curve = (x * (n * q * (1 - q))[:, None]).T @ x + 1e-4 * np.eye(2)
                p -= np.linalg.solve(curve, x.T @ (n * (q - y)) + 1e-4 * p)
            self.slope, self.shift = max(p[0], 1e-3) / 10, p[1]

    def score(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * z + self.shift).clip(-500, 500)))


def _pick(column: pa.Array) -> list[bytes]:
    """Each text's passages of the least hashes, TRAIN_BYTES of them together, in their order; a longer passage doesn't take part."""
    out = []
    for _, _, w in words.blocks(column, cuts=CUTS):
        text, start, size = passages(w.first)
        hashes = words.mixed(np.add.reduceat(np.append(w.hashes, np.uint64(0)), start))
        ends = np.append(w.ends, 0)[start + size - 1]
        first = np.searchsorted(text, np.arange(len(w.first)))
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            chosen = np.arange(a, b)[size[a:b] > 0]
            spans = ends[chosen] - w.starts[start[chosen]] if len(chosen) else chosen
            if spans.sum() + len(chosen) > TRAIN_BYTES:
                order = np.argsort(hashes[chosen], kind="stable")
                chosen = np.sort(chosen[order[np.cumsum(spans[order] + 1) <= TRAIN_BYTES]])
            out.append(b" ".join(w.data[w.starts[start[k]]:ends[k]].tobytes() for k in chosen))
    return out


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> Model:
    """Fitted on the bounded sample, a fifth of which (by hash) calibrates."""
    pick = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("_id"), (F.col(label) > 0).cast("double").alias("y")).orderBy(F.xxhash64("_id"), "_id", "y").limit(TRAIN_DOCS)
    pick = checkpointed(spark, pick)
    own = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text")).join(
        F.broadcast(pick.select(F.col("_id").alias("_doc")).distinct()), "_doc")  # TRAIN_DOCS ids
    own = own.withColumn("_n", F.row_number().over(Window.partitionBy("_doc").orderBy(F.xxhash64("_text"), "_text"))).where(F.col("_n") <= ID_ROWS)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_pick(batch.column(1)), pa.binary())], names=["_id", "x"])

    kind = pick.schema["_id"].dataType.simpleString()
    parts = own.select("_doc", "_text").mapInArrow(run, f"_id {kind}, x binary").join(F.broadcast(pick), "_id").collect()
    rows = sorted((r["_id"], r["y"], bytes(r["x"])) for r in parts)
    del parts
    y = np.array([r[1] for r in rows])
    if len(set(y.tolist())) < 2:
        return Model(float(min(0.999, max(0.001, y.mean()))) if len(y) else 0.5)
    model = Model(float(y.mean()))
    aside = np.random.default_rng(13).permutation(len(y)) % 5 == 0
    if len({*y[~aside].tolist()}) < 2:
        aside[:] = False
    texts = lambda at: pa.array([rows[i][2].decode("utf-8", "replace") for i in np.flatnonzero(at)], pa.string())
    model.fit(Sample(texts(~aside)), y[~aside])
    if aside.any():
        rest = Sample(texts(aside))
        z = rest.logits(model.by_bucket()) + model.bias
        model.calibrate(z[rest.top(z)], y[aside])
    return model


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, learn: Column, keep: list[str], doc_id: str = "doc_id",
          text: str = "text", label: str = "toxic") -> DataFrame:
    """``keep`` columns, score and n_passages of every row. ``learn``: a condition on ``labels``, by their doc_id."""
    at = docs.select(*keep, F.col(text).alias("_text"))
    with within_small_batches(spark):
        model = train(spark, docs, labels.where(learn), doc_id, text, label)
        shared = spark.sparkContext.broadcast((model.by_bucket(), model))
        model.embedding = None  # only the buckets' logits go along

        def run(batches):
            by_bucket, m = shared.value
            for batch in batches:
                found, n = [], []
                for _, _, w in words.blocks(batch.column(len(keep)), cuts=CUTS):
                    distinct, first, inverse = np.unique(w.hashes, return_index=True, return_inverse=True)
                    by_word = _bag_averages(by_bucket, *subwords(w, first))
                    row, start, size = passages(w.first)
                    passage, word = distinct_words(inverse, start, size)
                    z = np.bincount(passage, by_word[word], len(row)) / PASSAGE + m.bias
                    best = np.maximum.reduceat(z, np.searchsorted(row, np.arange(len(w.first) - 1)))
                    found.append(m.score(best) if m.fitted else np.full(len(best), m.rate))
                    n.append(np.bincount(row))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k) for k in range(len(keep))), pa.array(np.concatenate([np.zeros(0), *found])),
                     pa.array(np.concatenate([np.zeros(0, np.int64), *n]))], names=[*keep, "score", "n_passages"])

        return checkpointed(spark, at.mapInArrow(run, at.select(*keep).schema.add("score", "double").add("n_passages", "long")))
