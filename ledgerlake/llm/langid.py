"""Language identification with interpolated Kneser-Ney character models.

Letters are lower-cased and folded to ``CLASSES`` symbols (a-z their own, others
by hash), anything else is one space between words. Per language, Spark counts
the trigrams of the training texts; the fixed number of symbols bounds the
tables to CLASSES**3 entries, whatever the corpus. Trigram codes are kept as one
sorted array with a log-probability per language; unseen trigrams back off. The
language with the lowest cross-entropy per symbol wins. Rejection is calibrated
on the training texts: per language, the mean and deviation of the winning
cross-entropy, and the standard score that ``ACCEPT`` of them stay below; the
score (the posterior for a text's first symbols' worth of evidence) decays
beyond it, and ``rejected`` says so.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
rows without a language are not learned from; with nothing to learn from, every
text is ``und``; ties go to the first language by name.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.store import checkpointed, small_batches

CLASSES = 128
SPACE, EDGE = 0, 1
DISCOUNT = 0.75
EVIDENCE = 40      # symbols whose evidence the posterior counts at most
ACCEPT = 0.999
CHARS = 1 << 20    # handled at once


@lru_cache(maxsize=1)
def symbols() -> np.ndarray:
    """The symbol of each code point."""
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        ch = chr(c)
        if c < 0x30000 and ch.isalpha():
            low = ord(ch.lower()[0])
            table[c] = low - 95 if 97 <= low <= 122 else 28 + (low * 0x9E3779B1 >> 7) % (CLASSES - 28)
    return table


def _pieces(texts: list[str | None]):
    """Symbols of the texts, the text number and place of each symbol; a text starts with two EDGE and ends with one."""
    codes = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t or "") for t in texts], np.int64)
    first = np.cumsum(size) - size
    sym = np.insert(symbols()[codes], np.concatenate((np.repeat(first, 2), first + size)), EDGE)
    order = np.concatenate((np.repeat(np.arange(len(texts)), 2), np.arange(len(texts))))
    doc = np.insert(np.repeat(np.arange(len(texts)), size), np.concatenate((np.repeat(first, 2), first + size)), order)
    keep = np.ones(len(sym), bool)
    keep[1:] = ~((sym[1:] == SPACE) & (sym[:-1] <= EDGE))  # no space after a space or an edge
    return sym[keep].astype(np.int32), doc[keep]


def _trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes that lie within a text, and their text numbers."""
    sym, doc = _pieces(texts)
    code = (sym[:-2] * CLASSES + sym[1:-1]) * CLASSES + sym[2:]
    same = doc[2:] == doc[:-2]
    return code[same], doc[2:][same]


def _chunks(texts: list[str | None]):
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """lang, code, n: trigram counts, summed per task before they are shuffled."""
    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist()
            for a, b in _chunks(texts):
                code, doc = _trigrams(texts[a:b])
                for name in set(langs[a:b]):
                    total[name] = total.get(name, 0) + np.bincount(code[(langs[a:b] == name)[doc]], minlength=CLASSES ** 3)
        for name, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])],
                                             names=["lang", "code", "n"])

    return docs.select(F.col(lang).cast("string"), F.col(text)).where(F.col(lang).isNotNull()).mapInArrow(
        run, "lang string, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))


class Models:
    """Interpolated Kneser-Ney models: ``codes`` sorted, ``seen`` their log-probability by language."""

    def __init__(self, langs: list[str], tables: list[tuple[np.ndarray, np.ndarray]]):
        self.langs = langs
        self.codes = np.unique(np.concatenate([c for c, _ in tables]))
        self.seen = np.zeros((len(self.codes), len(langs)), np.float32)
        self.backoff = np.zeros((CLASSES ** 2, len(langs)), np.float32)  # by the two symbols before
        self.pairs = np.zeros((CLASSES ** 2, len(langs)), np.float32)    # of the last two symbols
        for k, (code, n) in enumerate(tables):
            context, tail = code // CLASSES, code % CLASSES ** 2
            before = np.bincount(context, n, CLASSES ** 2)
            kinds = np.bincount(context, minlength=CLASSES ** 2)
            distinct2 = np.bincount(tail, minlength=CLASSES ** 2).reshape(CLASSES, CLASSES)  # symbols seen before a pair
            distinct1 = (distinct2 > 0).sum(0)
            p1 = (np.maximum(distinct1 - DISCOUNT, 0) + DISCOUNT * (distinct1 > 0).sum() / CLASSES) / distinct1.sum()
            row = distinct2.sum(1, keepdims=True)
            p2 = np.where(row > 0, (np.maximum(distinct2 - DISCOUNT, 0) + DISCOUNT * (distinct2 > 0).sum(1, keepdims=True) * p1) / np.maximum(row, 1), p1)
            weight = np.where(before > 0, DISCOUNT * kinds / np.maximum(before, 1), 1.0)
            self.backoff[:, k], self.pairs[:, k] = np.log(weight), np.log(p2.ravel())
            full = np.zeros(len(self.codes))
            full[np.searchsorted(self.codes, code)] = n
            c, t = self.codes // CLASSES, self.codes % CLASSES ** 2
            p3 = np.where(before[c] > 0, np.maximum(full - DISCOUNT, 0) / np.maximum(before[c], 1), 0) + weight[c] * p2.ravel()[t]
            self.seen[:, k] = np.log(p3)

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Mean cross-entropy by text and language (nats per symbol), and the number of symbols."""
        code, doc = _trigrams(texts)
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        p = self.seen[at]
        new = np.flatnonzero(self.codes[at] != code)
        p[new] = self.backoff[code[new] // CLASSES] + self.pairs[code[new] % CLASSES ** 2]
        n = np.bincount(doc, minlength=len(texts))
        total = np.stack([np.bincount(doc, p[:, k], len(texts)) for k in range(len(self.langs))], 1)
        return -total / np.maximum(n, 1)[:, None], n


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Models | None:
    """CLASSES**3 counts per language at most reach the driver."""
    rows = counts(docs, text, lang).toPandas().sort_values(["lang", "code"])
    tables = {k: (g["code"].to_numpy(np.int64), g["n"].to_numpy(np.float64)) for k, g in rows.groupby("lang")}
    return Models(sorted(tables), [tables[k] for k in sorted(tables)]) if tables else None


def predict(spark: SparkSession, docs: DataFrame, learn: Column, keep: list[str], text: str = "text", lang: str = "lang") -> DataFrame:
    """``keep`` columns, lang_pred, score, rejected, cross_entropy and n_symbols of every row; learns where ``learn`` holds."""
    small_batches(spark)
    models = train(docs.where(learn), text, lang)
    if models is None:
        return docs.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("rejected"),
                           F.lit(None).cast("double").alias("cross_entropy"), F.lit(0).cast("long").alias("n_symbols"))
    shared = spark.sparkContext.broadcast(models)  # bounded by CLASSES

    def run(batches):
        m = shared.value
        for batch in batches:
            texts = batch.column(len(keep) + 1).to_pylist()
            best, entropy, share, size = [], [], [], []
            for a, b in _chunks(texts):
                h, n = m.entropies(texts[a:b])
                letters = np.array([any(map(str.isalpha, t or "")) for t in texts[a:b]])
                top = h.argmin(1)
                logit = -(h - h.min(1, keepdims=True)) * np.minimum(n, EVIDENCE)[:, None]
                best += [m.langs[k] if ok else None for k, ok in zip(top, letters, strict=True)]
                entropy += h.min(1).tolist()
                share += (1 / np.exp(logit).sum(1)).tolist()
                size += n.tolist()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(keep) + 1)), pa.array(best, pa.string()), pa.array(entropy, pa.float64()),
                 pa.array(share, pa.float64()), pa.array(size, pa.int64())],
                names=[*keep, "_learned", "_best", "cross_entropy", "_share", "n_symbols"])

    at = docs.select(*keep, F.when(learn, F.col(lang).cast("string")).alias("_learned"), F.col(text).alias("_text"))
    schema = at.select(*keep, "_learned").schema.add("_best", "string").add("cross_entropy", "double").add("_share", "double").add("n_symbols", "long")
    at = checkpointed(spark, at.mapInArrow(run, schema))
    by = at.where("_learned = _best").groupBy("_best").agg(F.avg("cross_entropy").alias("_mean"), F.greatest(
        F.coalesce(F.stddev_pop("cross_entropy"), F.lit(0.0)), F.lit(1e-3)).alias("_sd"))  # one row per language
    at = at.join(F.broadcast(by), "_best", "left").withColumn("_z", F.coalesce((F.col("cross_entropy") - F.col("_mean")) / F.col("_sd"), F.lit(0.0)))
    limit = at.where("_learned = _best").agg(F.percentile_approx("_z", ACCEPT, 10_000)).first()[0] or 0.0
    over = F.greatest(F.col("_z") - F.lit(limit), F.lit(0.0))
    known = F.col("_best").isNotNull()
    return at.select(*keep, F.coalesce("_best", F.lit("und")).alias("lang_pred"),
                     F.when(known, F.col("_share") * F.exp(-over)).otherwise(0.0).alias("score"),
                     (known & (over > 0)).alias("rejected"), "cross_entropy", "n_symbols")
