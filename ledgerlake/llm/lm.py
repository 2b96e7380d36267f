"""Language-model scoring by online logistic context mixing.

A text is its words and one end sign. Frequent words, an escape for the others
and the end are coded in their contexts: all texts, the text's inferred group,
the word before and the two words before (``word_contexts``). A word behind an
escape is spelled as its bytes and a space, bit by bit, as follows. Five
predictors look up hashed contexts (one, two or four bytes
before, the whole word so far, and that within the text's group; each with the
bits of the byte so far). A training text's group is its label, the ``GROUPS``
most frequent ones counting; a scored text's group is inferred for each word
from the words before it alone, none at its start. The predictors' stretched
probabilities are combined with weights that a gate selects (bit position, how
often the two longest contexts were seen and if always with the same bit),
learned online by each task over
its share of the vocabulary and averaged; each word is predicted with its own
occurrence taken out of the counts. An adaptive map, gathered on the way,
refines the mixed probability. Spelling doesn't look across words but for the
group, so every distinct word is spelled once, by group; which word comes is
predicted for every occurrence in its contexts across words. The text's
probability is the product over its words.

What the model knows grows with the corpus: the vocabulary of all texts is dealt
by its words' first bytes, so that a task holds every word with a given
beginning and counts the contexts of the word so far in a table sized by its
rows. A beginning that holds many words is dealt by more bytes (``CUTS``).
Contexts inside those first bytes, and the short ones, are in tables of fixed
size that all tasks share.

The unigram base uses exact training counts. Words so frequent that there are
at most ``HEAD`` of them are looked up in the task; the others meet the spelled
words in a join. Words of a training text are coded without themselves, as if
new, but spelled as the final counts have it.

Defined cases: null, empty and blank texts are the end sign alone; repeated rows
are scored (and counted in training) each; with no training text all counts are
0 and a token's base is log10(0.1 / 0.1).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm import word_contexts, words
from ledgerlake.llm.store import checkpointed, release

BITS = (16, 19, 20, 20)     # shared tables: one, two, four bytes before; the word so far in its first bytes
GROUPS = 8                  # labels that count; others are no group
HEAD = 1 << 18              # frequent words at most, that are coded in their contexts across words
SEEN = 2                    # times that such a word is in training texts at least
TEXTS = 4096                # texts whose words' costs a task adds up
CUTS = (3, 6, 12, 24)       # bytes of a word that choose its task; the next number where a beginning is frequent
FREQUENT = 64               # a beginning is frequent if it holds more than 1 / FREQUENT of the vocabulary and ROWS words
LEVELS = (1, 3, 10, 40, 400)
STATES = 2 * (len(LEVELS) + 1)
GATES, INPUTS, STEPS = 8 * STATES * STATES, 6, 33
FINE = 2048                 # steps of a mixed probability when it is scored
START = (0, 0.05, 0.1, 0.3, 0.6, 0)  # weights of the predictors and of a constant
RATE = 0.06
ROWS = 64_000               # words of a task
TABLE_ROWS = 1_000_000      # that a task counts for the shared tables
CHUNK = 2048                # words coded together
OFFSETS = np.cumsum([0, *(1 << b for b in BITS)])


class Coded:
    """The bytes of some words, each with its space, and their context hashes."""

    def __init__(self, data: np.ndarray, size: np.ndarray, cut: np.ndarray, local_bits: int = 0):
        """data: the words' bytes one after the other; size: their lengths; cut: bytes that chose the task."""
        n = len(data) + len(size)
        self.first = np.cumsum(size + 1) - size - 1
        last = self.first + size
        b = np.full(n, 0x20, np.uint8)
        body = np.ones(n, bool)
        body[last] = False
        b[body] = data
        self.byte, self.size = b, size + 1
        place = np.arange(n) - np.repeat(self.first, self.size)
        before = []
        for k in range(1, 5):
            x = np.zeros(n, np.uint32)
            x[k:] = b[:-k]
            x[place < k] = 0
            before.append(x)
        power, inverse = words._pow(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
        start = np.repeat(self.first, self.size)
        prefix = words.mixed((total[:-1] - total[start]) * inverse[start] + place.astype(np.uint64))
        self.prefix = (prefix >> np.uint64(32)).astype(np.uint32)
        two = before[0] | before[1] << np.uint32(8)
        self.short = [before[0], two, two | before[2] << np.uint32(16) | before[3] << np.uint32(24)]
        self.one = before[0]
        self.early = place < np.repeat(cut, self.size)
        self.shift = np.where(self.early, 32 - BITS[3], 32 - local_bits).astype(np.uint32)
        self.offset = np.where(self.early, OFFSETS[3], OFFSETS[4]).astype(np.int64)

    def node(self, j: int) -> np.ndarray:
        """The bits of every byte before bit j, from the highest."""
        return (np.uint32(1 << j) | (self.byte >> np.uint8(8 - j) if j else np.zeros(len(self.byte), np.uint8)).astype(np.uint32)) * np.uint32(0x9E3779B1)

    def short_slots(self, node: np.ndarray) -> list[np.ndarray]:
        return [(_hashed(c, node) >> np.uint32(32 - BITS[k])).astype(np.int64) + OFFSETS[k] for k, c in enumerate(self.short)]

    def word_slots(self, node: np.ndarray, group: int | np.ndarray, at=slice(None)) -> np.ndarray:
        """Slots of the word so far, within a group (-1: in all texts); behind the shared tables where it is the task's own."""
        salt = ((np.asarray(group, np.int64) + 1) * 0x632BE5AB & 0xFFFFFFFF).astype(np.uint32)
        return (_hashed(self.prefix[at] + salt, node[at]) >> self.shift[at]).astype(np.int64) + self.offset[at]

    def bit(self, j: int) -> np.ndarray:
        return (self.byte >> np.uint8(7 - j)) & np.uint8(1)


def _hashed(context: np.ndarray, node: np.ndarray) -> np.ndarray:
    x = (context * np.uint32(0x85EBCA6B) ^ node) * np.uint32(0xC2B2AE35)
    return (x ^ x >> np.uint32(15)) * np.uint32(0x27D4EB2F)


class Share:
    """The words of a task: their bytes, training counts, counts by group and cuts."""

    def __init__(self, batches: list[pa.RecordBatch]):
        self.size, self.data = [], []
        for b in batches:
            _, offsets, data = b.column(0).buffers()
            offsets = np.frombuffer(offsets, np.int32)[b.column(0).offset:b.column(0).offset + len(b) + 1].astype(np.int64)
            self.size.append(np.diff(offsets))
            self.data.append(np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8))
        self.size, self.data = np.concatenate(self.size), np.concatenate(self.data)
        self.at = np.append(0, np.cumsum(self.size))
        self.n = np.concatenate([b.column(1).to_numpy() for b in batches]).astype(np.float64)
        by = [b.column(2).flatten().to_numpy() for b in batches]
        self.by = np.concatenate(by).astype(np.float64).reshape(len(self.size), -1)
        self.cut = np.concatenate([b.column(3).to_numpy() for b in batches])
        self.local_bits = int(min(23, max(12, np.ceil(np.log2(6 * (len(self.data) + len(self.size)))))))

    def chunks(self, some: np.ndarray | None = None):
        """(words' range, coded bytes) of CHUNK words at a time, of all or of ``some`` alone."""
        for a in range(0, len(self.size) if some is None else len(some), CHUNK):
            if some is None:
                b = min(a + CHUNK, len(self.size))
                yield a, b, Coded(self.data[self.at[a]:self.at[b]], self.size[a:b], self.cut[a:b], self.local_bits)
            else:
                at = some[a:a + CHUNK]
                first, size = self.at[at], self.size[at]
                bytes_at = np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)
                yield a, a + len(at), Coded(self.data[bytes_at], size, self.cut[at], self.local_bits)

    def count(self, total: np.ndarray, short: bool, early: bool) -> None:
        """Adds the words to the counts: the short contexts, and those of the word so far in (or behind) the first bytes."""
        flat = total.reshape(-1)  # the zeros, then the ones
        for a, b, c in self.chunks():
            mine = c.early if early else ~c.early
            weights = [(-1, self.n[a:b])] + [(g, self.by[a:b, g]) for g in range(self.by.shape[1])]
            weights = [(g, np.repeat(w.astype(total.dtype), c.size)) for g, w in weights]
            picked = [(g, at, w[at]) for g, w in weights for at in [np.flatnonzero(mine & (w > 0))]]
            for j in range(8):
                node, which = c.node(j), c.bit(j).astype(np.int64) * total.shape[1]
                if short:
                    for slot in c.short_slots(node):
                        np.add.at(flat, which + slot, weights[0][1])
                for g, at, w in picked:
                    np.add.at(flat, which[at] + c.word_slots(node, g, at), w)

    def tables(self, shared: np.ndarray) -> np.ndarray:
        """The shared counts and, behind them, the task's own."""
        total = np.zeros((2, OFFSETS[4] + (1 << self.local_bits)), np.float32)
        total[:, :OFFSETS[4]] = shared
        self.count(total, short=False, early=False)
        return total


def _stretched(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.log((n1 + np.float32(0.2)) / (n0 + np.float32(0.2))).clip(-8, 8).astype(np.float32)


def _state(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """How often a context was seen, and if always with the same bit; 0 is left for a context that isn't used."""
    n = n0 + n1
    out = (np.minimum(n0, n1) <= 0).astype(np.int8)
    for x in LEVELS:
        out += (n >= x).view(np.int8) * np.int8(2)
    return out.astype(np.int32)


def vocabulary(docs: DataFrame, text: str, group: str, learn: str, groups: int) -> DataFrame:
    """h, word, m (all occurrences), n (those in training texts), by (n by group); summed per block of texts before they are shuffled."""
    def run(batches):
        for batch in batches:
            data, offsets = words.texts(batch.column(0))
            part = data[offsets[0]:offsets[-1]]
            w = words._words(words.LOWER[part], words.SPACE[part], offsets - offsets[0])
            count = np.diff(w.first)
            g, learned = np.repeat(batch.column(1).to_numpy(), count), np.repeat(batch.column(2).to_numpy(), count)
            _, at, m = np.unique(w.hashes + (g * 2 + learned).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_index=True, return_counts=True)
            raw = w.data.tobytes()
            found = [raw[a:b] for a, b in zip(w.starts[at].tolist(), w.ends[at].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(w.hashes[at].view(np.int64)), pa.array(found, pa.binary()), pa.array(g[at].astype(np.int32)), pa.array(m.astype(np.int64)),
                 pa.array((m * learned[at]).astype(np.int64))], names=["h", "word", "g", "m", "n"])

    rows = docs.select(text, group, learn).mapInArrow(run, "h long, word binary, g int, m long, n long")
    by = [F.sum(F.when(F.col("g") == k, F.col("n")).otherwise(0)).alias(f"_{k}") for k in range(groups)]
    return rows.groupBy("h", "word").agg(F.sum("m").alias("m"), F.sum("n").alias("n"), *by).select(
        "h", "word", "m", "n", F.array(*(f"_{k}" for k in range(groups))).cast("array<long>").alias("by"))


def cut(vocab: DataFrame, rows: int) -> Column:
    """How many first bytes choose a word's task."""
    start = lambda size: F.substring("word", 1, size)
    found, within = F.lit(CUTS[0]), vocab
    for size, longer in zip(CUTS, CUTS[1:], strict=False):
        many = within.groupBy(start(size).alias("b")).count().where(F.col("count") > max(ROWS, rows // FREQUENT)) if rows > ROWS else None
        hot = [bytes(r["b"]) for r in many.collect()] if many is not None else []  # FREQUENT at most
        if not hot:
            break
        is_hot = start(size).isin([F.lit(b) for b in hot])
        found, within = F.when(is_hot & (found == size), longer).otherwise(found), within.where(is_hot)
    return found


def shared_tables(vocab: DataFrame) -> np.ndarray:
    """Counts of zeros and ones by slot, one table behind the other; their size is fixed."""
    def run(batches):
        total = np.zeros((2, OFFSETS[-1]))
        for batch in batches:
            if batch.num_rows:
                Share([batch]).count(total, short=True, early=True)
        at = np.flatnonzero(total.any(0))
        for a in range(0, len(at), 1 << 16):
            part = at[a:a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[0, part]), pa.array(total[1, part])],
                                             names=["slot", "n0", "n1"])

    rows = vocab.select("word", "n", "by", "cut").mapInArrow(run, "slot int, n0 double, n1 double").groupBy("slot").agg(
        F.sum("n0").cast("float").alias("n0"), F.sum("n1").cast("float").alias("n1"))
    out = np.zeros((2, OFFSETS[-1]), np.float32)
    for batch in rows.toArrow().to_batches():  # OFFSETS[-1] rows of 12 bytes at most
        at = batch.column(0).to_numpy()
        out[0, at], out[1, at] = batch.column(1).to_numpy(), batch.column(2).to_numpy()
    return out


def _start() -> tuple[np.ndarray, np.ndarray]:
    w = np.tile(np.array(START, np.float32), (GATES, 1))
    p = 1 / (1 + np.exp(-np.linspace(-8, 8, STEPS)))
    return w, np.tile(np.stack([(1 - p) * 8, p * 8])[:, None], (1, 8 * STATES, 1))


def _steps(row: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The map's entry below a stretched probability, and how far it is on the way to the next one."""
    at = (s + 8) * ((STEPS - 1) / 16)
    low = np.minimum(at.astype(np.int32), STEPS - 2)
    return row * STEPS + low, at - low.astype(np.float32)


def mixer(vocab: DataFrame, counts) -> tuple[np.ndarray, np.ndarray]:
    """Weights by gate, averaged over the tasks by their words, and the summed adaptive map."""
    def learn(c: Coded, pairs: np.ndarray, group: np.ndarray, weight: np.ndarray, w: np.ndarray, refine: np.ndarray) -> None:
        each, groups = np.repeat(weight, c.size).astype(np.float32), np.repeat(group, c.size)
        for j in range(8):
            node, bit = c.node(j), c.bit(j).astype(np.float32)
            x, states = [], []
            for slot in [*c.short_slots(node), c.word_slots(node, -1), c.word_slots(node, groups)]:
                both = np.take(pairs, slot, 0)
                a = np.maximum(both[:, 0] - (1 - bit), 0)  # without the word itself
                b = np.maximum(both[:, 1] - bit, 0)
                x.append(_stretched(a, b))
                states.append(_state(a, b) if len(x) > 3 else None)
            x[4], states[4] = np.where(groups < 0, 0, x[4]), np.where(groups < 0, 0, states[4])
            row = j * STATES + states[4]
            gate = row * STATES + states[3]
            s = w[gate, -1].copy()
            for k in range(INPUTS - 1):
                s += w[gate, k] * x[k]
            s = s.clip(-8, 8)
            p = 1 / (1 + np.exp(-s))
            low, way = _steps(row, s)
            low += c.bit(j).astype(np.int32) * refine[0].size
            for k, part in ((0, each * (1 - way)), (1, each * way)):
                refine += np.bincount(low + k, part, refine.size).reshape(refine.shape)
            error, curve = each * (bit - p), each * p * (1 - p)
            floor = 0.02 * np.bincount(gate, each, GATES) + 1
            for k in range(INPUTS):
                xk = x[k] if k < INPUTS - 1 else np.float32(1)
                up, down = np.bincount(gate, error * xk, GATES), np.bincount(gate, curve * xk * xk, GATES)
                w[:, k] += (RATE * up / (down + floor)).clip(-0.1, 0.1)

    def run(batches):
        w, refine = _start()
        seen_words, prior = 0.0, refine.copy()
        held = [b for b in batches if b.num_rows]
        if held:
            share = Share(held)
            pairs = np.ascontiguousarray(share.tables(counts.value).T)
            for k, (a, b, c) in enumerate(share.chunks()):
                by = share.by[a:b]
                if by.shape[1] and k % 8 != 7:  # a word's most frequent group; now and then none, as at a text's start
                    group = np.where(by.max(1) > 0, by.argmax(1), -1)
                    weight = np.where(group >= 0, by.max(1), share.n[a:b])
                else:
                    group, weight = np.full(b - a, -1), share.n[a:b]
                seen_words += float(weight.sum())
                learn(c, pairs, group, weight, w, refine)
        flat = np.concatenate((w.ravel() * seen_words, (refine - prior).ravel(), [seen_words]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)], names=["k", "x"])

    rows = vocab.select("word", "n", "by", "cut").mapInArrow(run, "k int, x double").groupBy("k").agg(F.sum("x").alias("x")).toPandas()
    w, refine = _start()
    if len(rows):
        flat = rows.sort_values("k")["x"].to_numpy()
        if flat[-1] > 0:
            w = (flat[:w.size] / flat[-1]).reshape(w.shape).astype(np.float32)
        refine = refine + flat[w.size:-1].reshape(refine.shape)
    return w, (refine[1] / refine.sum(0)).astype(np.float32)


def costs(vocab: DataFrame, counts, weights: np.ndarray, refine: np.ndarray) -> DataFrame:
    """h, n, cost of the spelled words: log10 of a word's probability, its space included, without a group and in each."""
    s = np.linspace(-8, 8, FINE + 1)
    p = np.stack([(1 / (1 + np.exp(-s)) + np.interp(s, np.linspace(-8, 8, STEPS), row)) / 2 for row in refine]).clip(1e-6, 1 - 1e-6)
    of_bit = np.log10(np.stack([1 - p, p], 2)).astype(np.float32).ravel()

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        share = Share([b.select(["word", "n", "by", "cut"]) for b in held])
        table = share.tables(counts.value)
        packed = np.empty(table.shape[1], np.int32)
        for a in range(0, len(packed), 1 << 18):
            part = table[:, a:a + (1 << 18)]
            packed[a:a + (1 << 18)] = _stretched(*part).view(np.int32) & ~15 | _state(*part)  # the state in the lowest four bits
        del table
        spelled = np.concatenate([b.column(5).to_numpy(zero_copy_only=False) for b in held])
        mine = np.flatnonzero(spelled)
        out = np.zeros((len(mine), share.by.shape[1] + 1))
        for a, b, c in share.chunks(mine):
            for j in range(8):
                node, bit = c.node(j), c.bit(j).astype(np.int32)
                found = [packed[s] for s in (*c.short_slots(node), c.word_slots(node, -1))]
                common, state3 = np.stack(found, 1).view(np.float32), found[3] & 15
                for g in range(-1, out.shape[1] - 1):
                    if g < 0:
                        row = j * STATES
                    else:
                        x4 = packed[c.word_slots(node, g)]
                        row, x4 = j * STATES + (x4 & 15), x4.view(np.float32)
                    w = np.take(weights, row * STATES + state3, 0)
                    s = np.einsum("nk,nk->n", w[:, :4], common) + w[:, 5]
                    if g >= 0:
                        s += w[:, 4] * x4
                    at = (row * (FINE + 1) + ((s.clip(-8, 8) + 8) * (FINE // 16) + np.float32(0.5)).astype(np.int32)) * 2 + bit
                    out[a:b, g + 1] += np.add.reduceat(of_bit[at], c.first)
        h, n = (np.concatenate([b.column(k).to_numpy() for b in held])[mine] for k in (0, 2))
        for a in range(0, len(mine), 4096):
            part = out[a:a + 4096]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, part.size + 1, part.shape[1]).astype(np.int32)), pa.array(part.ravel().astype(np.float32)))
            yield pa.RecordBatch.from_arrays([pa.array(h[a:a + 4096]), pa.array(n[a:a + 4096]), lists], names=["h", "n", "cost"])

    kept = vocab.select("h", "word", "n", "by", "cut", "spelled")
    return kept.mapInArrow(run, "h long, n long, cost array<float>")


def _inferred(votes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group that the words before each word of a text speak for, and that of all its words; -1: none."""
    n, texts = len(votes), len(first) - 1
    if not votes.shape[1]:
        return np.full(n, -1), np.full(texts, -1)
    total = np.zeros((n + 1, votes.shape[1]))
    np.cumsum(votes, 0, out=total[1:])
    def best(at, start):
        x = total[at] - total[start]
        return np.where(x.min(1) < 0, x.argmax(1), -1)  # equal votes of 0 only: none
    return best(np.arange(n), np.repeat(first[:-1], np.diff(first))), best(first[1:], first[:-1])


def _groups(docs: DataFrame, learn: str, label: str | None) -> list[str]:
    """The most frequent labels of the training rows, GROUPS at most."""
    if label is None:
        return []
    by = docs.where(learn).where(F.col(label).isNotNull()).groupBy(F.col(label).cast("string").alias("g")).count()
    return sorted(r["g"] for r in by.orderBy(F.desc("count"), "g").limit(GROUPS).collect())


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.concatenate([np.zeros(0), *(c.flatten().to_numpy() for c in column.chunks)]).reshape(len(column), width)


def frequent(vocab: DataFrame, width: int, escapes: np.ndarray, ends: np.ndarray) -> tuple[Column, word_contexts.Code, tuple[np.ndarray, ...]]:
    """Which words are frequent; the code of these, an escape and the end; and of every word looked up, sorted by hash: h, place in the code, shares, log10, n, votes.

    escapes: counts of all words in training texts and by group; ends: of the training texts.
    """
    step = F.floor(F.log2("n") * 4)  # so that the counts of words fit some hundred rows
    steps = sorted(vocab.where(F.col("n") >= SEEN).groupBy(step.alias("s")).count().collect(), key=lambda r: -r["s"])
    total = np.cumsum([r["count"] for r in steps])
    least = next((r["s"] for r, t in zip(steps[::-1], total[::-1], strict=True) if t <= HEAD), None)
    coded = (F.col("n") >= SEEN) & (step >= least) if least is not None else F.lit(False)
    rows = vocab.where(coded | (F.col("m") > word_contexts.SHARE)).select("h", "n", "m", "by", coded.alias("coded")).toArrow()  # bounded: HEAD, and few
    h, n, m = (rows[c].to_numpy().astype(np.int64) for c in ("h", "n", "m"))
    by, is_coded = _matrix(rows["by"], width), rows["coded"].to_numpy().astype(bool)
    best = np.where(by.max(1) > 0, by.argmax(1), -1) if width else np.zeros(len(h))
    order = np.lexsort((h, -n, best, ~is_coded))
    size = int(is_coded.sum())
    h, n, m, by = h[order], n[order], m[order], by[order]
    left = escapes - np.append(n[:size].sum(), by[:size].sum(0))
    code = word_contexts.Code(np.concatenate((n[:size], [left[0], ends[0]])), np.concatenate((by[:size], [left[1:], ends[1:]])))
    votes = np.log((by + 0.5) / (by.sum(0) + 1))
    votes = votes - votes.max(1, keepdims=True) if width and len(votes) else votes
    at = np.argsort(h)
    none = lambda x, last: np.append(x[at], last)
    return coded, code, (h[at], none(np.minimum(np.arange(len(h)), size), size).astype(np.int64), none(-(-m // word_contexts.SHARE), 1),
                  none(np.log10(n + 0.1), 0.0), none(n > 0, False), np.concatenate((votes[at], np.zeros((1, width)))).astype(np.float32))


def score(spark: SparkSession, docs: DataFrame, learn: str, keep: list[str], text: str = "text", label: str | None = None) -> DataFrame:
    """``keep`` columns, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every row.

    ``learn``: boolean column of the rows to learn from; ``label``: column whose
    values group the training texts (no input of a score).
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    names = _groups(docs, learn, label)
    width = len(names)
    learned = F.coalesce(F.col(learn), F.lit(False))
    number = F.coalesce(*[F.when(F.col(label) == x, k) for k, x in enumerate(names)], F.lit(-1)) if names else F.lit(-1)
    number = F.when(learned, number).otherwise(-1).cast("int")
    at = docs.select(F.col(text), number.alias("_g"), learned.cast("int").alias("_n"))
    vocab = checkpointed(spark, vocabulary(at, text, "_g", "_n", width))
    texts = {(r["l"], r["g"]): r["count"] for r in docs.groupBy(learned.alias("l"), number.alias("g")).count().collect()}  # one row per group
    end_by = [texts.get((True, g), 0) for g in range(width)]
    ends, texts = sum(c for (is_learned, _), c in texts.items() if is_learned), sum(texts.values())
    sums = [F.coalesce(F.sum(F.col("by")[k]), F.lit(0)) for k in range(width)]
    m, n, distinct, rows, *by = vocab.agg(F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0)),
                                          F.count(F.when(F.col("n") > 0, 1)), F.count("*"), *sums).first()
    every, kinds = n + ends, distinct + (ends > 0)
    tasks = -(-rows // ROWS) + 1
    coded, code, lookup = frequent(vocab, width, np.array([n, *by], float), np.array([ends, *end_by], float))
    dealt = vocab.withColumn("cut", cut(vocab, rows)).select("h", "word", "n", "by", "cut", (~coded).alias("spelled")).withColumn("_start", F.expr("substring(word, 1, cut)")).repartition(tasks, "_start").drop("_start")
    dealt = checkpointed(spark, dealt)
    del vocab
    release(spark)
    counts = spark.sparkContext.broadcast(shared_tables(dealt.coalesce(max(1, -(-rows // TABLE_ROWS)))))
    spelled = checkpointed(spark, costs(dealt, counts, *mixer(dealt, counts)))
    counts.destroy()
    del dealt
    release(spark)
    escape = len(code.size) - 2
    looked_up, code = spark.sparkContext.broadcast(lookup), spark.sparkContext.broadcast(code)
    shares = max(1, -(-(m + texts) // word_contexts.SHARE))
    before_first = -(-texts // word_contexts.SHARE)
    fields = docs.select(*keep).schema
    extra = [("n_tokens", "long"), ("_head", "long"), ("_log", "double"), ("_rare", T.ArrayType(T.LongType())), ("_in", T.ArrayType(T.ByteType())),
             ("_bytes", "long"), ("_batch", "long"), ("_place", "integer"), ("_task", "long"), ("_blob", "binary"), ("_cost", "double")]
    for name, kind in extra:
        fields = fields.add(name, kind)
    columns = fields.fieldNames()

    def blobs(like: pa.Schema, batch: list[int], task: list[int], blob: list[bytes]) -> pa.RecordBatch:
        """Rows that hold no text, but what belongs to a batch of texts."""
        given = {"_batch": pa.array(batch, pa.int64()), "_task": pa.array(task, pa.int64()), "_blob": pa.array(blob, pa.binary())}
        return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(len(batch), f.type)) for f in like], schema=like)

    def split(batches):
        """Every text's row, and its words by the task that codes them."""
        head_h, head_rank, head_parts, head_log, head_known, head_votes = looked_up.value
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            data, offsets = words.texts(batch.column(len(keep)))
            part = data[offsets[0]:offsets[-1]]
            w = words._words(words.LOWER[part], words.SPACE[part], offsets - offsets[0])
            size = np.diff(w.first)
            doc = np.repeat(np.arange(batch.num_rows), size)
            h, back = np.unique(w.hashes, return_inverse=True)
            place = np.searchsorted(head_h, h.view(np.int64))
            found = head_h[np.minimum(place, len(head_h) - 1)] == h.view(np.int64) if len(head_h) else np.zeros(len(place), bool)
            place = np.where(found, place, len(head_h))[back]
            rank = head_rank[place]
            group, last = _inferred(head_votes[place], w.first)
            rare = np.flatnonzero(rank == escape)
            lists = [pa.ListArray.from_arrays(pa.array(np.searchsorted(rare, w.first).astype(np.int32)), pa.array(x[rare]))
                     for x in (w.hashes.view(np.int64), (group + 1).astype(np.int8))]
            usual = rank < escape
            mine = task << 32 | number
            out = pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(keep))), pa.array(size + 1, pa.int64()),
                 pa.array(np.bincount(doc, head_known[place] * usual, batch.num_rows).astype(np.int64)),
                 pa.array(np.bincount(doc, head_log[place] * usual, batch.num_rows).astype(np.float64)), *lists,
                 pa.array(np.diff(offsets), pa.int64()), pa.array(np.full(batch.num_rows, mine)), pa.array(np.arange(batch.num_rows), pa.int32()),
                 pa.array(np.arange(batch.num_rows) * 7919 + mine), pa.nulls(batch.num_rows, pa.binary()), pa.nulls(batch.num_rows, pa.float64())], names=columns)
            yield out
            parts = np.append(head_parts[place], before_first)
            learned = batch.column(len(keep) + 1).to_numpy()
            given = list(word_contexts.pack(w, rank, group, last, learned, parts, escape, shares))
            for a in range(0, len(given), 4096):
                some = given[a:a + 4096]
                yield blobs(out.schema, [mine] * len(some), [k for k, _ in some], [b for _, b in some])

    def code_words(batches):
        """Texts' rows as they are; of the words dealt to this task, the sums of each batch by text."""
        held, like = [], None
        for batch in batches:
            like = batch.schema
            blob = batch.column(columns.index("_blob"))
            full = np.asarray(blob.is_valid())
            if not full.all():
                yield batch.filter(pa.array(~full))
            held += [(x.as_py(), bytes(y.as_py())) for x, y in zip(batch.column(columns.index("_batch")).filter(pa.array(full)), blob.filter(pa.array(full)), strict=True)]
        if not held:
            return
        held.sort()
        context, what, two, doc = zip(*(word_contexts.unpack(b) for _, b in held), strict=True)
        edges = np.cumsum([0, *map(len, what)])
        cost = word_contexts.costs(np.concatenate(context), np.concatenate(what), np.concatenate(two), code.value)
        sums = [word_contexts.pack_sums(doc[k], cost[a:b]) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
        for a in range(0, len(held), 4096):
            part = held[a:a + 4096]
            yield blobs(like, [x for x, _ in part], [None] * len(part), sums[a:a + 4096])

    def add_up(batches):
        """Texts' rows, each with the sum of its words."""
        total, rows = {}, []
        for batch in batches:
            blob = batch.column(columns.index("_blob"))
            full = np.asarray(blob.is_valid())
            if not full.all():
                rows.append(batch.filter(pa.array(~full)))
            for mine, x in zip(batch.column(columns.index("_batch")).filter(pa.array(full)).to_pylist(), blob.filter(pa.array(full)), strict=True):
                at, x = word_contexts.unpack_sums(x.as_py())
                cost = total.setdefault(mine, np.zeros(4096))
                if at[-1] >= len(cost):
                    cost = total[mine] = np.append(cost, np.zeros(int(at[-1]) + 1 - len(cost)))
                cost[at] += x
        for batch in rows:
            mine, place = batch.column(columns.index("_batch")).to_numpy(), batch.column(columns.index("_place")).to_numpy()
            cost = np.array([total[a][b] for a, b in zip(mine.tolist(), place.tolist(), strict=True)], float)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(cost)], names=columns)

    at = docs.select(*keep, F.col(text).alias("_text"), learned.cast("int").alias("_learn"))
    at = at.mapInArrow(split, fields).repartition(shares, "_task").mapInArrow(code_words, fields)
    at = at.repartition(max(1, -(-texts // TEXTS)), "_batch").mapInArrow(add_up, fields).drop("_blob", "_task", "_batch", "_place")
    at = checkpointed(spark, at)
    release(spark)
    at = at.withColumn("_row", F.monotonically_increasing_id())  # fixed by the checkpoint
    rare = at.select("_row", F.inline(F.arrays_zip(F.col("_rare").alias("h"), F.col("_in").alias("g")))).groupBy("_row", "h", "g").agg(F.count("*").alias("k"))
    rare = rare.join(spelled, "h").groupBy("_row").agg(
        F.sum(F.col("k") * F.log10(F.col("n") + 0.1)).alias("_rare_log"), F.sum(F.col("k") * F.expr("double(cost[g])")).alias("_rare_cost"),
        F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("_rare_known"))
    done = at.drop("_rare", "_in").join(rare, "_row", "left").withColumn("score", F.col("_cost") + F.coalesce("_rare_cost", F.lit(0.0)))
    per_token = float(np.log10(every + 0.1 * (kinds + 1)))
    base = F.col("_log") + F.coalesce("_rare_log", F.lit(0.0)) + F.lit(float(np.log10(ends + 0.1))) - F.col("n_tokens") * F.lit(per_token)
    return done.select(*keep, "n_tokens", (F.col("_head") + F.coalesce("_rare_known", F.lit(0)) + int(ends > 0)).cast("long").alias("n_known"),
                       F.lit(every).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
                       (-F.col("score") / float(np.log10(2)) / F.greatest("_bytes", F.lit(1))).alias("bits_per_byte"))
