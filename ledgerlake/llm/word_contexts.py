"""Words of running text predicted from the words before them by online logistic mixing.

Frequent words, an escape for the others and the end of a text have a binary
code, built from halves of the training counts (words of one group stand
together). Every word of a text is coded by its bits; four predictors know how
often each bit followed: in all texts, in the text's inferred group, behind the
word before, and behind the two words before. Their stretched probabilities are
mixed with weights that a gate selects (place in the code, what is known of
the two contexts across words), learned online while the texts are coded.

Occurrences are dealt by the word before them, so a task holds all that ever
followed it and counts both contexts exactly, whatever the corpus' size. A word
before more than ``SHARE`` others is dealt by texts, too; each share counts its
own. What a task counts is what its training texts hold; a training occurrence
is coded with itself taken out of all counts. Words equal in all contexts are
coded once with their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ledgerlake.llm import words

SHARE = 1 << 18             # occurrences of a task, on average; those of one word before are cut there
FLOOR = 26                  # a word's weight in the code is 2^-FLOOR of all at least
LEVELS = (1, 3, 10, 40, 400)
STATES = 2 * (len(LEVELS) + 1)
PLACES = 4                  # kinds of bits: four each, all further ones together
START = (0.1, 0.35, 0.45, 0.3)  # weights of all texts, the group, the word before and the two before
RATE = 0.1
CHUNK = 8192                # rows coded between two updates of the weights
FIRST, BEFORE_FIRST = np.uint64(0x5BD1E995), np.uint64(0x1B873593)  # the "words" before a text
_U = np.uint64
_LEAST = np.float32(0.2)
_KNOWN = (2 * np.searchsorted(LEVELS, np.arange(LEVELS[-1] + 1), "right")).astype(np.int32)


class Code:
    """A full binary tree over words in their given order; counts by node, in all texts and by group."""

    def __init__(self, n: np.ndarray, by: np.ndarray):
        size, total = len(n), max(float(n.sum()), 1.0)
        weight = np.append(0, np.cumsum(np.maximum(n, total / (1 << FLOOR))))
        counts = np.zeros((size + 1, by.shape[1] + 1))
        np.cumsum(np.column_stack((n, by)), 0, out=counts[1:])
        low, high, rank = np.zeros(size, np.int64), np.full(size, size), np.arange(size)
        self.bits, self.size, self.nodes = np.zeros(size, np.uint32), np.zeros(size, np.int8), []
        found, used = [counts[-1:] - counts[:1]], 1
        while len(live := np.flatnonzero(high - low > 1)):
            d = len(self.nodes)
            a, b = low[live], high[live]
            middle = np.clip(np.searchsorted(weight, (weight[a] + weight[b]) / 2), a + 1, b - 1)
            one = rank[live] >= middle
            low[live], high[live] = np.where(one, middle, a), np.where(one, b, middle)
            self.bits[live] |= one.astype(np.uint32) << np.uint32(31 - d)
            self.size[live] = d + 1
            start, first, node = np.unique(low[live], return_index=True, return_inverse=True)
            found.append(counts[high[live][first]] - counts[start])
            at = np.zeros(size, np.int32)
            at[live] = node + used
            self.nodes.append(at)
            used += len(start)
        self.counts = np.concatenate(found).astype(np.float32)


def pack(w: words.Words, rank: np.ndarray, group: np.ndarray, last: np.ndarray, learned: np.ndarray, parts: np.ndarray, escape: int, tasks: int) -> Iterator[tuple[int, bytes]]:
    """(task, its occurrences) of a batch of texts.

    rank, group, parts: of every word, its place in the code, its text's group so far and the shares it is dealt
    to as a word before (one more entry: a text's beginning); last: a text's group at its end.
    """
    texts, count = len(w.first) - 1, np.diff(w.first)
    doc = np.repeat(np.arange(texts), count + 1)
    first = w.first[:-1] + np.arange(texts)
    end = w.first[1:] + np.arange(texts)
    body = np.ones(len(doc), bool)
    body[end] = False

    def tokens(of_words, of_ends, dtype):
        out = np.empty(len(doc), dtype)
        out[body], out[end] = of_words, of_ends
        return out

    def behind(x, at_first):
        out = np.empty_like(x)
        out[1:] = x[:-1]
        out[first] = at_first
        return out

    before = behind(tokens(w.hashes, 0, np.uint64), FIRST)
    two = behind(before, BEFORE_FIRST)
    dealt = behind(tokens(parts[:-1], 1, np.int64), parts[-1])
    context = words.mixed(before)
    task = (words.mixed(context + (doc % dealt).astype(np.uint64)) % _U(tasks)).astype(np.uint64)
    what = (tokens(rank, escape + 1, np.int64) << 5 | (tokens(group, last, np.int64) + 1) << 1 | learned[doc]).astype(np.int32)
    order = np.argsort(task << _U(32) | context >> _U(32), kind="stable")
    task, context = task[order], (context[order] >> _U(32)).astype(np.uint32)
    two, what, doc = (words.mixed(two[order]) >> _U(48)).astype(np.uint16), what[order], doc[order].astype(np.uint16)
    edge = np.flatnonzero(np.append(True, task[1:] != task[:-1])) if len(task) else np.zeros(0, np.int64)
    for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(task)], strict=True):
        at = np.flatnonzero(np.append(True, context[a + 1:b] != context[a:b - 1])).astype(np.uint32)
        yield int(task[a]), _packed(b - a, np.diff(np.append(at, b - a)), np.diff(context[a:b][at], prepend=np.uint32(0)), what[a:b], two[a:b], doc[a:b])


def _packed(n: int, count: np.ndarray, step: np.ndarray, what: np.ndarray, two: np.ndarray, doc: np.ndarray) -> bytes:
    return np.array([n, len(count)], np.uint32).tobytes() + _compressed(count.astype(np.uint32), step, what, two, doc)


def unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    """context, what, two, doc of a task's occurrences in one batch."""
    n, m = np.frombuffer(blob, np.uint32, 2).tolist()
    count, step, what, two, doc = _expanded(blob[8:], (m, np.uint32), (m, np.uint32), (n, np.int32), (n, np.uint16), (n, np.uint16))
    return np.repeat(np.cumsum(step, dtype=np.uint32), count), what, two, doc


def pack_sums(doc: np.ndarray, cost: np.ndarray) -> bytes:
    """The costs of a batch's occurrences, summed by text."""
    row, back = np.unique(doc, return_inverse=True)
    step = np.diff(row.astype(np.uint16), prepend=np.uint16(0))
    return np.array([len(row)], np.uint32).tobytes() + _compressed(step, np.bincount(back, cost, len(row)).astype(np.float32))


def unpack_sums(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob, np.uint32, 1)[0])
    step, cost = _expanded(blob[4:], (n, np.uint16), (n, np.float32))
    return np.cumsum(step, dtype=np.int64), cost


def _compressed(*numbers: np.ndarray) -> bytes:
    """The first bytes of all numbers before their second ones."""
    planes = (np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() for x in numbers)
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _expanded(data: bytes, *kinds: tuple[int, type]) -> list[np.ndarray]:
    size = [n * np.dtype(kind).itemsize for n, kind in kinds]
    raw, found, at = np.frombuffer(pa.decompress(data, decompressed_size=sum(size), codec="zstd"), np.uint8), [], 0
    for (n, kind), k in zip(kinds, size, strict=True):
        found.append(np.ascontiguousarray(raw[at:at + k].reshape(np.dtype(kind).itemsize, n).T).view(kind).ravel())
        at += k
    return found


def _shared_bits(context: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """How many bits of the code a row shares with the row before it; -1: another context."""
    out = np.full(len(bits), -1, np.int8)
    differ = bits[1:] ^ bits[:-1]
    out[1:] = np.where(context[1:] != context[:-1], -1, 32 - np.frexp(differ.astype(np.float64))[1])
    return out


def _totals(n: np.ndarray, shared: np.ndarray, depth: int) -> np.ndarray:
    """Of every row, the sum of all in its context with the same first bits."""
    new = shared < depth
    return np.add.reduceat(n, np.flatnonzero(new))[np.cumsum(new) - 1]


def costs(context: np.ndarray, what: np.ndarray, two: np.ndarray, code: Code) -> np.ndarray:
    """log10 of the probability of every occurrence."""
    if not len(what):
        return np.zeros(0)
    _, u = np.unique(context, return_inverse=True)
    # Two words tell nothing if no training text has them, or one that is coded without itself.
    both, at_both = np.unique(u.astype(np.uint64) << _U(16) | two.astype(np.uint64), return_inverse=True)
    seen, alike = np.bincount(at_both, what & 1, len(both)), np.bincount(at_both, minlength=len(both))
    both = np.where(seen < np.where(alike > 1, 1, 2), both >> _U(16) << _U(17), (both >> _U(16) << _U(17) | _U(1) << _U(16)) + (both & _U(0xFFFF)))
    key, back, m = np.unique(both[at_both] << _U(26) | what.astype(np.uint64), return_inverse=True, return_counts=True)
    rank, column = (key >> _U(5)).astype(np.int32) & (1 << 21) - 1, (key >> _U(1)).astype(np.int32) & 15
    own = (key & _U(1)).astype(np.float32)
    n, size = m.astype(np.float32) * own, code.size[rank]
    pair, at_pair = np.unique(key >> _U(43) << _U(21) | rank.astype(np.uint64), return_inverse=True)
    pair_n, pair_rank = np.bincount(at_pair, n, len(pair)).astype(np.float32), (pair & _U((1 << 21) - 1)).astype(np.int64)
    pair_shared, pair_size = _shared_bits(pair >> _U(21), code.bits[pair_rank]), code.size[pair_rank]
    counted = (key >> _U(42) & _U(1)).astype(np.float32)
    shared = _shared_bits(key >> _U(26), code.bits[rank])
    counts, width = code.counts.ravel(), code.counts.shape[1]
    weights = np.tile(np.array(START, np.float32), (PLACES * STATES * STATES, 1))
    out = np.zeros(len(key), np.float32)
    live = np.arange(len(key))
    before = [np.full(len(key), counts[0]), counts[column], _totals(pair_n, pair_shared, 0)[at_pair], _totals(n, shared, 0) * counted]
    for d in range(int(size.max(initial=0))):
        keep = size[live] > d
        if not keep.all():
            live, before, at_pair = live[keep], [x[keep] for x in before], at_pair[keep]
            keep = pair_size > d
            pair_n, pair_shared, pair_size, at_pair = pair_n[keep], pair_shared[keep], pair_size[keep], (np.cumsum(keep) - 1)[at_pair]
        at = code.nodes[d][rank[live]] * width
        after = [counts[at], counts[at + column[live]], _totals(pair_n, pair_shared, d + 1)[at_pair]]
        own_live, n_live = own[live], n[live]
        after.append(_totals(n_live, shared[live], d + 1) * counted[live])
        cost = np.empty(len(live), np.float32)
        place = np.int32(min(d // 4, PLACES - 1) * STATES * STATES)
        for a in range(0, len(live), CHUNK):
            part = slice(a, a + CHUNK)
            x, gate = [], place
            for k in range(4):
                ours, other = np.maximum(after[k][part] - own_live[part], 0), before[k][part] - after[k][part]
                x.append(np.log((ours + _LEAST) / (other + _LEAST)))
                if k > 1:  # how often the context was seen, and if always with the same bit
                    known = _KNOWN[np.minimum(ours + other, LEVELS[-1]).astype(np.int32)] + (np.minimum(ours, other) <= 0)
                    gate = gate + (known * STATES if k == 2 else known)
            w = np.take(weights, gate, 0)
            s = w[:, 0] * x[0]
            for k in range(1, 4):
                s += w[:, k] * x[k]
            np.minimum(np.maximum(s, -12, out=s), 12, out=s)
            p = 1 / (1 + np.exp(-s))
            cost[part] = np.log(p)
            each = n_live[part]
            error = each * (1 - p)
            curve = error * p
            total = np.bincount(gate, curve, len(weights)) + 1
            for k in range(4):
                scale = float(np.dot(curve, x[k] * x[k])) / max(float(curve.sum()), 1e-9) + 0.1
                weights[:, k] += (RATE * np.bincount(gate, error * x[k], len(weights)) / (scale * total)).clip(-0.1, 0.1)
        out[live] += cost
        before = after
    return (out / np.log(10))[back]
