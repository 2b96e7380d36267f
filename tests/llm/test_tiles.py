"""Greedy string tiling against a tiler that tries every pair of places."""

import random
import time

import numpy as np

from ledgerlake.llm import decontam


def brute(doc, place, item, least):
    free_d, free_i, out = [True] * len(doc), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for a in range(len(item)):
            for b in range(len(doc)):
                n = 0
                while (a + n < len(item) and b + n < len(doc) and free_i[a + n] and free_d[b + n] and item[a + n] == doc[b + n]
                       and (n == 0 or place[b + n] == place[b + n - 1] + 1)):
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < least:
            return sorted(out)
        free_i[a:a + n] = free_d[b:b + n] = [False] * n
        out.append((a, place[b], n))


def test_tiles_equal_brute_force():
    r = random.Random(2)
    for _ in range(200):
        some = r.choice([1, 2, 3, 8])
        doc, item = ([r.randrange(some) for _ in range(r.randrange(n))] for n in (60, 40))
        if len(item) > 12 and len(doc) > 30:  # a copied passage, cut and reordered
            doc[5:11], doc[15:21] = item[6:12], item[:6]
        place = np.cumsum([r.choice([1, 1, 1, 1, 1, 1, 3]) for _ in doc]).astype(np.int64)
        least = r.choice([2, 3, 5])
        got = decontam.tiles(np.array(doc, np.uint64), place, np.array(item, np.uint64), least)
        assert got == brute(doc, place.tolist(), item, least)


def test_repeated_tokens_take_no_cubic_time():
    start = time.monotonic()
    for period in (1, 2, 7):
        doc, item = (np.arange(n, dtype=np.uint64) % np.uint64(period) for n in (40_000, 400))
        assert decontam.tiles(doc, np.arange(40_000), item) == [(0, 0, 400)]
    assert time.monotonic() - start < 20
