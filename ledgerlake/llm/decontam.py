"""Benchmark decontamination by greedy string tiling.

Texts are compared as tokens: words in lower case (of any script) without ASCII
punctuation. Runs
of ``MIN_MATCH`` tokens that a document shares with a benchmark item seed the
comparison. A bit table of fixed size over the benchmark's runs lets each
document drop what can't match (the few bits set by chance are settled by an
exact join), and only the tokens inside shared runs are kept: no tile can lie
elsewhere. Running Karp-Rabin matching then finds, for each document and item
that share enough seeds, the longest common tiles again and again, marks their
tokens as used, and so covers reordered passages as well. A document is
contaminated by an item if tiles cover ``MIN_COVERAGE`` of the item's tokens.

Defined cases: null and empty texts match nothing; items shorter than MIN_MATCH
tokens can't be found; equal texts are compared once; every row with the id of
a contaminated text is reported once per item; an empty benchmark finds nothing.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import words
from ledgerlake.llm.store import checkpointed, small_batches

MIN_MATCH = 5
MIN_COVERAGE = 0.5
BITS = 1 << 22              # of the seed table, whatever the benchmark
BROADCAST_ROWS = 1_000_000  # texts' digests; beyond, a shuffle
CUTS = np.zeros(256, bool)
CUTS[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def _tokens(column: pa.Array):
    """(row, tokens of its text as 64-bit hashes)."""
    for start, _, w in words.blocks(column, cuts=CUTS):
        for k, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
            yield start + k, w.hashes[a:b]


def _runs(tokens: np.ndarray, size: int = MIN_MATCH) -> np.ndarray:
    x = np.zeros(max(0, len(tokens) - size + 1), np.uint64)
    for j in range(size):
        x = words.mixed(x * np.uint64(0x9E3779B97F4A7C15) + tokens[j:j + len(x)])
    return x


def _lists(rows: list[np.ndarray], kind) -> pa.Array:
    flat = np.concatenate(rows) if rows else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)], dtype=np.int32)), pa.array(flat.astype(kind)))


def items(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, its tokens and its runs (arrays of hashes)."""
    kind = benchmark.schema[item_id].dataType.simpleString()

    def run(batches):
        for batch in batches:
            tokens = [t for _, t in _tokens(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists([x.view(np.int64) for x in tokens], np.int64),
                 _lists([_runs(x).view(np.int64) for x in tokens], np.int64)], names=["item_id", "tokens", "runs"])

    return benchmark.select(item_id, F.lower(F.col(text))).mapInArrow(run, f"item_id {kind}, tokens array<long>, runs array<long>")


def _table(bench: DataFrame) -> np.ndarray:
    """The bits of all runs: BITS booleans at most reach the driver."""
    at = bench.select(F.explode("runs").alias("r")).select(F.pmod("r", F.lit(BITS)).cast("int").alias("bit")).distinct()
    table = np.zeros(BITS, bool)
    table[at.toPandas()["bit"].to_numpy(np.int64)] = True
    return np.packbits(table)


def shared_tokens(docs: DataFrame, table: np.ndarray, doc_id: str, text: str) -> DataFrame:
    """Of the documents with a run in the table: doc_id, key (of the text), and positions and hashes of those runs' tokens."""
    kind = docs.schema[doc_id].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(table)  # fixed size

    def run(batches):
        bits = np.unpackbits(shared.value).view(bool)
        for batch in batches:
            rows, keys, places, hashes = [], [], [], []
            for start, _, w in words.blocks(batch.column(1), cuts=CUTS):
                every = words.runs(w, MIN_MATCH)
                hits = np.flatnonzero(bits[(every.view(np.int64) % BITS)])
                doc = np.searchsorted(w.first, hits, "right") - 1
                hits, doc = (x[hits + MIN_MATCH <= w.first[doc + 1]] for x in (hits, doc))
                for d in np.unique(doc).tolist():
                    a, b = w.first[d], w.first[d + 1]
                    used = np.zeros(b - a, bool)
                    for j in range(MIN_MATCH):
                        used[hits[doc == d] - a + j] = True
                    at = np.flatnonzero(used)
                    own = w.hashes[a:b]
                    key = np.add.reduce(words.mixed(own + words.mixed(np.arange(b - a, dtype=np.uint64))))
                    rows.append(start + d)
                    keys.append(key)
                    places.append(at)
                    hashes.append(own[at].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(np.array(keys, np.uint64).view(np.int64)),
                 _lists(places, np.int32), _lists(hashes, np.int64)], names=["doc_id", "key", "pos", "tok"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.lower(F.col(text)).alias("text")).mapInArrow(
        run, f"doc_id {kind}, key long, pos array<int>, tok array<long>")


def _run_lengths(ok: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """From each position on, how many are ok in a row; ``joined``: whether the next position belongs to the run."""
    stop = np.flatnonzero(~(ok & joined)) if len(ok) else np.zeros(0, np.int64)
    end = stop[np.searchsorted(stop, np.arange(len(ok)))] if len(ok) else stop
    return np.where(ok, end - np.arange(len(ok)) + ok[end], 0) if len(ok) else np.zeros(0, np.int64)


def _maximal(doc: np.ndarray, chained: np.ndarray, item: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length, place in the item, index in the document) of all matches of ``least`` tokens and more that can't be
    extended either way: windows met by their Karp-Rabin hashes, lengths by binary search on the same running sums."""
    power = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(max(len(doc), len(item)), 0x9E3779B97F4A7C15, np.uint64))))
    total_d, total_i = (np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * power[:len(x)]))) for x in (doc, item))
    top = len(power) - 1
    hashed = lambda total, at, n: (total[at + n] - total[at]) * power[top - at]  # noqa: E731  (equal windows get equal powers)
    run = _run_lengths(np.ones(len(doc), bool), chained)
    at_d = np.flatnonzero(run >= least)
    keys = hashed(total_d, at_d, least)
    order = np.argsort(keys, kind="stable")
    at_d, keys = at_d[order], keys[order]
    found = [np.zeros((3, 0), np.int64)]
    for a in range(len(item) - least + 1):
        key = hashed(total_i, np.array([a]), least)[0]
        b = at_d[np.searchsorted(keys, key, "left"):np.searchsorted(keys, key, "right")]
        if a:  # a match that goes on to the left is found from there
            b = b[(b == 0) | ~chained[b - 1] | (doc[b - 1] != item[a - 1])]
        if not len(b):
            continue
        low, high = np.full(len(b), least), np.minimum(run[b], len(item) - a)
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = hashed(total_d, b, mid) == hashed(total_i, np.full(len(b), a), mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        found.append(np.stack((low, np.full(len(b), a), b)))
    n, a, b = np.concatenate(found, 1)
    return n, a, b


def tiles(doc: np.ndarray, place: np.ndarray, item: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """(place in the item, place in the document, length) of the greedy tiles: always the longest match that is
    still free (of equal ones the first in the item, then in the document). ``place``: the tokens' positions.
    A match that marked tokens cut goes back to the queue in its free parts."""
    if len(item) < least or len(doc) < least:
        return []
    chained = np.concatenate((place[1:] == place[:-1] + 1, [False]))  # the next token is next in the text too
    free_d, free_i, out = np.ones(len(doc), bool), np.ones(len(item), bool), []
    queue = [(-n, a, b) for n, a, b in zip(*(x.tolist() for x in _maximal(doc, chained, item, least)), strict=True)]
    heapq.heapify(queue)
    left = len(item)
    while queue and left >= least:
        n, a, b = heapq.heappop(queue)
        free = free_i[a:a - n] & free_d[b:b - n]
        if free.all():
            if (item[a:a - n] == doc[b:b - n]).all():
                free_i[a:a - n] = free_d[b:b - n] = False
                out.append((a, int(place[b]), -n))
                left += n
            continue
        edge = np.flatnonzero(np.diff(np.concatenate(([0], free, [0]))))
        for first, last in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if last - first >= least:
                heapq.heappush(queue, (first - last, a + first, b + first))
    return sorted(out)


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, coverage, n_tiles, longest_tile, n_covered, n_item_tokens of every contaminated document and item."""
    small_batches(spark)
    bench = checkpointed(spark, items(benchmark.select(item_id, F.col(item_text)), item_id, item_text))
    found = checkpointed(spark, shared_tokens(docs, _table(bench), doc_id, text))
    texts = found.select("key", "pos", "tok").dropDuplicates(["key"])

    def seeds(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy()
            runs = []
            for pos, tok in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                p, every = np.array(pos), _runs(np.array(tok, np.int64).view(np.uint64))
                runs.append(np.unique(every[p[MIN_MATCH - 1:] - p[:len(every)] == MIN_MATCH - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(keys, [len(r) for r in runs])),
                                              pa.array(np.concatenate(runs).view(np.int64))], names=["key", "r"])

    known = bench.select("item_id", F.size("tokens").alias("n"), F.posexplode("runs").alias("place", "r"))
    pairs = texts.mapInArrow(seeds, "key long, r long").join(known, "r").groupBy("key", "item_id").agg(
        F.count("*").alias("k"), F.first("n").alias("n"))
    pairs = pairs.where(F.col("k") * MIN_MATCH >= MIN_COVERAGE * F.col("n"))  # a shared run covers MIN_MATCH tokens at most
    at = pairs.select("key", "item_id").join(texts, "key").join(bench.select("item_id", "tokens"), "item_id")

    def tiled(batches):
        for batch in batches:
            out = []
            for pos, tok, item in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                t = tiles(np.array(tok, np.int64).view(np.uint64), np.array(pos, np.int64), np.array(item, np.int64).view(np.uint64))
                out.append((len(t), max((n for _, _, n in t), default=0), sum(n for _, _, n in t), len(item)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array([x[k] for x in out], pa.int64()) for k in range(4))],
                names=["key", "item_id", "n_tiles", "longest_tile", "n_covered", "n_item_tokens"])

    kind = benchmark.schema[item_id].dataType.simpleString()
    done = at.select("key", "item_id", "pos", "tok", "tokens").mapInArrow(
        tiled, f"key long, item_id {kind}, n_tiles long, longest_tile long, n_covered long, n_item_tokens long")
    done = done.withColumn("coverage", F.col("n_covered") / F.col("n_item_tokens")).where(F.col("coverage") >= MIN_COVERAGE)
    return found.select("doc_id", "key").distinct().join(done, "key").drop("key").select(
        "doc_id", "item_id", "coverage", "n_tiles", "longest_tile", "n_covered", "n_item_tokens")


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents (all columns) that no benchmark item contaminates; each row by its own text, whatever its id."""
    at = docs.withColumn("__text", F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    gone = checkpointed(spark, contaminated(spark, at, benchmark, "__text", text).select(F.col("doc_id").alias("__gone")).distinct())
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return at.join(gone, F.col("__text") == F.col("__gone"), "left_anti").drop("__text")
