"""Phrase collocation mining by direct-address tiling.

Within a block of texts of one language, words become ids by falling frequency
(0 is the block's most frequent). A pair of ids is a cell of a matrix that is
cut into tiles of ``TILE`` x ``TILE`` cells: tiles with many pairs are counted
by a dense ``bincount``, the pairs of all other tiles as sorted coordinates.
The pairs that are frequent in the corpus are ranked by frequency in turn, and
counted with the word after them by the same code: that gives the phrases of
three words, and so on up to ``max_words``.

Blocks' counts, by 64-bit word hashes, are added up by Spark, partially before
the shuffle. A phrase can only be frequent if its parts are, so bit tables of
the frequent words and phrases (16 bits for each, ``BITS`` at most) keep the
rest from being counted; bits set by chance cost work alone, since the sums are
exact. Words of equal hashes, should any occur, are found in the exact
vocabulary and hashed anew by another function. Scores are made of 38-digit
decimals.

Defined cases: null and empty texts have no words; a null language is ``und``;
phrases don't cross ``[.,;:!?\\x0A-\\x0D]``; repeated rows count each; an empty
table gives no rows; ties are settled by phrase in UTF-8 byte order; a very long
text is a block of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm import words
from ledgerlake.llm.store import checkpointed, within_small_batches

MIN_COUNT = 10
TOP = 2000
PERCENT = 50              # a phrase goes if a longer one has this share of its count
TILE = 256                # ids a side
SIDE = 64                 # tiles a side that may be counted densely: the most frequent ids
DENSE = TILE * TILE // 4  # pairs from which on a tile is
TEXT = 2 << 20            # bytes of a language's text counted together
BITS = 1 << 28            # of a bit table, at most
CHUNK = 1 << 16           # bits of a table made by one group
CUTS = np.zeros(256, bool)
CUTS[[*b".,;:!?"]] = True
_ENDS = CUTS.copy()
_ENDS[0x0A:0x0E] = True


class Block(NamedTuple):
    """The words of texts of one language: hashes and numbers of their pieces; for a vocabulary, their bytes' places too."""

    lang: str
    hashes: np.ndarray
    piece: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


def _blocks(batches, rehashed: np.ndarray, places: bool = False) -> Iterator[Block]:
    """Blocks of TEXT bytes or a little more, the last ones of fewer."""
    kept: dict[str, list[Block]] = {}
    held: dict[str, int] = {}
    nothing = np.zeros(0, np.int64)
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            own = batch.column(1).filter(pa.array(langs.indices.to_numpy() == code))
            for _, _, w in words.blocks(own, cuts=CUTS):
                inner = np.zeros(len(w.data) + 1, np.int64)
                np.cumsum(_ENDS[w.data], out=inner[1:])
                piece = inner[w.starts] + np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))  # both only rise
                for i in np.flatnonzero(np.isin(w.hashes, rehashed)) if len(rehashed) else ():
                    word = w.data[w.starts[i]:w.ends[i]].tobytes()
                    w.hashes[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
                kept.setdefault(lang, []).append(Block(lang, w.hashes, piece, *((w.starts, w.ends, w.data) if places else [nothing] * 3)))
                held[lang] = held.get(lang, 0) + len(w.data)
                if held[lang] >= TEXT:
                    yield _joined(kept.pop(lang))
                    del held[lang]
        if sum(held.values()) >= 4 * TEXT:
            yield from map(_joined, kept.values())
            kept, held = {}, {}
    yield from map(_joined, kept.values())


def _joined(parts: list[Block]) -> Block:
    byte = np.cumsum([0, *(len(p.data) for p in parts)])[:-1]
    piece = np.cumsum([0, *(int(p.piece[-1]) + 1 if len(p.piece) else 0 for p in parts)])[:-1]
    shifted = lambda name, by: np.concatenate([getattr(p, name) + n for p, n in zip(parts, by, strict=True)])
    return Block(parts[0].lang, np.concatenate([p.hashes for p in parts]), shifted("piece", piece), shifted("starts", byte),
                 shifted("ends", byte), np.concatenate([p.data for p in parts]))


def ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values by falling frequency, and the id (place among them) of each value."""
    distinct, inverse, count = np.unique(values, return_inverse=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return distinct[order], rank[inverse]


def counted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of ids and their counts: crowded tiles densely, the others as sorted coordinates."""
    cells = TILE * TILE
    near = np.flatnonzero((a < SIDE * TILE) & (b < SIDE * TILE))
    tile = a[near] // TILE * SIDE + b[near] // TILE
    crowded = np.flatnonzero(np.bincount(tile, minlength=SIDE * SIDE) >= DENSE)
    slot = np.full(SIDE * SIDE, -1)
    slot[crowded] = np.arange(len(crowded))
    slot = slot[tile]
    inside = near[slot >= 0]
    dense = np.bincount(slot[slot >= 0] * cells + a[inside] % TILE * TILE + b[inside] % TILE, minlength=len(crowded) * cells)
    hit = np.flatnonzero(dense)
    own = crowded[hit // cells] if len(hit) else hit
    sparse = np.ones(len(a), bool)
    sparse[inside] = False
    wide = int(b.max()) + 1 if len(b) else 1
    code, n = np.unique(a[sparse] * wide + b[sparse], return_counts=True)
    return (np.concatenate((own // SIDE * TILE + hit % cells // TILE, code // wide)),
            np.concatenate((own % SIDE * TILE + hit % TILE, code % wide)), np.concatenate((dense[hit], n)))


def _keys(hashes: list[np.ndarray], lang: str) -> np.ndarray:
    """One key of a language and a phrase's words."""
    seed = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
    key = np.full(len(hashes[0]), seed, np.uint64)
    for h in hashes:
        key = words.mixed(key * np.uint64(0x9E3779B97F4A7C15) + h)
    return key


def _has(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys & np.uint64(8 * len(table) - 1)).astype(np.int64)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def bit_table(frequent: DataFrame, size: int) -> np.ndarray:
    """The bits of the phrases of ``size`` words, packed; made in pieces by Spark."""
    n = frequent.count()
    bits = min(BITS, max(CHUNK, 1 << (16 * n).bit_length()))
    cols = _cols(size)

    def keyed(batches):
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            code, key = langs.indices.to_numpy(), np.zeros(batch.num_rows, np.uint64)
            hashes = [batch.column(k + 1).to_numpy().view(np.uint64) for k in range(size)]
            for c, lang in enumerate(langs.dictionary.to_pylist()):
                key[code == c] = _keys([h[code == c] for h in hashes], lang)
            at = (key & np.uint64(bits - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at // CHUNK), pa.array((at % CHUNK).astype(np.int32))], names=["c", "bit"])

    def pieces(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            chunk, bit = (batch.column(k).to_numpy() for k in range(2))
            for c in np.unique(chunk).tolist():
                held.setdefault(c, np.zeros(CHUNK, bool))[bit[chunk == c]] = True
        for c, b in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([c]), pa.array([np.packbits(b).tobytes()], pa.binary())], names=["c", "b"])

    parts = max(1, min(bits // CHUNK, n // 100_000))
    table = np.zeros(bits // 8, np.uint8)
    for r in frequent.select("lang", *cols).mapInArrow(keyed, "c long, bit int").repartition(parts, "c").mapInArrow(pieces, "c long, b binary").collect():
        table[r["c"] * CHUNK // 8:(r["c"] + 1) * CHUNK // 8] = np.frombuffer(bytes(r["b"]), np.uint8)
    return table


def _cols(size: int) -> list[str]:
    return [f"h{k + 1}" for k in range(size)]


def vocabulary(docs: DataFrame, rehashed: np.ndarray) -> DataFrame:
    """lang, h1 (hash), word and n of every word."""
    def run(batches):
        for block in _blocks(batches, rehashed, places=True):
            distinct, at, n = np.unique(block.hashes, return_index=True, return_counts=True)
            size = block.ends[at] - block.starts[at]
            offsets = np.concatenate(([0], np.cumsum(size)))
            data = block.data[np.repeat(block.starts[at] - offsets[:-1], size) + np.arange(offsets[-1])]
            word = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([block.lang] * len(at), pa.string()), pa.array(distinct.view(np.int64)), word, pa.array(n)],
                                             names=["lang", "h1", "word", "n"])

    return docs.mapInArrow(run, "lang string, h1 long, word string, n long").groupBy("lang", "h1", "word").agg(F.sum("n").alias("n"))


def phrases(docs: DataFrame, size: int, tables: list[np.ndarray], rehashed: np.ndarray) -> DataFrame:
    """lang, h1 to h``size`` and n of the phrases of ``size`` words whose parts are frequent; ``tables``: of 1 to size - 1 words."""
    shared = docs.sparkSession.sparkContext.broadcast(tables)  # BITS each at most
    cols = _cols(size)

    def run(batches):
        for block in _blocks(batches, rehashed):
            known, ids = ranked(block.hashes)
            common = _has(shared.value[0], _keys([known], block.lang))[ids]
            # at: where runs of k frequent words of one piece start; head: the ids of these runs; parts: the words of each id
            at, parts = np.flatnonzero(common), known[:, None]
            head = ids[at]
            for k in range(1, size):
                going = at + k < len(ids)
                at, head = at[going], head[going]
                going = common[at + k] & (block.piece[at + k] == block.piece[at])
                at, head = at[going], head[going]
                if k > 1:
                    going = _has(shared.value[k - 1], _keys([block.hashes[at + j] for j in range(1, k + 1)], block.lang))
                    at, head = at[going], head[going]
                if k < size - 1:
                    code, head = ranked(head * len(known) + ids[at + k])
                    parts = np.hstack((parts[code // len(known)], known[code % len(known), None]))
                    going = _has(shared.value[k], _keys(list(parts.T), block.lang))[head]
                    at, head = at[going], head[going]
            a, b, n = counted(head, ids[at + size - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([block.lang] * len(a), pa.string()), *(pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (*parts[a].T, known[b])),
                 pa.array(n)], names=["lang", *cols, "n"])

    return docs.mapInArrow(run, f"lang string, {', '.join(f'{c} long' for c in cols)}, n long").groupBy("lang", *cols).agg(F.sum("n").alias("n"))


def scored(found: dict[int, DataFrame], size: int) -> DataFrame:
    """lang, the hashes, a, l, r and score of the phrases of ``size`` words: the cut of the lowest score, else the first."""
    cols, out = _cols(size), found[size].withColumnRenamed("n", "a")
    for k in range(1, size):
        for part, name in ((cols[:k], f"l{k}"), (cols[k:], f"r{k}")):
            out = out.join(found[len(part)].select("lang", *(F.col(a).alias(b) for a, b in zip(_cols(len(part)), part, strict=True)),
                                                   F.col("n").alias(name)), ["lang", *part])
    d = lambda c: f"cast({c} AS decimal(19,0))"
    cuts = [F.struct(F.expr(f"({d('a')} * {d('a')} * 1000000BD) div ({d(f'l{k}')} * {d(f'r{k}')})").alias("score"), F.lit(k).alias("k"),
                     F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, size)]
    best = F.array_min(F.array(*cuts))
    return out.select("lang", *cols, "a", best["l"].alias("l"), best["r"].alias("r"), best["score"].alias("score"))


def _independent(candidates: DataFrame, size: int, longer: dict[int, DataFrame], percent: int) -> DataFrame:
    """Without the phrases that a longer one covers: its count is at least ``percent`` of theirs."""
    cols, most = _cols(size), None
    for n, found in longer.items():
        for k in range(n - size + 1):
            part = found.groupBy("lang", *(F.col(f"h{k + j + 1}").alias(f"h{j + 1}") for j in range(size))).agg(F.max("n").alias("m"))
            most = part if most is None else most.union(part)
    if most is None:
        return candidates
    most = most.groupBy("lang", *cols).agg(F.max("m").alias("m"))
    return candidates.join(most, ["lang", *cols], "left").where(F.col("m").isNull() | (100 * F.col("m") < percent * F.col("a"))).drop("m")


def mine(spark: SparkSession, docs: DataFrame, lang: str = "lang", text: str = "text", max_words: int = 3, min_count: int = MIN_COUNT,
         top: int = TOP, percent: int = PERCENT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best ``top`` phrases."""
    docs = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    with within_small_batches(spark):
        rehashed = np.zeros(0, np.uint64)
        while True:
            every = checkpointed(spark, vocabulary(docs, rehashed))
            clash = [r["h1"] for r in every.groupBy("lang", "h1").agg(F.count("*").alias("c")).where("c > 1").select("h1").distinct().collect()]
            if not clash:
                break
            rehashed = np.union1d(rehashed, np.array(clash, np.int64).view(np.uint64))
        frequent = every.where(F.col("n") >= min_count)
        found, tables = {1: frequent.drop("word")}, []
        for size in range(2, max_words + 1):
            tables.append(bit_table(found[size - 1], size - 1))
            found[size] = checkpointed(spark, phrases(docs, size, tables, rehashed).where(F.col("n") >= min_count))
    none = F.lit(None).cast("long")
    best = None
    for size in range(2, max_words + 1):
        part = _independent(scored(found, size), size, {n: found[n] for n in range(size + 1, max_words + 1)}, percent)
        part = part.select("lang", *(c if c in part.columns else none.alias(c) for c in _cols(max_words)), "a", "l", "r", "score")
        best = part if best is None else best.union(part)
    order = [F.col("score").desc(), F.col("a").desc()]
    best = best.withColumn("_rank", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("_rank") <= top).drop("_rank")
    for c in _cols(max_words):  # their words, for the order of ties
        best = best.join(frequent.select("lang", F.col("h1").alias(c), F.col("word").alias(f"w_{c}")), ["lang", c], "left")
    best = best.withColumn("phrase", F.concat_ws(" ", *(f"w_{c}" for c in _cols(max_words))))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))).where(F.col("rank") <= top)
    total = every.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
