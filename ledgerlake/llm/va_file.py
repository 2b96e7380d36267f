"""Centroid clustering over a VA-file.

Components become integers (``floor(scale * x)``); every vector is also kept as
one cell of ``BITS`` bits per dimension. The inner cells are of equal width
between two quantiles of a bounded sample of ``SAMPLE`` vectors (cells of equal
population would be wide where distances are large), the outer edges are the
least and greatest component of all vectors, so that every cell is an interval
that holds its components for certain. For given centroids a lookup table per dimension and cell gives the
least and greatest squared distance to each centroid; their sums bound a
vector's distance from both sides. Only where several centroids' intervals
overlap the full vector is fetched, and compared with those centroids alone, in
64-bit integers. The edges decide how often that happens, never the result.
The new centroids are exact integer sums and counts: whole within a task, then
added up by Spark as 38-digit decimals (``k`` times the dimensions rows).

Every round reads one checkpointed table (identifier, cells, vector), is one map
stage and one aggregation of partial sums; only centroids reach the driver.

Defined cases: null vectors, vectors of another length and those with a null or
non-finite component are left out; with fewer than ``k`` vectors each of them
starts a centroid; equal distances go to the smaller number; centroids that
lose all vectors stay as they are; a null identifier sorts by the hash of
``1:``, equal hashes by the vectors' components; repeated rows count each; an
empty table gives no rows. Components of 2^27 and more after scaling stop the
job, since their distances needn't fit in a long.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.store import checkpointed

BITS = 6             # of a cell
CELLS = 1 << BITS
SAMPLE = 4096        # vectors whose quantiles bound the inner edges
TAIL = 0.002         # share of the sample on either side that the outer cells take
LIMIT = 1 << 27      # of a component: 64 squares of twice that fit in a long
ROWS = 4096          # compared at once


def _vectors(column: pa.Array, dim: int, scale: float) -> np.ndarray:
    """Integer components of whole vectors."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(scale * flat)
    if len(whole) and np.abs(whole).max() >= LIMIT:
        raise ValueError(f"component of {np.abs(whole).max():g} after scaling; distances are exact below {LIMIT} only")
    return whole.astype(np.int32).reshape(-1, dim)


def usable(vectors: DataFrame, vec_id: str, vector: str, dim: int) -> DataFrame:
    """Identifier and components (as doubles) of the vectors that take part."""
    x = F.col(vector).cast("array<double>")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return vectors.where((F.size(vector) == dim) & F.forall(x, finite)).select(F.col(vec_id).alias("_id"), x.alias("_x"))


def first_centroids(found: DataFrame, k: int, dim: int, scale: float) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of their identifiers."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    rows = found.select("_x", key.alias("h")).orderBy("h", "_x").limit(k).collect()
    return np.floor(scale * np.array([r["_x"] for r in rows], np.float64)).astype(np.int64).reshape(-1, dim)


def edges(found: DataFrame, dim: int, scale: float) -> np.ndarray:
    """Per dimension the CELLS + 1 ascending edges; cell c holds the components from edge c to edge c + 1, less one."""
    def run(batches):
        low, high = np.full(dim, LIMIT, np.int64), np.full(dim, -LIMIT, np.int64)
        for batch in batches:
            x = _vectors(batch.column(0), dim, scale)
            if len(x):
                low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(low), pa.array(high)], names=["d", "low", "high"])

    ends = found.select("_x").mapInArrow(run, "d long, low long, high long").groupBy("d").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d").collect()
    some = found.select("_x").orderBy(F.xxhash64("_x")).limit(SAMPLE).collect()
    sample = np.floor(scale * np.array([r["_x"] for r in some], np.float64)).reshape(-1, dim)
    at = np.floor(np.linspace(*np.quantile(sample, [TAIL, 1 - TAIL], axis=0), CELLS - 1, axis=1)).astype(np.int64)
    low, high = (np.array([r[c] for r in ends], np.int64)[:, None] for c in ("low", "high"))
    return np.sort(np.hstack((low, at.clip(low, high), high + 1)), axis=1)


def _pack(cells: np.ndarray) -> np.ndarray:
    """BITS bits a cell, without gaps."""
    bits = np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - BITS:]
    return np.packbits(bits.reshape(len(cells), -1), axis=1)


def _unpack(packed: np.ndarray, dim: int) -> np.ndarray:
    bits = np.unpackbits(packed, axis=1, count=dim * BITS).reshape(len(packed), dim, BITS)
    return np.packbits(bits, axis=2)[:, :, 0] >> (8 - BITS)


def _fixed(column: pa.Array, kind, width: int) -> np.ndarray:
    """The rows of a binary column of equal lengths."""
    if not len(column):
        return np.zeros((0, width), kind)
    _, offsets, data = column.buffers()
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    start = int(np.frombuffer(offsets, wide)[column.offset])
    return np.frombuffer(data, kind, len(column) * width, start).reshape(len(column), width)


def _binary(rows: np.ndarray) -> pa.Array:
    size = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [
        None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * size), pa.py_buffer(np.ascontiguousarray(rows))])


def compressed(spark: SparkSession, found: DataFrame, edge: np.ndarray, dim: int, scale: float) -> DataFrame:
    """The VA-file: identifier, packed cells, integer vector."""
    def run(batches):
        for batch in batches:
            x = _vectors(batch.column(1), dim, scale)
            cells = np.stack([np.searchsorted(edge[d, 1:-1], x[:, d], "right") for d in range(dim)], 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column(0), _binary(_pack(cells)), _binary(x)], names=["_id", "cells", "vec"])

    return checkpointed(spark, found.mapInArrow(run, found.select("_id").schema.add("cells", "binary").add("vec", "binary")))


class Nearest:
    """Nearest centroids by distance intervals; ``low`` and ``high``: squared distance by dimension, cell and centroid."""

    def __init__(self, edge: np.ndarray, centroids: np.ndarray):
        self.centroids = centroids
        c = centroids.T[:, None, :]
        first, last = edge[:, :-1, None], edge[:, 1:, None] - 1
        below, above = first - c, c - last
        self.low = np.maximum(np.maximum(below, above), 0) ** 2
        self.high = np.maximum(np.abs(below), np.abs(above)) ** 2

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """Which centroids may be nearest."""
        low, high = (np.zeros((len(cells), len(self.centroids)), np.int64) for _ in range(2))
        for d in range(cells.shape[1]):
            low += self.low[d, cells[:, d]]
            high += self.high[d, cells[:, d]]
        return low <= high.min(1)[:, None]

    def assign(self, cells: np.ndarray, vec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and number of candidates."""
        chosen = self.candidates(cells)
        size = chosen.sum(1)
        best = chosen.argmax(1)
        open_ = np.flatnonzero(size > 1)
        row, c = np.nonzero(chosen[open_])
        gap = vec[open_[row]].astype(np.int64) - self.centroids[c]
        exact = np.full((len(open_), len(self.centroids)), np.iinfo(np.int64).max)
        exact[row, c] = np.einsum("ij,ij->i", gap, gap)
        best[open_] = exact.argmin(1)
        return best, size


def _blocks(batches, dim: int):
    """(identifiers, cells, vectors) of at most ROWS rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield (part.column(0), _unpack(_fixed(part.column(part.num_columns - 2), np.uint8, -(-dim * BITS // 8)), dim),
                   _fixed(part.column(part.num_columns - 1), np.int32, dim))


def moved(table: DataFrame, edge: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    k, dim = centroids.shape

    def run(batches):
        near, total, count = Nearest(edge, centroids), np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for _, cells, vec in _blocks(batches, dim):
            best, _ = near.assign(cells, vec)
            count += np.bincount(best, minlength=k)
            for c in np.unique(best).tolist():
                total[c] += vec[best == c].sum(0, dtype=np.int64)
        for c in np.flatnonzero(count).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([c]), pa.array([count[c]]), pa.array([total[c]])], names=["c", "n", "total"])

    parts = table.mapInArrow(run, "c long, n long, total array<long>")
    sums = parts.select("c", "n", F.posexplode("total").alias("d", "x")).groupBy("c", "d").agg(
        F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n")).collect()
    new = centroids.copy()
    for r in sums:
        new[r["c"], r["d"]] = int(r["x"]) // r["n"]
    return new


def cluster(spark: SparkSession, vectors: DataFrame, k: int = 16, rounds: int = 3, vec_id: str = "vec_id", vector: str = "embedding",
            dim: int = 64, scale: float = 64.0) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256, n_candidates of every vector that takes part."""
    found = usable(vectors, vec_id, vector, dim)
    centroids = first_centroids(found, k, dim, scale)
    ids = found.select(F.col("_id").alias("vec_id")).schema
    if not len(centroids):
        return found.select(F.col("_id").alias("vec_id"), F.lit(0).alias("cluster"), *(F.lit(0).cast("long").alias(c) for c in (
            "distance", "cluster_inertia", "inertia")), F.lit("").alias("centroid_sha256"), F.lit(0).alias("n_candidates")).limit(0)
    edge = edges(found, dim, scale)
    table = compressed(spark, found, edge, dim, scale)
    for _ in range(rounds):
        centroids = moved(table, edge, centroids)

    def run(batches):
        near = Nearest(edge, centroids)
        for own, cells, vec in _blocks(batches, dim):
            best, size = near.assign(cells, vec)
            gap = vec.astype(np.int64) - centroids[best]
            yield pa.RecordBatch.from_arrays([own, pa.array(best.astype(np.int32)), pa.array(np.einsum("ij,ij->i", gap, gap)),
                                              pa.array(size.astype(np.int32))], names=["vec_id", "cluster", "distance", "n_candidates"])

    done = checkpointed(spark, table.mapInArrow(run, ids.add("cluster", "integer").add("distance", "long").add("n_candidates", "integer")))
    inertia = {r["cluster"]: int(r["x"]) for r in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("x")).collect()}
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()
    facts = spark.createDataFrame([(c, x, sum(inertia.values()), digest(c)) for c, x in inertia.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # k rows at most
    return done.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_candidates")
