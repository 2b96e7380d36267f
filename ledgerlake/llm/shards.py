"""Sharding by sampled splitters (built-in functions only).

Records are ordered by (CRC-32 of the text, hash of the id, id, size), so equal
texts lie side by side and a group too large for one range is cut by the id
hash. A size-weighted sample of the keys gives the boundaries of many fine
ranges; ranges that come out overfull are subdivided by a denser sample of their
own. Exact byte and row totals per range then give every record its running
byte position, and the shard is that position's share of all bytes: shard sizes
differ by about one record (law ``bytes``). Slots number a shard's records in
key order without gaps.

Defined cases: null text has size 16 and CRC 0; null ids sort first; repeated
rows get slots of their own; an empty table gives an empty result. With fewer
records than shards some shards stay empty.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.store import checkpointed

OVERHEAD = 16
SAMPLES_PER_RANGE = 48      # expected; bounds what the driver sees of the keys
ROWS_PER_RANGE = 1_000_000  # a range is sorted by one task
MIN_RANGES = 640
OVERFULL = 3                # times the mean bytes of a range


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the 63-bit sort key of every record."""
    t = F.coalesce(F.col(text), F.lit(""))
    at = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(t) + OVERHEAD).cast("long").alias("size"),
                     F.crc32(t.cast("binary")).alias("text_crc32"))
    return at.withColumn("_key", F.shiftleft("text_crc32", 31).bitwiseOR(
        F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 31) - 1))))


def _sampled(rows: DataFrame, rate: float, seed: int) -> DataFrame:
    """_key and _weight of rows drawn with a probability in proportion to their size (1 at most)."""
    chance = F.col("size") * F.lit(rate)
    u = F.pmod(F.xxhash64("_key", "doc_id", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return rows.where(u < chance).select("_key", F.greatest(chance, F.lit(1.0)).alias("_weight"))


def _quantiles(sample: DataFrame, ranges: int) -> list[int]:
    """Keys at the weighted quantiles of a bounded sample."""
    run = Window.orderBy("_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    at = sample.select("_key", F.floor(F.sum("_weight").over(run) * ranges / F.sum("_weight").over(every)).alias("_q"))
    return sorted({r[0] for r in at.groupBy("_q").agg(F.min("_key")).select("min(_key)").collect()})


def _ranged(rows: DataFrame, bounds: list[int]) -> DataFrame:
    """``rows`` with the number of the range that ``_key`` is in: two searches of about sqrt(n) boundaries each."""
    if not bounds:
        return rows.withColumn("_range", F.lit(0))
    step = math.isqrt(len(bounds)) + 1
    blocks = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    block = F.size(F.filter(longs([b[0] for b in blocks]), lambda b: b <= F.col("_key")))
    within = F.size(F.filter(F.get(F.array(*[longs(b) for b in blocks]), F.col("_block") - 1),
                             lambda b: b <= F.col("_key")))
    number = F.when(F.col("_block") == 0, 0).otherwise((F.col("_block") - 1) * step + within)
    return rows.withColumn("_block", block).withColumn("_range", number).drop("_block")


def shard(spark: SparkSession, docs: DataFrame, shards: int = 40, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every record."""
    rows = checkpointed(spark, keyed(docs, doc_id, text))
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = max(MIN_RANGES, math.ceil(n / ROWS_PER_RANGE))
    bounds = _quantiles(_sampled(rows, ranges * SAMPLES_PER_RANGE / max(total, 1), 1), ranges)
    mean = total / ranges
    sizes = lambda b: _ranged(rows, b).groupBy("_range").agg(
        F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    over = [(r[0], r[1]) for r in sizes(bounds).where(F.col("_bytes") > OVERFULL * mean).select("_range", "_bytes").collect()]
    if over:  # at most ranges / OVERFULL of them
        parts = sum(math.ceil(b / mean) for _, b in over)
        inside = _ranged(rows, bounds).where(F.col("_range").isin([k for k, _ in over]))
        rate = parts * SAMPLES_PER_RANGE / sum(b for _, b in over)
        bounds = sorted({*bounds, *_quantiles(_sampled(inside, rate, 2), parts)})
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = sizes(bounds).select("_range", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_byte0"),
                                  F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row0"))
    within = Window.partitionBy("_range").orderBy("_key", "doc_id", "size")
    at = _ranged(rows, bounds).join(F.broadcast(starts), "_range")  # bounded by the number of ranges
    at = at.withColumn("_rank", F.col("_row0") + F.row_number().over(within) - 1).withColumn(
        "_mid", F.col("_byte0") + F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") / 2)
    at = at.withColumn("shard", F.least(F.floor(F.col("_mid") * shards / F.lit(max(total, 1))), F.lit(shards - 1)).cast("int"))
    at = at.select("doc_id", "size", "text_crc32", "shard", "_rank")
    first = at.groupBy("shard").agg(F.min("_rank").alias("_first"))  # one row per shard
    return at.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_rank") - F.col("_first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
