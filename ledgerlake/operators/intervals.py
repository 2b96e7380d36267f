"""Interval join: points to the ranges that hold them, as an equality join.

Ranges are grouped into classes by length (the power of two at or above it). In
a class, buckets are as wide as the longest range may be, so every range lies in
two of them at most, however long it is; a point lies in one bucket per class
that occurs (64 at most, counted beforehand). Joined on key, class and bucket,
the pairs are then refined by the exact bounds: no nested loop, no broadcast of
ranges, and each match occurs once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def range_join(points: DataFrame, ranges: DataFrame, point: str, first: str, last: str, by: Sequence[str] = ()) -> DataFrame:
    """Inner join of ``points`` with the ``ranges`` for which ``first <= point <= last`` (both inclusive) and ``by`` is equal.

    Columns: those of ``points``, then those of ``ranges`` but ``by``. NULL points
    and bounds, and ranges that end before they begin, match nothing; overlapping
    and repeated ranges match each. The classes are found by a job of their own.
    """
    by = list(by)
    size = F.col(last).cast("long") - F.col(first).cast("long")
    # size is the length less one: its binary digits give the class, 0 for a single value.
    classed = ranges.filter(F.col(first) <= F.col(last)).withColumn("_class", F.when(size == 0, 0).otherwise(F.length(F.bin(size))))
    classes = sorted(r[0] for r in classed.select("_class").distinct().collect())
    if not classes:
        return points.join(ranges.limit(0), by) if by else points.limit(0).join(ranges.limit(0), F.lit(False))
    bucket = lambda c: F.expr(f"shiftright(cast(`{c}` AS bigint), _class)")
    spread = classed.withColumn("_bucket", F.explode(F.array_distinct(F.array(bucket(first), bucket(last)))))
    placed = points.withColumn("_class", F.explode(F.array(*[F.lit(c) for c in classes]))).withColumn("_bucket", bucket(point))
    joined = placed.join(spread, [*by, "_class", "_bucket"])
    inside = (placed[point] >= spread[first]) & (placed[point] <= spread[last])
    return joined.filter(inside).drop("_class", "_bucket")
