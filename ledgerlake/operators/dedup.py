"""Latest-per-key, first/last-wins dedup and high-water marks.

``row_number() <= k`` filters are planned by Spark with a partial
``WindowGroupLimit`` before the shuffle, so a hot key ships at most one row
per map task: the window never holds a whole hot group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import col
from .joins import lookup_join


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _orders(order) -> list[Column]:
    if isinstance(order, (str, Column)):
        order = [order]
    return [col(o) for o in order]


def first_per_key(df: DataFrame, keys, order: Sequence, k: int = 1) -> DataFrame:
    """The first ``k`` rows of every key under ``order`` (which must break ties)."""
    w = Window.partitionBy(*_keys(keys)).orderBy(*_orders(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def latest_per_key(df: DataFrame, keys, by, tie=None) -> DataFrame:
    """Newest row per key by ``by`` (descending); ties go to the smallest ``tie``."""
    order = [col(c).desc() for c in _orders(by)]
    if tie is not None:
        order += [col(c).asc() for c in _orders(tie)]
    return first_per_key(df, keys, order)


def dedup(df: DataFrame, keys, ordinal, keep: str = "first") -> DataFrame:
    """One row per key: ``keep='first'`` is the smallest ordinal (insert loop,
    ``DO NOTHING``), ``keep='last'`` the largest (dict built over the batch)."""
    o = [col(c) for c in _orders(ordinal)]
    if keep == "first":
        order = [c.asc() for c in o]
    elif keep == "last":
        order = [c.desc() for c in o]
    else:
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    return first_per_key(df, keys, order)


def high_water_mark(df: DataFrame, keys, ts: str, alias: str = "hwm") -> DataFrame:
    """Max event time per key (partial aggregation, skew-safe)."""
    return df.groupBy(*_keys(keys)).agg(F.max(ts).alias(alias))


def newer_than_known(df: DataFrame, known: DataFrame, keys, ts: str, hwm: str = "hwm") -> DataFrame:
    """Rows strictly newer than their key's high-water mark; keys never seen pass.

    Late rows (at or before the mark) are dropped, i.e. a zero-delay watermark
    per key. ``known`` has one row per key; it is broadcast when proven small
    so the rows are never shuffled on a (typically low-cardinality) key, and
    joined salted otherwise.
    """
    keys = _keys(keys)
    joined = lookup_join(df, known.select(*keys, hwm), keys, "left")
    return joined.filter(F.col(hwm).isNull() | (F.col(ts) > F.col(hwm))).drop(hwm)
