"""Joins of big facts to per-key lookups, planned without running anything first.

The join stays lazy: Catalyst and AQE broadcast the lookup when its measured
bytes allow, and AQE splits skewed partitions of a shuffled join. Only a caller
that knows a key to be hot, where the lookup is an aggregate that AQE can't
split against, asks for salting, with as many buckets as the heat needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lookup_join(df: DataFrame, lookup: DataFrame, on, how: str = "inner", salt_buckets: int = 1) -> DataFrame:
    """Join ``df`` to a per-key ``lookup`` (one row per key: extents, totals, known marks, dimension rows).

    With ``salt_buckets`` above 1 every ``df`` row gets a deterministic salt (a
    hash of the row, so a retried task reproduces it) and the lookup is
    replicated once per salt: a hot key's rows spread over that many reducers.
    """
    on = [on] if isinstance(on, str) else list(on)
    if salt_buckets <= 1:
        return df.join(lookup, on, how)
    hashable = [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    salt = F.pmod(F.xxhash64(*hashable), F.lit(salt_buckets)) if hashable else F.lit(0).cast("long")
    salted = df.withColumn("_salt", salt)
    replicated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                                 F.lit(salt_buckets - 1).cast("long"))))
    return salted.join(replicated, on + ["_salt"], how).drop("_salt")
