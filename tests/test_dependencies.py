"""Minimal functional dependencies against trying every set of columns."""

import random
from itertools import combinations

import pytest

from pyspark.sql import functions as F

from ledgerlake.operators import dependencies as module
from ledgerlake.operators.dependencies import dependencies


def brute(rows, columns, max_left):
    at = {c: i for i, c in enumerate(columns)}
    size = lambda cols: len({tuple(r[at[c]] for c in cols) for r in rows})
    out = set()
    for k in range(max_left + 1):
        for left in combinations(sorted(columns), k):
            for a in columns:
                if a not in left and size(left) == size((*left, a)) and not any(r == a and set(x) <= set(left) for x, r in out):
                    out.add((left, a))
    return out


def _table(r, kind):
    n = r.choice([0, 1, 2, 12, 40])
    rows = []
    for i in range(n):
        a, b = r.randrange(4), r.choice([None, 0, 1, 2])
        rows.append((a, b, (a, b) if kind == 1 else r.randrange(3), a % 2 if kind else r.randrange(2), i if kind == 2 else r.randrange(9), 7))
    return [tuple(str(x) if x is not None else None for x in row) for row in rows]


@pytest.mark.parametrize("kind", [0, 1, 2])
@pytest.mark.parametrize("max_left", [1, 4])
def test_equals_brute_force(spark, kind, max_left):
    columns = list("fedcba")
    for seed in range(2):
        rows = _table(random.Random(10 * kind + seed), kind)
        df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
        got = {(tuple(r.left), r.right) for r in dependencies(df, max_left=max_left).collect()}
        assert got == brute(rows, columns, max_left)


def test_on_the_given_tables(spark):
    for name in ("part", "orders"):
        df = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        got = {(tuple(r.left), r.right) for r in dependencies(df).collect()}
        assert got == brute([tuple(r) for r in df.collect()], df.columns, 4)


def test_tasks_hold_a_fixed_number_of_cells(spark, monkeypatch):
    """Four times the rows take four times the tasks, not four times the memory; a common value gathers nowhere."""
    monkeypatch.setattr(module, "CELLS", 1000)
    sets = [frozenset(x) for x in ("a", "b", "ab")]
    for n in (1000, 4000):
        rows = spark.range(0, n, 1, 2).select(F.col("id").alias("a"), F.when(F.col("id") % 10 == 0, F.col("id")).alias("b"), F.lit(0).alias("_slice_"))
        groups = module._groups(rows, n, sets)
        assert groups.rdd.getNumPartitions() == 3 * n // 1000
        held = [r["count"] for r in groups.groupBy(F.spark_partition_id()).count().collect()]
        assert max(held) < 2 * 1000 and sum(held) == 2 * n + n // 10 + 1
        assert {r["set"]: r["n"] for r in groups.groupBy("set").agg(F.sum("n").alias("n")).collect()} == dict.fromkeys(range(3), n)
        assert {(tuple(r.left), r.right) for r in dependencies(rows.select("a", "b")).collect()} == {(("a",), "b")}
