"""Hierarchies of any depth against a walk per node."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import hierarchy, keys


def brute(parent):
    out = {}
    for node, up in parent.items():
        path, at, seen = [], up, {node}
        while at is not None and at in parent and at not in seen:
            path.append(at)
            seen.add(at)
            at = parent[at]
        cyclic = at in seen
        out[node] = (None, "cycle") if cyclic else (path, "missing_parent" if up is not None and up not in parent else None)
    return out


def _forest(r, depth):
    parent, last = {}, [None]
    for level in range(depth + 1):
        here = [f"{level}-{i}" for i in range(r.randrange(1, 6))]
        for x in here:
            parent[x] = r.choice(last)
        last = here
    return parent


@pytest.mark.parametrize("depth", [0, 1, 2, 3, 7, 20])
def test_paths_levels_and_sums_equal_a_walk(spark, depth):
    r = random.Random(depth)
    parent = _forest(r, depth)
    if depth > 2:
        parent |= {"c1": "c2", "c2": "c3", "c3": "c1", "below": "c2", "far below": "below", "self": "self", "lost": "nobody", "lost child": "lost"}
    df = spark.createDataFrame([*parent.items(), (None, "0-0")], "n string, p string").withColumn("path", F.lit(1))
    found = hierarchy.ancestors(df, "n", "p")
    rows = {x.node: x for x in found.collect()}
    want = brute(parent)
    assert {k: (x.path, x.problem) for k, x in rows.items()} == want
    for k, (path, _) in want.items():
        assert rows[k].level == (None if path is None else len(path)) and rows[k].root == (None if path is None else (path or [k])[-1])
    assert {x.node for x in hierarchy.violations(found).collect()} == {k for k, (_, p) in want.items() if p}
    value = {k: r.randrange(100) for k in parent}
    tree = {k: path for k, (path, _) in want.items() if path is not None}
    leaves = set(tree) - {parent[k] for k in tree}
    sums = {x.node: (x.is_leaf, x.n_leaves, x.total) for x in hierarchy.leaf_sums(
        found, spark.createDataFrame(list(value.items()), "node string, v long"), "v").collect()}
    below = {k: [x for x in leaves if x == k or k in tree[x]] for k in tree}
    assert sums == {k: (k in leaves, len(below[k]), sum(value[x] for x in below[k])) for k in tree}


def test_repeated_and_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (2, 1), (3, 2)], "n int, p int")
    assert {(x.node, x.level) for x in hierarchy.ancestors(df, "n", "p").collect()} == {(1, 0), (2, 1), (3, 2)}
    none = hierarchy.ancestors(df.limit(0), "n", "p")
    assert none.count() == 0 and hierarchy.leaf_sums(none, df.limit(0), "p", "n").count() == 0


def test_few_parents_leave_the_dimension_unshuffled(spark, scratch, monkeypatch):
    spark.range(5000).select(F.col("id").cast("string").alias("name"), F.col("id").alias("key")).write.parquet(f"{scratch}/dim")
    dim = spark.read.parquet(f"{scratch}/dim")
    df = spark.createDataFrame([(i, str(i % 3) if i % 4 else None) for i in range(100)], "i int, up string")
    for few in (keys.FEW_NAMES, 0):
        monkeypatch.setattr(keys, "FEW_NAMES", few)
        out = keys.resolve_optional_key(df, dim, "up", "name", "key", "up_key")
        assert {(r.i, r.up_key) for r in out.collect()} == {(i, i % 3 if i % 4 else None) for i in range(100)}
        if few:  # the scan of the dimension reaches the semi join without an exchange
            plan = out._jdf.queryExecution().executedPlan().toString()
            side = plan[plan.index("LeftSemi"):]
            assert side.index("FileScan") < (side.index("Exchange hash") if "Exchange hash" in side else len(side))
    with pytest.raises(Exception, match="unresolved parent"):
        keys.resolve_optional_key(df.withColumn("up", F.lit("x")), dim, "up", "name", "key", "k").collect()
