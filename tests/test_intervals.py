"""The interval join against brute force, and its plan."""

import random

import pytest

from ledgerlake.operators import grid
from ledgerlake.operators.intervals import range_join

POINTS, RANGES = "k string, p long, id int", "k string, a long, b long, r int"


@pytest.mark.parametrize("by", [["k"], []])
def test_equals_brute_force(spark, by):
    r = random.Random(3)
    key = lambda: r.choice(["x", "x", "x", "y", None])
    points = [(key(), r.choice([r.randrange(-50, 200), r.randrange(-10**12, 10**12), None]), i) for i in range(150)]
    ranges = []
    for i in range(120):
        a = r.randrange(-60, 200)
        ranges.append((key(), a, a + r.choice([0, 0, 1, 2, 3, 7, 8, 9, 40, 10**12, -1, -5]), i))
    ranges += [("x", None, 5, 900), ("x", 5, None, 901), ("x", -2**62, 2**61, 902), ranges[0][:3] + (903,)]
    out = range_join(spark.createDataFrame(points, POINTS), spark.createDataFrame(ranges, RANGES).withColumnRenamed("k", "k" if by else "rk"),
                     "p", "a", "b", by)
    got = sorted((x.id, x.r) for x in out.collect())
    assert got == sorted((i, n) for k, p, i in points for rk, a, b, n in ranges
                         if None not in (p, a, b) and a <= p <= b and (not by or (k is not None and k == rk)))
    assert out.columns == ["k", "p", "id", "a", "b", "r"] if by else out.columns == ["k", "p", "id", "rk", "a", "b", "r"]


def test_no_ranges_no_points(spark):
    points, ranges = spark.createDataFrame([("x", 1, 1)], POINTS), spark.createDataFrame([("x", 3, 1, 1)], RANGES)
    for p, q in ((points, ranges), (points.limit(0), ranges), (points, ranges.limit(0))):
        out = range_join(p, q, "p", "a", "b", ["k"])
        assert out.count() == 0 and out.columns == ["k", "p", "id", "a", "b", "r"]


def test_a_million_ranges_without_a_nested_loop(spark):
    ranges = spark.range(1_000_000).selectExpr("cast(id % 1000 AS string) AS k", "id div 1000 * 10 AS a", "id div 1000 * 10 + 6 AS b", "cast(id AS int) AS r")
    points = spark.range(20_000).selectExpr("cast(id % 1000 AS string) AS k", "id div 1000 * 7 AS p", "cast(id AS int) AS id")
    out = range_join(points, ranges, "p", "a", "b", ["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert out.count() == sum(1000 for n in range(20) if n * 7 % 10 <= 6)


def test_layouts_per_report(spark):
    rows = spark.createDataFrame([(p, i, f"{p}{i}") for p in "ab" for i in range(6)], "path string, row_idx int, name string")
    layout = spark.createDataFrame([("a", 0, 0, 0, None), ("a", 2, 1, 4, 0), ("b", 2, 3, 3, 2)],
                                   "path string, hierarchy_level int, row_start int, row_end int, parent_row int")
    out = {(r.path, r.row_idx): (r.hierarchy_level, r.parent_category, r.is_leaf) for r in grid.tag_sections(rows, layout, "path", "name").collect()}
    assert out == {("a", 0): (0, None, False), **{("a", i): (2, "a0", True) for i in range(1, 5)}, ("b", 3): (2, "b2", True)}
    cells = grid.table_cells(rows, "path", "row_idx", ["name", "row_idx"])
    own = spark.createDataFrame([("a", 0, "x"), ("b", 1, "x")], "path string, col_idx int, field string")
    got = {(r.path, r.row_idx): r.x for r in grid.records_from_cells(cells, own, ["x"], "path").collect()}
    assert got["a", 2] == "a2" and got["b", 2] == "2" and len(got) == 12
