"""Functional dependencies among all columns of a table, found level by level.

A set of columns splits the rows into classes of equal values; adding a column
refines the classes or leaves them as they are. ``X -> A`` holds exactly if X and
X with A have as many classes. The lattice of column sets is climbed by size: all
sets of a level are counted in one job, and a set is dropped as soon as nothing new
can follow from it: if it holds a key, or a column that the rest of it determines.
A job has one row per row and set (a cell). Slices of the rows are aggregated by the
values first, then all slices by set and values; the number of tasks of both steps
grows with the cells, so that a task holds about ``CELLS`` of them, however many rows
there are. Equal values of a slice are one row, so no common value gathers in a task.
Classes of one row are stripped from what is counted; their number follows from
the others'.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

Set = frozenset[str]
CELLS = 250_000  # rows times column sets that a task aggregates


def _groups(rows: DataFrame, n: int, sets: Sequence[Set]) -> DataFrame:
    """set (its number), values, n of the ``n`` rows, in tasks of about CELLS cells."""
    tasks = -(-n * len(sets) // CELLS) or 1
    values = F.array(*[F.struct(F.lit(i).alias("set"), F.to_json(F.struct(*[F.col(c) for c in sorted(s)]), {"ignoreNullFields": "false"}).alias("values"))
                       for i, s in enumerate(sets)])
    # Rows of a partition are numbered from 0 on: slices of equal size.
    sliced = rows.select(F.pmod(F.monotonically_increasing_id(), F.lit(tasks)).alias("_slice"), F.struct(*rows.columns).alias("_row"))
    cells = sliced.repartition(tasks, "_slice").select("_slice", "_row.*").select("_slice", F.inline(values))
    parts = cells.groupBy("_slice", "set", "values").agg(F.count(F.lit(1)).alias("n"))
    return parts.repartition(tasks, "set", "values").groupBy("set", "values").agg(F.sum("n").alias("n"))


def _classes(rows: DataFrame, n: int, sets: Iterable[Set]) -> dict[Set, tuple[int, int]]:
    """Of each set: how many classes of two rows and more it has, and how many of the ``n`` rows are in them."""
    sets = sorted(sets, key=sorted)
    groups = _groups(rows, n, sets).filter("n > 1")
    found = {r["set"]: (r["k"], r["rows"]) for r in groups.groupBy("set").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("rows")).collect()}
    return {s: found.get(i, (0, 0)) for i, s in enumerate(sets)}


def dependencies(df: DataFrame, columns: Sequence[str] | None = None, max_left: int = 4) -> DataFrame:
    """``left`` (array of columns, sorted), ``right``: every minimal dependency with up to ``max_left`` columns on the left.

    NULLs equal one another, as in GROUP BY. Trivial dependencies are left out; a
    constant column depends on the empty set; a key determines every other column.
    An empty table has every column constant. The number of column sets per level
    is at most that of all combinations: meant for tables of some ten columns.
    """
    spark, columns = df.sparkSession, list(columns or df.columns)
    checkpoint_dir(spark)
    rows = df.select(*columns).checkpoint(eager=True)
    n = rows.count()
    # A set's (classes of two and more, rows in them) gives its class count: classes + the rows alone in theirs.
    count = lambda c: c[0] + (n - c[1])
    classes: dict[Set, int] = {frozenset(): min(n, 1)}
    holds: list[tuple[Set, str]] = []
    implied = lambda left, right: any(r == right and x <= left for x, r in holds)
    level: list[Set] = [frozenset()]
    for _ in range(max_left + 1):
        # Sets of the next size: each column added to a set of which no part determines another and which is no key.
        open_ = [x for x in level if classes[x] < n and not any(implied(x - {a}, a) for a in x)]
        wanted = {x | {a} for x in open_ for a in columns if a not in x and not implied(x, a)}
        if not wanted:
            break
        classes |= {s: count(c) for s, c in _classes(rows, n, wanted).items()}
        for s in sorted(wanted, key=sorted):
            for a in sorted(s):
                left = s - {a}
                if left in classes and classes[left] == classes[s] and not implied(left, a):
                    holds.append((left, a))
        level = list(wanted)
    # Keys determine what no smaller set does.
    keys = [x for x in classes if classes[x] == n and len(x) <= max_left]
    for key in sorted(keys, key=lambda x: (len(x), sorted(x))):
        holds += [(key, a) for a in columns if a not in key and not implied(key, a)]
    found = [(sorted(x), a) for x, a in holds if not any(r == a and y < x for y, r in holds)]
    return spark.createDataFrame(found, "left array<string>, right string")
