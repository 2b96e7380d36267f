"""Constraints as violation queries (rows out = violations) plus enforcement.

Parquet tables accept no PRIMARY KEY / CHECK / FOREIGN KEY, so every
constraint of the star schema becomes a query; ``enforce`` runs them as one
action before anything is written and raises when any returns a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import lookup_join


class StructureValidationError(Exception):
    """A report's layout differs from its configuration; nothing was written."""


class ConstraintViolation(Exception):
    """A warehouse constraint would be broken by the pending write."""


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def violations_unique(df: DataFrame, keys) -> DataFrame:
    """Key values that occur more than once, with their count ``n``."""
    keys = _list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def violations_not_null(df: DataFrame, cols: Sequence[str], key) -> DataFrame:
    """Rows with a NULL in any of ``cols``; ``null_column`` names the first one."""
    first_null = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return df.select(*_list(key), first_null.alias("null_column")).filter(F.col("null_column").isNotNull())


def violations_fk(child: DataFrame, parent: DataFrame, child_cols, parent_cols=None,
                  check_name: str | None = None, key=None) -> DataFrame:
    """Child rows whose non-NULL reference has no parent row (NULL references pass).

    The distinct references are checked first (partial aggregation collapses a
    hot reference before any shuffle), then the child rows holding a missing
    reference are picked out with a lookup join on that (usually tiny) set.
    """
    child_cols = _list(child_cols)
    parent_cols = _list(parent_cols) if parent_cols is not None else child_cols
    p = parent.select(*[F.col(pc).alias(cc) for pc, cc in zip(parent_cols, child_cols)])
    present = F.lit(True)
    for c in child_cols:
        present = present & F.col(c).isNotNull()
    referencing = child.filter(present)
    missing = referencing.select(*child_cols).distinct().join(p, child_cols, "left_anti")
    out = lookup_join(referencing, missing, child_cols, "left_semi")
    if key is not None:
        out = out.select(*[F.col(k) for k in _list(key)])
    if check_name is not None:
        out = out.withColumn("check_name", F.lit(check_name))
    return out


def violations_fks(child: DataFrame, references: Sequence[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """``check_name, child_key`` of the rows that break any of a table's references, checked together.

    ``references``: (name, column, parent, parent's column), keys of one type family (cast to
    BIGINT). The child is read once for its distinct references, all of them in one
    exchange, and once more only for the rows that hold a missing one.
    """
    held = child.select(F.inline(F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(c).cast("long").alias("child_key"))
                                           for name, c, _, _ in references]))).filter(F.col("child_key").isNotNull())
    known = None
    for name, _, parent, c in references:
        keys = parent.select(F.lit(name).alias("check_name"), F.col(c).cast("long").alias("child_key"))
        known = keys if known is None else known.unionByName(keys)
    missing = held.distinct().join(known, ["check_name", "child_key"], "left_anti")
    return lookup_join(held, missing, ["check_name", "child_key"], "left_semi")


def violations_check(df: DataFrame, condition: Column, key, check_name: str) -> DataFrame:
    """Rows where ``condition`` is FALSE (NULL passes, like SQL CHECK)."""
    return df.filter(~condition).select(*[F.col(k) for k in _list(key)], F.lit(check_name).alias("check_name"))


def violations_pattern(df: DataFrame, column: str, pattern: str, key) -> DataFrame:
    """Rows whose text does not match ``pattern`` (e.g. a total row in a code column)."""
    return df.filter(~F.col(column).rlike(pattern)).select(*_list(key), column)


def enforce(*violations: DataFrame, error: type[Exception] = ConstraintViolation,
            names: Sequence[str] | None = None) -> None:
    """Raise ``error`` if any violation query returns a row.

    All checks run as one job: each violation is labelled and rendered to
    JSON, the results are unioned and reduced to a count plus two examples
    (a bounded aggregate - no violation list is ever gathered in one place).
    """
    if not violations:
        return
    labelled = None
    for i, v in enumerate(violations):
        label = names[i] if names else f"check {i}"
        row = v.select(F.concat(F.lit(f"{label}: "), F.to_json(F.struct(*v.columns))).alias("v"))
        labelled = row if labelled is None else labelled.unionByName(row)
    r = labelled.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).first()
    if r.n:
        examples = r.a if r.a == r.b else f"{r.a}; {r.b}"
        raise error(f"{r.n} violation(s), e.g. {examples}")
