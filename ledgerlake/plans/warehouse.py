"""The star schema as Parquet tables under one root folder.

Parquet has no PRIMARY KEY / UNIQUE / CHECK / FOREIGN KEY and no sequences;
keys come from ``operators.keys.assign_keys`` and constraints from
``operators.quality`` (see ``append``, ``violations``). Facts are partitioned by
``date_key`` so an idempotent reload only touches the partitions of the
dates it loads.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import joins, quality
from ..session import path_exists, remove_path

L, I, S, D, B, TS, DT, BY = (T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(),
                             T.BooleanType(), T.TimestampType(), T.DateType(), T.ByteType())


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


SCHEMAS: dict[str, T.StructType] = {
    "dim_date": _schema(("date_key", L, False), ("date_natural_key", S, False), ("report_date", DT, True),
                        ("fiscal_year_be", I, False), ("fiscal_year_ce", I, False), ("month", I, True),
                        ("quarter", I, True), ("is_month_end", B, True)),
    "dim_ministry": _schema(("ministry_key", L, False), ("ministry_code", S, False),
                            ("ministry_name_th", S, False), ("source_name_raw", S, True)),
    "dim_expense_type": _schema(("expense_type_key", L, False), ("expense_type_name", S, False),
                                ("is_leaf", B, False)),
    "dim_personnel_category": _schema(("personnel_category_key", L, False), ("category_name", S, False)),
    "dim_source": _schema(("source_id", L, False), ("agency", S, False), ("source_url", S, True),
                          ("file_name", S, False), ("file_hash", S, False), ("ingested_at", TS, False)),
    "fact_disbursement": _schema(("ministry_key", L, False), ("expense_type_key", L, False),
                                 ("source_id", L, False), ("budget_after_transfer", D, False),
                                 ("allocated", D, False), ("spending_plan", D, False), ("po_reserved", D, False),
                                 ("disbursed", D, False), ("remaining", D, False), ("disbursed_pct", D, True),
                                 ("date_key", L, False)),
    "fact_workforce_summary": _schema(("personnel_category_key", L, False), ("source_id", L, False),
                                      ("headcount", L, False), ("share_pct", D, True),
                                      ("hierarchy_level", BY, False), ("parent_category_key", L, True),
                                      ("is_leaf", B, False), ("date_key", L, False)),
}

NATURAL_KEYS = {
    "dim_date": ["date_natural_key"],
    "dim_ministry": ["ministry_code"],
    "dim_expense_type": ["expense_type_name"],
    "dim_personnel_category": ["category_name"],
    "dim_source": ["file_hash"],
    "fact_disbursement": ["date_key", "ministry_key", "expense_type_key"],
    "fact_workforce_summary": ["date_key", "personnel_category_key"],
}
SURROGATE_KEYS = {
    "dim_date": "date_key", "dim_ministry": "ministry_key", "dim_expense_type": "expense_type_key",
    "dim_personnel_category": "personnel_category_key", "dim_source": "source_id",
}
FOREIGN_KEYS = {
    "fact_disbursement": {"date_key": ("dim_date", "date_key"), "ministry_key": ("dim_ministry", "ministry_key"),
                          "expense_type_key": ("dim_expense_type", "expense_type_key"),
                          "source_id": ("dim_source", "source_id")},
    "fact_workforce_summary": {"date_key": ("dim_date", "date_key"),
                               "personnel_category_key": ("dim_personnel_category", "personnel_category_key"),
                               "parent_category_key": ("dim_personnel_category", "personnel_category_key"),
                               "source_id": ("dim_source", "source_id")},
}
#: Conditions (SQL) every row must satisfy, checked while rows are staged.
ROW_RULES = {
    "dim_date": {"check_era": "fiscal_year_ce = fiscal_year_be - 543"},
    "fact_disbursement": {"disbursed_le_budget": "disbursed <= budget_after_transfer"},
    "fact_workforce_summary": {
        "headcount_nonneg": "headcount >= 0",
        "parent_only_for_total": "(hierarchy_level = 0) = (parent_category_key IS NULL)"},
}
#: Measures whose parts must add up to the stated total, and by which share of it they may differ (they are binary floats).
TOTALS = {"fact_disbursement": ["budget_after_transfer", "allocated", "spending_plan", "po_reserved", "disbursed"],
          "fact_workforce_summary": ["headcount"]}
TOLERANCE = 1e-9
PARTITION_BY = {"fact_disbursement": ["date_key"], "fact_workforce_summary": ["date_key"]}
TABLE_ORDER = ("dim_date", "dim_ministry", "dim_expense_type", "dim_personnel_category", "dim_source",
               "fact_disbursement", "fact_workforce_summary")


class Warehouse:
    """Parquet tables at ``root/<table>``; reads always list files afresh."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _scan(self, name: str) -> DataFrame | None:
        if not path_exists(self.spark, self.path(name)):
            return None
        df = self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))
        return df.select(*SCHEMAS[name].names)

    def ensure_schema(self) -> None:
        """Create every absent table empty (create-if-absent, like ``IF NOT EXISTS``)."""
        for name in TABLE_ORDER:
            if self._scan(name) is None:
                w = self.spark.createDataFrame([], SCHEMAS[name]).write.mode("errorifexists")
                if name in PARTITION_BY:
                    w = w.partitionBy(*PARTITION_BY[name])
                w.parquet(self.path(name))

    def read(self, name: str) -> DataFrame:
        df = self._scan(name)
        return df if df is not None else self.spark.createDataFrame([], SCHEMAS[name])

    def _flagged(self, name: str, df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
        """``df`` with the columns its row rules need, and the rules: label -> whether a row violates it."""
        rules: dict[str, Column] = {f"{name}.not_null": F.lit(False)}
        for field in SCHEMAS[name].fields:
            if not field.nullable:
                rules[f"{name}.not_null"] |= F.col(field.name).isNull()
        for label, holds in ROW_RULES.get(name, {}).items():
            rules[f"{name}.{label}"] = ~F.expr(holds)                          # NULL passes, as in SQL
        for i, cols in enumerate(self._uniques(name)):
            df = df.withColumn(f"_n{i}", F.count(F.lit(1)).over(Window.partitionBy(*cols)))
            rules[f"{name}.unique({','.join(cols)})"] = F.col(f"_n{i}") > 1
        for i, (c, (dim, dim_col)) in enumerate(FOREIGN_KEYS.get(name, {}).items()):
            parent = self.read(dim).groupBy(F.col(dim_col).alias(c)).agg(F.lit(True).alias(f"_p{i}"))
            df = joins.lookup_join(df, parent, c, "left")
            rules[f"{name}.fk({c})"] = F.col(c).isNotNull() & F.col(f"_p{i}").isNull()
        return df, rules

    @staticmethod
    def _uniques(name: str) -> list[list[str]]:
        return [NATURAL_KEYS[name]] + ([[SURROGATE_KEYS[name]]] if name in SURROGATE_KEYS else [])

    def _group_checks(self, name: str, staged: DataFrame) -> list[tuple[str, DataFrame]]:
        """What the staged rows violate together with stored ones: keys held already, and parts that don't
        add up to the stated total. Of a fact only the partitions of the staged dates are read."""
        stored, checks = self.read(name), []
        if name in PARTITION_BY:
            stored = joins.lookup_join(stored, staged.select(*PARTITION_BY[name]).distinct(), PARTITION_BY[name], "left_semi")
        for cols in self._uniques(name):
            checks.append((f"{name}.unique({','.join(cols)}) against stored rows", staged.select(*cols).join(stored.select(*cols), cols, "left_semi")))
        if name in TOTALS:
            checks.append((f"{name}.parts_equal_total", self.unreconciled(name, staged.unionByName(stored))))
        return checks

    def unreconciled(self, name: str, facts: DataFrame) -> DataFrame:
        """Groups whose parts don't add up to the total they state (groups without a total, or without parts, pass)."""
        if name == "fact_disbursement":
            leaf = self.read("dim_expense_type").select("expense_type_key", "is_leaf")
            rows = joins.lookup_join(facts, leaf, "expense_type_key")
            keys = ["date_key", "ministry_key"]
            parts = rows.groupBy(*keys).agg(*[F.sum(F.when(F.col("is_leaf") == own, F.col(m))).alias(f"{m}_{own}".lower())
                                              for m in TOTALS[name] for own in (True, False)])
            sums = [(m, F.col(f"{m}_true"), F.col(f"{m}_false")) for m in TOTALS[name]]
        else:
            keys = ["date_key", "personnel_category_key"]
            parts = facts.filter(F.col("parent_category_key").isNotNull()).groupBy(
                "date_key", F.col("parent_category_key").alias("personnel_category_key")).agg(F.sum("headcount").alias("_parts"))
            parts = facts.select(*keys, "headcount").join(parts, keys)
            sums = [("headcount", F.col("_parts"), F.col("headcount"))]
        wrong = [F.when(F.abs(own - total) > TOLERANCE * F.greatest(F.abs(total), F.lit(1)), F.lit(m)) for m, own, total in sums]
        return parts.select(*keys, F.coalesce(*wrong).alias("measure")).filter(F.col("measure").isNotNull())

    def append(self, name: str, df: DataFrame) -> int:
        """Append rows unless one violates a rule: then it raises and nothing is written. Returns the rows written.

        The rows are computed once: they are staged, and while they are written an
        observation counts every row rule's violations (NOT NULL, CHECK, unique in the
        batch, foreign keys). Rules over groups and stored rows read the staged rows.
        Only then the staged rows join the table, in one commit.
        """
        flagged, rules = self._flagged(name, df.select(*SCHEMAS[name].names))
        example = F.to_json(F.struct(*[F.col(c) for c in NATURAL_KEYS[name]]))
        metrics = [F.count(F.lit(1)).alias("rows")]
        for i, broken in enumerate(rules.values()):
            metrics += [F.count(F.when(broken, F.lit(1))).alias(f"n{i}"), F.min(F.when(broken, example)).alias(f"e{i}")]
        staging = f"{self.root}/_staging/{name}-{uuid.uuid4().hex}"
        seen = Observation()
        try:
            flagged.observe(seen, *metrics).select(*SCHEMAS[name].names).write.parquet(staging)
            found = seen.get
            broken = {label: (found[f"n{i}"], found[f"e{i}"]) for i, label in enumerate(rules) if found.get(f"n{i}")}
            if broken:
                raise quality.ConstraintViolation("; ".join(f"{n} violation(s) of {label}, e.g. {e}" for label, (n, e) in broken.items()))
            staged = self.spark.read.schema(SCHEMAS[name]).parquet(staging)
            checks = self._group_checks(name, staged)
            quality.enforce(*[c for _, c in checks], names=[n for n, _ in checks])
            if found.get("rows"):
                w = staged.write.mode("append")
                if name in PARTITION_BY:
                    w = w.partitionBy(*PARTITION_BY[name])
                w.parquet(self.path(name))
            return found.get("rows", 0)
        finally:
            remove_path(self.spark, staging)

    def row_counts(self) -> DataFrame:
        out = None
        for name in TABLE_ORDER:
            c = self.read(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
            out = c if out is None else out.unionByName(c)
        return out

    def violations(self) -> dict[str, DataFrame]:
        """Every schema constraint as a violation query (empty = satisfied)."""
        r = self.read
        out: dict[str, DataFrame] = {}
        for name, nk in NATURAL_KEYS.items():
            out[f"{name}.unique"] = quality.violations_unique(r(name), nk)
        for name, key in SURROGATE_KEYS.items():
            out[f"{name}.pk"] = quality.violations_unique(r(name), key)
        for name in TABLE_ORDER:
            required = [f.name for f in SCHEMAS[name].fields if not f.nullable]
            out[f"{name}.not_null"] = quality.violations_not_null(r(name), required, required[:1])
        fd, fw = r("fact_disbursement"), r("fact_workforce_summary")
        for fact, fname in ((fd, "fact_disbursement"), (fw, "fact_workforce_summary")):
            out[f"{fname}.fk_date"] = quality.violations_fk(fact, r("dim_date"), "date_key")
            out[f"{fname}.fk_source"] = quality.violations_fk(fact, r("dim_source"), "source_id")
        out["fact_disbursement.fk_ministry"] = quality.violations_fk(fd, r("dim_ministry"), "ministry_key")
        out["fact_disbursement.fk_expense_type"] = quality.violations_fk(fd, r("dim_expense_type"), "expense_type_key")
        pc = r("dim_personnel_category")
        out["fact_workforce_summary.fk_category"] = quality.violations_fk(fw, pc, "personnel_category_key")
        out["fact_workforce_summary.fk_parent"] = quality.violations_fk(
            fw, pc, "parent_category_key", "personnel_category_key")
        for name, row_rules in ROW_RULES.items():
            for label, holds in row_rules.items():
                out[f"{name}.{label}"] = quality.violations_check(r(name), F.expr(holds), NATURAL_KEYS[name], label)
        for name in TOTALS:
            out[f"{name}.parts_equal_total"] = self.unreconciled(name, r(name))
        return out
