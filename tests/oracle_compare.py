"""Compare a Spark query with its DuckDB oracle the way the driver does:
row count, column names + types, and an order-insensitive value hash over
columns sorted by name."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

from ledgerlake.sources.tables import TABLES

_SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
    "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
    "binary": "BLOB",
}


def spark_type(t: str) -> str:
    if t.startswith("decimal"):
        return t.upper().replace("DECIMAL", "DECIMAL")
    return _SPARK_TO_DUCK.get(t, t.upper())


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{v:f}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date, bool, int, str)):
        return str(v)
    return repr(v)


def value_hash(columns, rows) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_canon(r[i]) for i in order) for r in rows)
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode())
        h.update(b"\n")
    return h.hexdigest()


def compare(spark, con, name, spark_df, sql) -> dict:
    s_cols = spark_df.columns
    s_types = [spark_type(f.dataType.simpleString()) for f in spark_df.schema.fields]
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [c[0] for c in rel.description]
    d_rows = rel.fetchall()
    d_types = [r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()]
    out = {
        "name": name,
        "rows": (len(s_rows), len(d_rows)),
        "rows_match": len(s_rows) == len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "types_match": sorted(zip(s_cols, s_types)) == sorted(zip(d_cols, d_types)),
        "hash_match": value_hash(s_cols, s_rows) == value_hash(d_cols, d_rows),
        "spark_schema": list(zip(s_cols, s_types)),
        "oracle_schema": list(zip(d_cols, d_types)),
    }
    out["ok"] = out["rows_match"] and out["columns_match"] and out["types_match"] and out["hash_match"]
    return out
