"""Run every registered query against its DuckDB oracle and print a summary.

    python tests/run_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import sys
import time
import traceback

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from oracle_compare import compare, duck_connection  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from ledgerlake.session import build_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck_connection(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            if name not in sqls:
                n = fn(spark, sf_dir).count()
                print(f"{name:24s} rows-only n={n} {time.time()-t0:.1f}s")
                continue
            r = compare(spark, con, name, fn(spark, sf_dir), sqls[name])
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:24s} ERROR {type(e).__name__}: {str(e)[:300]}")
            traceback.print_exc(limit=2)
            continue
        flag = "OK " if r["ok"] else "BAD"
        bad += not r["ok"]
        print(f"{name:24s} {flag} rows={r['rows']} cols={r['columns_match']} types={r['types_match']} "
              f"hash={r['hash_match']} {time.time()-t0:.1f}s")
        if not r["types_match"] or not r["columns_match"]:
            print("   spark :", json.dumps(r["spark_schema"]))
            print("   oracle:", json.dumps(r["oracle_schema"]))
    print(f"{bad} failing of {len(qs)} queries; {len(sqls)} with oracles")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
