"""Command line: ``python -m ledgerlake <command> ...`` (or ``spark-submit`` the module).

    load    validate, extract, clean and load report files into the warehouse
    ingest  process newly landed files once (AvailableNow stream) and print their status
    check   is there a newer report? (saved listing pages + manifest -> status, download URL)
    counts  row count of every warehouse table
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans import reports
from .plans.warehouse import Warehouse
from .session import configure
from .sources import archives, manifest, workbook
from .streaming.incremental import IncrementalIngest


def _session() -> SparkSession:
    return configure(SparkSession.builder.appName("ledgerlake").getOrCreate())


def _entries(spark: SparkSession, path: str):
    """Manifest entries from a JSON document (``*.json``) or an entry table."""
    if path.endswith(".json"):
        return manifest.read_manifest_json(spark, path)
    table = manifest.read_manifest_table(spark, path)
    if table is None:
        raise SystemExit(f"no manifest at {path}")
    return table


def cmd_load(args) -> int:
    spark = _session()
    wh = Warehouse(spark, args.warehouse)
    cgd = archives.report_files(spark, args.cgd) if args.cgd else None
    ocsc = archives.report_files(spark, args.ocsc) if args.ocsc else None
    written = reports.run_reports(wh, cgd, ocsc, _entries(spark, args.manifest),
                                  lambda files, sheet: workbook.cells_from_binary(files, sheets=[sheet]))
    for table, n in written.items():
        print(f"{table}: {n} new rows")
    return 0


def cmd_ingest(args) -> int:
    spark = _session()
    ing = IncrementalIngest(spark, args.landing, args.warehouse, args.manifest_table, args.status,
                            args.checkpoint, raw_path=args.raw)
    status = ing.run().select("path", "report_date", "status", "reason").collect()
    for r in status:
        print(f"{r.status:12s} {r.report_date} {r.path} {r.reason or ''}")
    return 1 if any(r.status == "failed" for r in status) else 0


def cmd_check(args) -> int:
    from pyspark.sql import functions as F

    from .streaming.check import check_listings, listing_config
    spark = _session()
    pages = (spark.read.text(args.pages, wholetext=True)
             .select(F.lit(args.source).alias("source"), F.col("value").alias("html")))
    cfg = listing_config(spark, {args.source: (args.prefix, args.base_url)})
    rows = check_listings(pages, _entries(spark, args.manifest), cfg).collect()
    for r in rows:
        print(f"{r.source}: {r.status} {r.report_date or ''} {r.download_url or r.reason or ''}")
    return 1 if any(r.status == "failed" for r in rows) else 0


def cmd_counts(args) -> int:
    spark = _session()
    for r in Warehouse(spark, args.warehouse).row_counts().collect():
        print(f"{r.table_name}: {r.n} rows")
    return 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="ledgerlake")
    sub = p.add_subparsers(dest="command", required=True)
    load = sub.add_parser("load", help="load report files into the warehouse")
    load.add_argument("--cgd", help="folder of disbursement workbooks")
    load.add_argument("--ocsc", help="folder of workforce workbooks")
    load.add_argument("--manifest", required=True, help="manifest JSON document or entry table")
    load.add_argument("--warehouse", required=True)
    load.set_defaults(fn=cmd_load)
    ing = sub.add_parser("ingest", help="process newly landed files once")
    ing.add_argument("--landing", required=True)
    ing.add_argument("--warehouse", required=True)
    ing.add_argument("--manifest-table", required=True)
    ing.add_argument("--status", required=True)
    ing.add_argument("--checkpoint", required=True, help="stream progress folder on shared storage")
    ing.add_argument("--raw", help="raw zone table for the unwrapped payloads")
    ing.set_defaults(fn=cmd_ingest)
    chk = sub.add_parser("check", help="is there a newer report on the saved listing pages?")
    chk.add_argument("--pages", required=True, help="saved listing page(s), one HTML document per file")
    chk.add_argument("--manifest", required=True)
    chk.add_argument("--source", default="CGD")
    chk.add_argument("--prefix", required=True, help="title prefix of report rows")
    chk.add_argument("--base-url", required=True, help="site root the download links are relative to")
    chk.set_defaults(fn=cmd_check)
    cnt = sub.add_parser("counts", help="row count of every warehouse table")
    cnt.add_argument("--warehouse", required=True)
    cnt.set_defaults(fn=cmd_counts)
    args = p.parse_args(argv)
    return args.fn(args)


if __name__ == "__main__":
    sys.exit(main())
