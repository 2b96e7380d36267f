"""Scans: parquet tables, workbook cells, archives, listing pages, manifests."""
