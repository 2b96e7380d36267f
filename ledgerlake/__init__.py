"""Report-to-warehouse analytics on Spark: cell tables, layouts, reshaping,
idempotent star-schema loading, data-quality checks and incremental ingest,
all as DataFrame transformations."""

__version__ = "0.1.0"
