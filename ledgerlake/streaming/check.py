"""Is there a newer report? Listing pages + manifest -> one status row per source.

Checks run in this order, per source: a manifest entry to inherit from
(else ``failed``), report rows on the listing (else ``failed``), a report
strictly newer than the newest known date (else ``nothing_new``), a download
URL inside its link (else ``failed``), otherwise ``new`` with the URL to fetch.
All sources are checked in one plan; the per-source configuration is a small
broadcast table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import web
from ..sources import listing, manifest
from . import status as st


def listing_config(spark: SparkSession, sources: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``{source: (title prefix, site base URL)}`` -> config rows."""
    return spark.createDataFrame([(s, p, b) for s, (p, b) in sources.items()],
                                 "source string, title_prefix string, base_url string")


def check_listings(pages: DataFrame, entries: DataFrame, config: DataFrame,
                   call_fn: str = "openDownload", call_arg: int = 3) -> DataFrame:
    """``pages(source, html)`` -> ``source, status, reason, title, report_date, download_url``."""
    cfg = F.broadcast(config)                      # one row per configured source
    rows = listing.parse_listing_rows(pages.select(F.col("source").alias("page_id"), "html"))
    rows = (rows.withColumnRenamed("page_id", "source").join(cfg, "source")
            .filter(F.col("title").startswith(F.col("title_prefix"))))
    latest = listing.latest_listing_row(rows, "source").select(
        "source", "title", "report_date", "download_href", "base_url")
    known = manifest.known_dates(entries)
    templates = manifest.latest_per_source(entries).select("source", F.lit(True).alias("has_template"))
    target = web.call_arg(F.col("download_href"), call_fn, call_arg)
    j = (cfg.select("source").join(templates, "source", "left").join(latest, "source", "left")
         .join(known, "source", "left")
         .withColumn("download_url", F.when(target.isNotNull(), web.resolve_url(F.col("base_url"), target))))

    found = st.outcome(
        F.col("report_date"), F.col("hwm"),
        [(F.col("has_template").isNull(), "no manifest entry to inherit"),
         (F.col("report_date").isNull(), "no report rows on the listing")],
        late="latest listed report is already known",
        last=[(F.col("download_url").isNull(), "no download URL in the report link")])
    return j.withColumn("_s", found).select(
        "source", F.col("_s.status").alias("status"), F.col("_s.reason").alias("reason"), "title", "report_date",
        "download_url")
