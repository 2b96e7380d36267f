"""Listing pages -> report rows (title, date, download link), with built-in regex.

Pages are raw HTML (not well-formed XML). Each table row (``<tr``) holding a
``news-title`` heading with a link and at least three cells becomes one
candidate; the third cell holds the era date. Rows whose date does not parse
are skipped, not errors. Everything runs JVM-side per page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import scalars as sc
from ..functions import web
from ..operators import dedup

_ROW_SPLIT = r"(?i)<tr(?=[\s>])"
_HEADING = r'(?is)<h2\b[^>]*class="[^"]*\bnews-title\b[^"]*"[^>]*>(.*?)</h2>'
_LINK_TEXT = r"(?is)<a\b[^>]*>(.*?)</a>"
_LINK_HREF = r'(?is)<a\b[^>]*?\bhref="([^"]*)"'
_CELL = r"(?is)<td\b[^>]*>(.*?)</td>"


def _text(c):
    """Visible text of an HTML fragment: tags removed, entities decoded, stripped."""
    return sc.strip(web.decode_entities(web.strip_tags(c)))


def parse_listing_rows(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                       title_prefix: str | None = None, date_cell: int = 3, min_cells: int = 3) -> DataFrame:
    """``(page id, row_no, title, download_href, date_text, report_date)`` per report row."""
    chunks = (pages.select(id_col, F.posexplode(F.split(F.col(html_col), _ROW_SPLIT)).alias("row_no", "chunk"))
              .filter(F.col("row_no") > 0))  # text before the first <tr> is in no row
    heads = chunks.select(id_col, "row_no", "chunk",
                          F.explode(F.regexp_extract_all("chunk", F.lit(_HEADING), 1)).alias("heading"))
    heads = heads.filter(F.col("heading").rlike(r"(?is)<a\b"))
    cells = F.regexp_extract_all("chunk", F.lit(_CELL), 1)
    rows = heads.select(
        id_col, "row_no",
        _text(F.regexp_extract("heading", _LINK_TEXT, 1)).alias("title"),
        web.decode_entities(F.regexp_extract("heading", _LINK_HREF, 1)).alias("download_href"),
        F.size(cells).alias("_n_cells"),
        _text(F.try_element_at(cells, F.lit(date_cell))).alias("date_text"))
    rows = rows.filter(F.col("_n_cells") >= min_cells).drop("_n_cells")
    if title_prefix:
        rows = rows.filter(F.col("title").startswith(title_prefix))
    rows = rows.withColumn("report_date", cal.parse_era_date("date_text"))
    return rows.filter(F.col("report_date").isNotNull())


def latest_listing_row(rows: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Newest report of every page; equal dates keep the first in page order."""
    return dedup.latest_per_key(rows, id_col, "report_date", tie="row_no")


def download_url(href, base_url: str, fn: str = "openDownload", arg: int = 3):
    """Absolute URL of the download target named inside a JavaScript link
    (NULL when the link has another shape)."""
    target = web.call_arg(href, fn, arg)
    return F.when(target.isNotNull(), web.resolve_url(F.lit(base_url), target))
