import datetime as dt

from ledgerlake.sources import manifest
from ledgerlake.streaming.check import check_listings, listing_config
from test_listing import PREFIX, _page, _row

BASE = "https://www.cgd.go.th"


def _entries(spark, dates):
    return manifest.entries_from_rows(spark, [
        {"source": "CGD", "source_url": "https://example.org", "local_path": f"raw/cgd/{d}.xlsx",
         "report_date": d, "sha256": f"h{i}"} for i, d in enumerate(dates)])


def _check(spark, html, dates, sources=("CGD",)):
    pages = spark.createDataFrame([(s, html) for s in sources], "source string, html string")
    cfg = listing_config(spark, {s: (PREFIX, BASE) for s in sources})
    return {r.source: r for r in check_listings(pages, _entries(spark, dates), cfg).collect()}


def test_new_report_with_url(spark):
    html = _page([_row("30/06/2569", 1), _row("03/07/2569", 1438191564296)])
    r = _check(spark, html, ["2026-06-30"])["CGD"]
    assert (r.status, r.report_date) == ("new", dt.date(2026, 7, 3))
    assert r.download_url == ("https://www.cgd.go.th/cs/Satellite?blobcol=urldata&blobkey=id&blobtable=MungoBlobs"
                              "&blobwhere=1438191564296&ssbinary=true")


def test_nothing_new_when_known_is_not_older(spark):
    html = _page([_row("03/07/2569", 1)])
    assert _check(spark, html, ["2026-07-10", "2026-06-01"])["CGD"].status == "nothing_new"
    assert _check(spark, html, ["2026-07-03"])["CGD"].status == "nothing_new"     # equal date is not newer


def test_failures(spark):
    assert _check(spark, "<html>challenge</html>", ["2026-06-30"])["CGD"].status == "failed"   # no rows
    assert _check(spark, _page([_row("03/07/2569", 1)]), [])["CGD"].reason == "no manifest entry to inherit"
    broken = _page([_row("03/07/2569", 1)]).replace("openDownload", "otherCall")
    r = _check(spark, broken, ["2026-06-30"])["CGD"]
    assert (r.status, r.reason) == ("failed", "no download URL in the report link")
