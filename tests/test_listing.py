import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.sources import listing

PREFIX = "ผลการเบิกจ่ายเงิน"
BASE = "https://www.cgd.go.th"


def _row(date_text, blob, title=None):
    title = title or f"{PREFIX} ณ วันที่ {date_text}"
    js = (f"javascript:openDownload('NewsStat_C','14286356{blob}','/cs/Satellite?blobcol=urldata&amp;blobkey=id"
          f"&amp;blobtable=MungoBlobs&amp;blobwhere={blob}&amp;ssbinary=true');")
    return (f'<tr>\n<td>\n<img src="/img.gif"/>\n</td>\n<td>\n<h2 class="news-title">\n<a href="{js}">{title}</a>\n'
            f'</h2>\n</td>\n<td style="text-align:center">{date_text}</td>\n<td>367</td>\n<td><a href="{js}">'
            f'<img src="/zip.png"/></a></td>\n</tr>\n')


def _page(rows):
    return '<table class="table-list">\n<tr><th>h</th></tr>\n' + "".join(rows) + "</table>"


def test_latest_row_is_max_date_not_first(spark):
    html = _page([_row("30/06/2569", 1), _row("03/07/2569", 1438191564296), _row("26/06/2569", 3),
                  _row("xx/yy/zzzz", 4), _row("01/08/2569", 5, title="ประกาศอื่น")])
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    rows = listing.parse_listing_rows(pages, title_prefix=PREFIX)
    assert rows.count() == 3                                   # bad date and other titles skipped
    latest = listing.latest_listing_row(rows).first()
    assert latest.report_date == dt.date(2026, 7, 3)
    url = rows.filter(F.col("report_date") == dt.date(2026, 7, 3)).select(
        listing.download_url(F.col("download_href"), BASE).alias("u")).first().u
    assert url == ("https://www.cgd.go.th/cs/Satellite?blobcol=urldata&blobkey=id&blobtable=MungoBlobs"
                   "&blobwhere=1438191564296&ssbinary=true")


def test_order_independent_and_empty(spark):
    a = _page([_row("03/07/2569", 1), _row("30/06/2569", 2)])
    b = _page([_row("30/06/2569", 2), _row("03/07/2569", 1)])
    pages = spark.createDataFrame([(1, a), (2, b), (3, "<html><body>empty</body></html>")],
                                  "page_id long, html string")
    latest = {r.page_id: r.report_date for r in listing.latest_listing_row(
        listing.parse_listing_rows(pages, title_prefix=PREFIX)).collect()}
    assert latest == {1: dt.date(2026, 7, 3), 2: dt.date(2026, 7, 3)}   # page 3: no rows


def test_short_rows_skipped(spark):
    short = ('<table><tr><td><h2 class="news-title"><a href="javascript:x()">' + PREFIX +
             ' x</a></h2></td><td>10/08/2569</td></tr></table>')
    ok = ('<table><tr><td>i</td><td><h2 class="news-title"><a href="javascript:x()">' + PREFIX +
          ' y</a></h2></td><td>10/08/2569</td></tr></table>')
    pages = spark.createDataFrame([(1, short), (2, ok)], "page_id long, html string")
    got = listing.parse_listing_rows(pages, title_prefix=PREFIX).collect()
    assert [(r.page_id, r.report_date) for r in got] == [(2, dt.date(2026, 8, 10))]
