import datetime as dt

import pytest
from pyspark.errors import ArithmeticException, NumberFormatException, SparkRuntimeException
from pyspark.sql import functions as F

from ledgerlake.functions import calendar as cal
from ledgerlake.functions import scalars as sc
from ledgerlake.functions import web


def _one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("o")).first().o


def test_strip_matches_python(spark):
    samples = [" a ", "\tb\n", "\x1cc\x1f", "　d ", "e", "", "  ", " f g "]
    df = spark.createDataFrame([(s,) for s in samples], "v string")
    got = [r.o for r in df.select(sc.strip("v").alias("o")).collect()]
    assert got == [s.strip() for s in samples]
    assert _one(spark, sc.blank_to_null, " \t ") is None


def test_safe_pct_null_on_zero(spark):
    df = spark.createDataFrame([(50.0, 100.0), (1.0, 0.0), (1.0, None)], "n double, d double")
    assert [r.p for r in df.select(sc.safe_pct("n", "d").alias("p")).collect()] == [50.0, None, None]


def test_strict_and_lenient_casts(spark):
    assert _one(spark, lambda c: sc.lenient_number(c), "  ") is None
    assert _one(spark, lambda c: sc.lenient_number(c), " 12.5 ") == 12.5
    with pytest.raises((NumberFormatException, SparkRuntimeException, ArithmeticException)):
        _one(spark, lambda c: sc.strict_number(c, "int"), "12.0")
    with pytest.raises((NumberFormatException, SparkRuntimeException)):
        _one(spark, lambda c: sc.strict_number(c, "double"), "")


def test_to_bool(spark):
    vals = [" True ", "false", "yes", "TRUE", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert [r.o for r in df.select(sc.to_bool("v").alias("o")).collect()] == [True, False, False, True, False]


def test_era_dates(spark):
    assert _one(spark, cal.parse_era_date, "03/07/2569") == dt.date(2026, 7, 3)
    assert _one(spark, cal.parse_era_date, "29/02/2567") == dt.date(2024, 2, 29)   # leap day survives
    assert _one(spark, cal.parse_era_date, "31/02/2567") is None
    assert _one(spark, cal.parse_era_date, "not a date") is None
    assert _one(spark, cal.format_era_date, dt.date(2026, 7, 3), "v date") == "03/07/2569"


def test_fiscal_calendar(spark):
    rows = [(dt.date(2025, 9, 30),), (dt.date(2025, 10, 1),), (dt.date(2026, 1, 31),), (dt.date(2026, 7, 3),)]
    df = spark.createDataFrame(rows, "d date").select(
        cal.fiscal_year_be("d").alias("be"), cal.fiscal_year_ce("d").alias("ce"),
        cal.fiscal_quarter(F.month("d")).alias("q"), cal.is_month_end("d").alias("me"),
        cal.report_file_name("d").alias("f"), cal.date_natural_key("d").alias("k"))
    got = [tuple(r) for r in df.collect()]
    assert got[0][:4] == (2568, 2025, 4, True)
    assert got[1][:4] == (2569, 2026, 1, False)          # 1 October starts the next fiscal year
    assert got[2][:4] == (2569, 2026, 2, True)
    assert got[3] == (2569, 2026, 4, False, "2026_07_03.xlsx", "2026-07-03")


def test_call_arg_and_urls(spark):
    href = ("javascript:openDownload('NewsStat_C','1428635636937','/cs/Satellite?blobcol=urldata&blobkey=id"
            "&blobtable=MungoBlobs&blobwhere=1438191564296&ssbinary=true');")
    assert _one(spark, lambda c: web.call_arg(c, "openDownload", 3), href) == (
        "/cs/Satellite?blobcol=urldata&blobkey=id&blobtable=MungoBlobs&blobwhere=1438191564296&ssbinary=true")
    assert _one(spark, lambda c: web.call_arg(c, "openDownload", 3), "https://x/y.xlsx") is None
    df = spark.createDataFrame([("https://a.example/x/y", "/f.xlsx"), ("https://a.example/x", "g.xlsx"),
                                ("https://a.example", "https://b.example/h.zip")], "u string, h string")
    assert [r.o for r in df.select(web.resolve_url("u", "h").alias("o")).collect()] == [
        "https://a.example/f.xlsx", "https://a.example/g.xlsx", "https://b.example/h.zip"]


def test_file_link_predicate(spark):
    pages = ['<a href="/files/Report.XLSX?v=1">r</a>', '<a href="/page.html">p</a>', "no links",
             '<a href="/dl/2024.zip">z</a>']
    df = spark.createDataFrame([(p,) for p in pages], "v string")
    assert [r.o for r in df.select(web.has_file_link("v").alias("o")).collect()] == [True, False, False, True]


def test_sha256_matches_hashlib(spark):
    import hashlib
    assert _one(spark, web.sha256_hex, "ข้อความ") == hashlib.sha256("ข้อความ".encode()).hexdigest()


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 32), st.integers(0, 13), st.integers(2400, 2700)), min_size=20, max_size=60))
def test_era_date_matches_python_rule(spark, triples):
    def expected(d, m, y):
        try:
            return dt.date(y - 543, m, d)
        except ValueError:
            return None
    texts = [f"{d:02d}/{m:02d}/{y}" for d, m, y in triples]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r.o for r in df.select(cal.parse_era_date("v").alias("o")).collect()]
    assert got == [expected(d, m, y) for d, m, y in triples]


def test_links_in_any_attribute_order_and_quoting(spark):
    html = """<a class='x' href='/f.xlsx'>a</a><A href=/g.pdf id=1><a class="" href="/h?x=1&amp;y=2">"""
    assert _one(spark, web.hrefs, html) == ["/f.xlsx", "/g.pdf", "/h?x=1&y=2"]
    assert _one(spark, web.has_file_link, "<a class='x' href='/f.xlsx'>") is True


def test_call_argument_holds_commas_and_brackets(spark):
    call = "openDownload('a,b', 2, '/cs/S?a=1,2(x)')"
    assert _one(spark, lambda c: web.call_arg(c, "openDownload", 3), call) == "/cs/S?a=1,2(x)"
    assert _one(spark, lambda c: web.call_arg(c, "openDownload", 1), call) == "a,b"


def test_scheme_relative_link(spark):
    assert _one(spark, lambda c: web.resolve_url(F.lit("https://h.org/a"), c), "//other.org/x") == "https://other.org/x"


URL_BASES = ["http://a/b/c/d;p?q", "http://h.org/a/b.html", "https://h.org", "HTTP://H.org/x/", "http://h/a//b/../c?x=1#f", "", "file:///a/b",
             "ftp://u@h:21/d/", "/rel/base", "rel", "mailto:x@y", "ws://h/p;1/q;2", "http://h?q=1", "javascript:void(0)", " http://h/a b/\tc"]
URL_REFERENCES = [
    "", "g:h", "g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "g;x", "g;x?y#s", ".", "./", "..", "../", "../g", "../..",
    "../../", "../../g", "../../../g", "/./g", "/../g", "g.", ".g", "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h", "g;x=1/./y", "g;x=1/../y",
    "g?y/../x", "g#s/../x", "http:g", "http://h2/x/../y", "mailto:a@b", "https://z", "HTTP:G", "/a//b///c", "a//b", "?", "#", ";", "..;x", "a;",
    "//h/..", "/%7Ea", "é/日", "a b", " c.xlsx", "\tx\n/y", "javascript:f('a','b')", "/cs/Satellite?blobcol=urldata&x=1", "1:2", "..//..//g"]


def test_url_references_equal_the_standard_library(spark):
    import itertools
    import random
    from urllib.parse import urljoin
    r = random.Random(1)
    parts = ["a", "..", ".", "/", "/", "?", "#", ";", "b.html", "//", ":"]
    refs = URL_REFERENCES + ["".join(r.choice(parts) for _ in range(r.randrange(1, 7))) for _ in range(150)]
    pairs = list(itertools.product(URL_BASES, refs))
    df = spark.createDataFrame([(i, b, x) for i, (b, x) in enumerate(pairs)], "i int, b string, x string")
    out = {q.i: q.u for q in df.select("i", web.resolve_url("b", "x").alias("u")).collect()}
    assert [(b, x, out[i]) for i, (b, x) in enumerate(pairs) if out[i] != urljoin(b, x)] == []


def test_entities_are_decoded_once(spark):
    import html
    texts = ["&lt;a&gt; &amp;lt; &#8211;&#x2013; &#38;lt; &bogus; & x &quot;&#39;&apos;", "plain", "", "a&", "&#x1F600;!", "&#0; &#xD800; &#1114112;"]
    out = [q.d for q in spark.createDataFrame([(t,) for t in texts], "t string").select(web.decode_entities("t").alias("d")).collect()]
    assert out == [html.unescape(t) for t in texts]
    assert spark.createDataFrame([(None,)], "t string").select(web.decode_entities("t")).first()[0] is None
