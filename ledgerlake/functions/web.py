"""Expressions over listing pages, links, paths and content hashes.

All built-in regex functions (Java regex, JVM-side). Listing pages are not
well-formed XML, so ``xpath``/``from_xml`` are not used.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col

# File extensions that make a link a downloadable report.
FILE_LINK_EXTENSIONS = ("xlsx", "xls", "pdf", "zip", "doc", "docx")

# An <a> tag's href in any place among its attributes, in double, single or no quotes.
_ATTRIBUTES = r"""(?:[^>"']|"[^"]*"|'[^']*')*?"""
HREF_PATTERN = rf"""(?is)<a\s(?:{_ATTRIBUTES}\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
HOST_PATTERN = r"^(https?://[^/]+)"
# Scheme, authority, path, query and fragment of a URL reference (RFC 3986, appendix B).
URL_PATTERN = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
# Schemes whose references may be relative, and those whose last path segment has parameters.
RELATIVE_SCHEMES = ("", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms", "prospero", "rtsp",
                    "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss")
PARAMETER_SCHEMES = ("", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp", "rtsps", "rtspu", "sip", "sips",
                     "mms", "sftp", "tel")
# Named references that listing pages use.
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "amp": "&"}
ENTITY_PATTERN = rf"&(?:#[0-9]{{1,9}}|#[xX][0-9A-Fa-f]{{1,7}}|{'|'.join(ENTITIES)});|&|[^&]+"


def hrefs(html) -> Column:
    """The ``href`` of every ``<a>`` tag, in page order, references decoded."""
    tags = F.regexp_extract_all(col(html), F.lit(HREF_PATTERN), 0)
    part = lambda t, i: F.regexp_extract(t, HREF_PATTERN, i)  # noqa: E731  (the other groups are empty)
    return F.transform(tags, lambda t: decode_entities(F.concat(part(t, 1), part(t, 2), part(t, 3))))


def has_file_link(html) -> Column:
    """Some link *contains* one of the file extensions (case-insensitive)."""
    ext = "|".join(FILE_LINK_EXTENSIONS)
    return F.exists(hrefs(html), lambda h: F.lower(h).rlike(rf"\.({ext})"))


def call_arg(text, fn: str, n: int) -> Column:
    """The ``n``-th (1-based) argument of a JavaScript call ``fn(...)``; quotes removed.

    NULL when the call is absent (``regexp_extract`` itself returns ``''``).
    """
    # An argument is a quoted string, which may hold commas and brackets, or bare.
    argument = r"""(?:'[^']*'|"[^"]*"|[^'",()]*?)"""
    skip = rf"{argument}\s*,\s*" * (n - 1)
    pattern = rf"""{re.escape(fn)}\(\s*{skip}(?:'([^']*)'|"([^"]*)"|([^'",()]*?))\s*[,)]"""
    c = col(text)
    return F.nullif(F.concat(*[F.regexp_extract(c, pattern, i) for i in (1, 2, 3)]), F.lit(""))


def site_root(url) -> Column:
    """``scheme://host`` of an absolute URL."""
    return F.regexp_extract(col(url), HOST_PATTERN, 1)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it occurs there."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _url_parts(url: Column) -> Column:
    """Struct of scheme (lower case), authority, path, query and fragment; absent parts are empty."""
    clean = F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    names = ("scheme", "authority", "path", "query", "fragment")
    return _let(clean, lambda u: F.struct(*(
        (F.lower(part) if name == "scheme" else part).alias(name)
        for name, part in ((n, F.regexp_extract(u, URL_PATTERN, i)) for i, n in enumerate(names, 1)))))


def _params(scheme: Column, path: Column) -> Column:
    """The parameters of the path's last segment, with their semicolon; or empty."""
    return F.when(scheme.isin(*PARAMETER_SCHEMES), F.regexp_extract(path, r"(?s)(;[^/]*)$", 1)).otherwise(F.lit(""))


def _joined_url(scheme: Column, authority: Column, path: Column, query: Column, fragment: Column) -> Column:
    rooted = (path == "") | path.startswith("/")
    before = (F.when(authority != "", F.concat(F.lit("//"), authority, F.when(rooted, F.lit("")).otherwise(F.lit("/"))))
              .when(path.startswith("//") | ((scheme != "") & rooted), F.lit("//")).otherwise(F.lit("")))
    prefixed = lambda mark, part: F.when(part != "", F.concat(F.lit(mark), part)).otherwise(F.lit(""))
    return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")), before, path,
                    prefixed("?", query), prefixed("#", fragment))


def _without_dots(segments: Column) -> Column:
    """Path of segments, ``.`` dropped and ``..`` taking the one before along (a fold); a last dot leaves a slash."""
    kept = F.aggregate(segments, F.array().cast("array<string>"), lambda done, s: (
        F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done).otherwise(F.concat(done, F.array(s)))))
    tail = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return _let(F.array_join(F.concat(kept, tail), "/"), lambda path: F.when(path == "", F.lit("/")).otherwise(path))


def _relative_segments(base_path: Column, path: Column) -> Column:
    """Segments of ``path`` below the folder of ``base_path``, without empty ones inside."""
    folder = _let(F.split(base_path, "/"), lambda x: F.when(F.element_at(x, -1) != "", F.slice(x, F.lit(1), F.size(x) - 1)).otherwise(x))
    return _let(F.concat(folder, F.split(path, "/")), lambda x: F.when(
        F.size(x) > 2, F.concat(F.slice(x, 1, 1), F.filter(F.slice(x, F.lit(2), F.size(x) - 2), lambda s: s != ""), F.slice(x, -1, 1))).otherwise(x))


def resolve_url(base_url, href) -> Column:
    """``href`` resolved against ``base_url`` like a link on that page: relative paths, dot
    segments, ``//host``, ``?query`` and ``#fragment`` references; references of another
    (or a non-hierarchical) scheme stay as they are. An empty reference is the base."""
    base, ref = (x if isinstance(x, Column) else col(x) for x in (base_url, href))

    def resolved(p: Column) -> Column:
        b, r, scheme = p["b"], p["r"], p["scheme"]
        path = F.substring(r["path"], F.lit(1), F.length(r["path"]) - F.length(p["params"]))
        params, b_params = (F.when(x == ";", F.lit("")).otherwise(x) for x in (p["params"], p["b_params"]))
        b_path = F.substring(b["path"], F.lit(1), F.length(b["path"]) - F.length(p["b_params"]))
        authority = F.when(r["authority"] != "", r["authority"]).otherwise(b["authority"])
        same_page = (path == "") & (params == "")
        query = F.when(same_page & (r["query"] == "") & (r["authority"] == ""), b["query"]).otherwise(r["query"])
        full = (F.when(r["authority"] != "", F.concat(path, params)).when(same_page, F.concat(b_path, b_params))
                .when(path.startswith("/"), F.concat(_without_dots(F.split(path, "/")), params))
                .otherwise(F.concat(_let(_relative_segments(b_path, path), _without_dots), params)))
        return (F.when((scheme != b["scheme"]) | ~scheme.isin(*RELATIVE_SCHEMES), ref)
                .otherwise(_let(full, lambda f: _joined_url(scheme, authority, f, query, r["fragment"]))))

    both = F.struct(_url_parts(base).alias("b"), _url_parts(ref).alias("r"))
    found = _let(_let(both, lambda x: F.struct(
        x["b"].alias("b"), x["r"].alias("r"), F.when(x["r"]["scheme"] != "", x["r"]["scheme"]).otherwise(x["b"]["scheme"]).alias("scheme"))),
        lambda x: _let(F.struct(x["b"].alias("b"), x["r"].alias("r"), x["scheme"].alias("scheme"), _params(x["scheme"], x["r"]["path"]).alias("params"),
                                _params(x["b"]["scheme"], x["b"]["path"]).alias("b_params")), resolved))
    return F.when(base == "", ref).when(ref == "", base).otherwise(found)


def _code_point(number: Column) -> Column:
    """The character of a code point; U+FFFD for those that aren't characters."""
    valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(valid, number).otherwise(F.lit(0xFFFD)).cast("long")), 8, "0")), "UTF-32")


def decode_entities(text) -> Column:
    """Decode numeric references and the HTML entities listing pages use, each once (``&amp;lt;`` is ``&lt;``)."""
    c = col(text)

    def decoded(token: Column) -> Column:
        out = F.when(~token.startswith("&"), token)
        for name, ch in ENTITIES.items():
            out = out.when(token == f"&{name};", F.lit(ch))
        digits = F.regexp_extract(token, r"^&#[xX]?([0-9A-Fa-f]+);$", 1)
        number = F.when(token.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("long")
        return out.when(digits != "", _code_point(F.coalesce(number, F.lit(0)))).otherwise(token)

    tokens = F.regexp_extract_all(c, F.lit(ENTITY_PATTERN), 0)
    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(tokens, decoded), "")).otherwise(c)


def strip_tags(text) -> Column:
    return F.regexp_replace(col(text), r"<[^>]*>", "")


def text_nodes(html) -> Column:
    """Raw text between tags, in page order (array)."""
    return F.regexp_extract_all(col(html), F.lit(r">([^<]*)<"), 1)


def page_lang(html) -> Column:
    return F.regexp_extract(col(html), r'<html lang="([^"]*)"', 1)


def sha256_hex(c) -> Column:
    """Hex SHA-256 of the bytes (UTF-8 for text)."""
    return F.sha2(col(c), 256)


def base_name(path) -> Column:
    return F.element_at(F.split(col(path), "/"), -1)


def preview(text, n: int | None = None) -> Column:
    """A text, cut to its first ``n`` characters only if the caller asks."""
    return col(text) if n is None else F.substring(col(text), 1, n)
