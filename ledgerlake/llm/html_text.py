"""Main text of web pages: site template removal and structural rules.

A page is parsed into elements (implied end tags closed as browsers do). Every
element subtree gets a hash of its tag, attributes, text and children. Spark
counts, per host, on how many different pages a subtree hash occurs; pages whose
whole bodies are equal count once, so copies of an article are no template. A
subtree that recurs on at least ``MIN_PAGES`` pages and ``MIN_SHARE`` of the
host's pages is deleted. Elements that hold a page's main container (article,
else main) are no candidates.

Subtrees with text inside the container are candidates too, counted on
different containers. To tell template from copies and near copies of an
article, they are counted a second time, only on the pages that otherwise
differ: at least half of the container's words lie in no subtree that recurs on
``MIN_PAGES`` containers of the host. What passes the limits there is deleted on
all pages of the host. Paragraphs, headings and the like (``PROSE``) may be the
articles' own: they must be on ``PROSE_SHARE`` of those pages.

Navigation, adverts, forms, scripts, comments and the like are also dropped by
tag, role and class names. What is left of the container (or of the body,
without one) is the text: one line per block.

Defined cases: null html has no text; a null or malformed url belongs to the
host ''; unclosed elements end with their parent; text never ends in the middle
of a character reference; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm import words
from ledgerlake.llm.store import checkpointed

ROWS = 256
MIN_PAGES = 8
MIN_SHARE = 0.05
PROSE_SHARE = 0.5
INSIDE = 0x2545F4914F6CDD1D  # tells a hash inside the container from the same one outside
ALL = -1                     # key under which a host's pages (or containers) are counted
OUTSIDE, BOX, OWN = range(3)  # kinds of subtrees: outside the container; inside, others and those of PROSE
BROADCAST_ROWS = 1_000_000   # recurring subtrees (8 bytes each); beyond, a shuffle

# Element and class names of HTML and of common page furniture.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol
optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
DROPPED = frozenset("""head nav header footer aside form script style noscript template iframe svg canvas button select
textarea title menu dialog object applet audio video map math""".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
DROPPED_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner banners breadcrumb breadcrumbs
comment comments commentlist respond disqus consent cookie cookies gdpr copyright footer header masthead login signup menu
modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promotion related share
sharing sidebar social sponsor sponsored subscribe subscription toolbar widget widgets""".split())
PROSE = frozenset("""a abbr b blockquote cite code dd dt em figcaption font h1 h2 h3 h4 h5 h6 i kbd li mark p pre q s small span
strong sub sup td th time tr u""".split())
ENDS_P = BLOCKS - {"body", "html", "head", "option", "optgroup", "legend", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
SCOPES = frozenset("ul ol dl table select div section article main body html nav aside header footer form blockquote".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'=/>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
NAME = re.compile(r"[a-z0-9]+")
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


class Page:
    """Elements in page order (parents first) and the text pieces between tags."""

    def __init__(self, html: str):
        self.tag, self.parent, self.attrs, self.hash = ["#"], [-1], [{}], [0]
        self.pieces: list[tuple[int, int, str]] = []  # element, block, text
        self._parse(html)
        self.inside, self.holds = self.container()

    def _parse(self, html: str) -> None:
        stack, parts, block, at = [0], [[]], 0, 0
        lower = None

        def close(upto: int) -> None:
            while len(stack) > upto:
                node = stack.pop()
                content = "\x1f".join(parts.pop())
                a = self.attrs[node]
                self.hash[node] = h = xxhash.xxh3_64_intdigest(
                    "\x1e".join((self.tag[node], a.get("class", ""), a.get("id", ""), a.get("href", ""), content)).encode("utf-8", "replace")) >> 1
                if parts:
                    parts[-1].append(f"{h:x}")

        def text(raw: str) -> None:
            if raw:
                found = unescape(raw) if "&" in raw else raw
                self.pieces.append((stack[-1], block, found))
                if clean := " ".join(found.split()):
                    parts[-1].append(clean)

        while (m := TAG.search(html, at)):
            text(html[at:m.start()])
            at = m.end()
            name = m[2]
            if name is None:
                continue
            name = name.lower()
            if m[1]:
                for k in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[k]] == name:
                        close(k)
                        break
                block += name in BLOCKS
                continue
            if name in ENDS_P:
                self._end(stack, close, {"p"}, SCOPES)
            if name in CLOSES:
                self._end(stack, close, CLOSES[name], SCOPES - {"div", "section"} if name == "li" else SCOPES)
            if name in BLOCKS:
                block += 1
            elif name == "br":
                text(" ")
            node = len(self.tag)
            self.tag.append(name)
            self.parent.append(stack[-1])
            self.attrs.append({a[1].lower(): unescape((a[2] or "").strip("\"'")) for a in ATTRIBUTE.finditer(m[3])} if m[3].strip(" /") else {})
            self.hash.append(0)
            stack.append(node)
            parts.append([])
            if name in VOID or (m[3].endswith("/") and name not in BLOCKS):
                close(len(stack) - 1)
            elif name in RAW:
                lower = html.lower() if lower is None else lower
                end = lower.find("</" + name, at)
                end = len(html) if end < 0 else end
                parts[-1].append(html[at:end])  # never text of the page
                at = end
        text(html[at:])
        close(0)

    def _end(self, stack, close, tags, scopes) -> None:
        """Ends the innermost open element of ``tags``, unless an element of ``scopes`` lies between."""
        for k in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[k]]
            if tag in tags:
                close(k)
                return
            if tag in scopes:
                return

    def container(self) -> tuple[list[bool], list[bool]]:
        """Of every element: whether it is or lies in a main container, and whether it holds one."""
        n = len(self.tag)
        hidden = [False] * n
        for i in range(1, n):
            hidden[i] = hidden[self.parent[i]] or self.furniture(i, False)
        for test in (lambda i: self.tag[i] == "article", lambda i: self.tag[i] == "main" or self.attrs[i].get("role") == "main"):
            roots = {i for i in range(1, n) if test(i) and not hidden[i]}
            if roots:
                inside, holds = [False] * n, [False] * n
                for i in range(1, n):
                    inside[i] = i in roots or inside[self.parent[i]]
                    if i in roots and not inside[self.parent[i]]:
                        up = self.parent[i]
                        while up > 0 and not holds[up]:
                            holds[up] = True
                            up = self.parent[up]
                return inside, holds
        return [False] * n, [t in ("#", "html", "body") for t in self.tag]

    def furniture(self, i: int, inside: bool) -> bool:
        """Whether an element is no main text by its tag, role or class. Inside the container a header may hold the title."""
        tag, a = self.tag[i], self.attrs[i]
        if tag in ("html", "body", "main"):
            return False
        if tag in DROPPED and not (inside and tag == "header"):
            return True
        if not a:
            return False
        if a.get("role", "").lower() in DROPPED_ROLES or "hidden" in a or a.get("aria-hidden") == "true":
            return True
        if "style" in a and "display:none" in a["style"].replace(" ", "").lower():
            return True
        names = NAME.findall(f"{a.get('class', '')} {a.get('id', '')}".lower())
        found = DROPPED_NAMES.intersection(names)
        return bool(found - {"header"} if inside else found)

    def candidates(self) -> list[int]:
        """Hashes of the subtrees outside the container that may be site template."""
        return list({self.hash[i] for i in range(1, len(self.tag))
                     if not self.inside[i] and not self.holds[i] and self.tag[i] not in ("head", "title", "meta", "link")})

    def dropped(self, templates: frozenset = frozenset()) -> list[bool]:
        """Of every element: whether it is or lies in furniture or a template."""
        out = [False] * len(self.tag)
        for i in range(1, len(self.tag)):
            up = self.parent[i]
            out[i] = out[up] or self.furniture(i, self.inside[i]) or (
                self.inside[up] and self.hash[i] ^ INSIDE in templates if self.inside[i]
                else not self.holds[i] and self.hash[i] in templates)
        return out

    def _words(self, dropped: list[bool]) -> list[int]:
        """Words of every subtree that lie in the container and aren't dropped."""
        count = [0] * len(self.tag)
        for node, _, piece in self.pieces:
            if self.inside[node] and not dropped[node]:
                count[node] += len(piece.split())
        for i in range(len(self.tag) - 1, 0, -1):
            count[self.parent[i]] += count[i]
        return count

    def inner(self) -> tuple[int, dict[int, int]]:
        """The container's digest (0: none) and the key and kind of each subtree with text inside it."""
        count = self._words(self.dropped())
        roots = [i for i in range(1, len(self.tag)) if self.inside[i] and not self.inside[self.parent[i]]]
        digest = xxhash.xxh3_64_intdigest(" ".join(f"{self.hash[i]:x}" for i in roots)) >> 1 if roots else 0
        return digest, {self.hash[i] ^ INSIDE: OWN if self.tag[i] in PROSE else BOX
                        for i in range(1, len(self.tag)) if count[i] and self.inside[self.parent[i]]}

    def differs(self, recurring: frozenset) -> bool:
        """Whether at least half of the container's words are in no recurring subtree."""
        return 2 * self._words(self.dropped(recurring))[0] >= self._words(self.dropped())[0]

    def text(self, templates: frozenset = frozenset()) -> str:
        dropped, inside = self.dropped(templates), self.inside
        anywhere = not any(inside)
        blocks: dict[int, list[str]] = {}
        for node, block, piece in self.pieces:
            if not dropped[node] and (anywhere or inside[node]):
                blocks.setdefault(block, []).append(piece)
        lines = (" ".join("".join(x).split()) for x in blocks.values())
        return "\n".join(x for x in lines if x)


def _host(pages: DataFrame, url: str) -> DataFrame:
    return pages.withColumn("__host", F.xxhash64(F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), HOST, 1))))


def _ids(host: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """One hash of a host and each of its keys."""
    return words.mixed(words.mixed(keys.astype(np.int64).view(np.uint64)) + host.astype(np.int64).view(np.uint64))


class Known:
    """Which keys of a page are in a table of hosts and keys: by the ids of all its rows, or as a join has listed them."""

    def __init__(self, ids=None):
        self.ids = ids

    def of(self, host: int, keys: list[int], listed: list[int] | None) -> frozenset:
        if self.ids is None:
            return frozenset(listed or ())
        ids = self.ids.value
        if not len(ids) or not keys:
            return frozenset()
        mine = _ids(np.array([host]), np.array(keys, np.int64))
        hit = ids[np.minimum(np.searchsorted(ids, mine), len(ids) - 1)] == mine
        return frozenset(keys[i] for i in np.flatnonzero(hit).tolist())


def _known(spark: SparkSession, at: DataFrame, html: str, table: DataFrame, limit: int) -> tuple[DataFrame, Known]:
    """``at`` with __listed, and the table's rows: a broadcast up to ``limit`` rows, else joined by host and key to slim rows of the pages' keys."""
    if table.count() <= limit:
        rows = table.select("__host", "__key").toArrow()
        ids = np.unique(_ids(rows["__host"].to_numpy(), rows["__key"].to_numpy()))
        return at.withColumn("__listed", F.lit(None).cast("array<long>")), Known(spark.sparkContext.broadcast(ids))

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                out = []
                for host, page, text in zip(*(c.to_pylist() for c in batch.slice(start, ROWS).columns), strict=True):
                    found = Page(text or "")
                    out += [(host, page, k) for k in (*found.candidates(), *found.inner()[1])]
                yield _batch(out, ("__host", "__page", "__key"))

    at = at.withColumn("__page", F.xxhash64(F.coalesce(F.col(html), F.lit(""))))
    rows = at.select("__host", "__page", html).mapInArrow(run, "__host long, __page long, __key long").distinct()
    listed = rows.join(table.select("__host", "__key"), ["__host", "__key"]).groupBy("__host", "__page").agg(F.collect_list("__key").alias("__listed"))
    return at.join(listed, ["__host", "__page"], "left"), Known()


def _batch(rows: list[tuple], names: tuple) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=list(names))


def _counted(seen: DataFrame) -> DataFrame:
    """__n, on how many different bodies a host's key occurs."""
    return seen.distinct().groupBy("__host", "__key", "__kind").agg(F.count("*").alias("__n"))


def _shared(counts: DataFrame, limit: Column) -> DataFrame:
    """__host and __key of what is on ``limit`` or more of the host's bodies."""
    every = counts.where(F.col("__key") == ALL).select("__host", F.col("__n").alias("__all"))
    return counts.where(F.col("__key") != ALL).join(every, "__host").where(F.col("__n") >= limit).select("__host", "__key")


def templates(spark: SparkSession, pages: DataFrame, url: str = "url", html: str = "html", min_pages: int = MIN_PAGES,
              min_share: float = MIN_SHARE, prose_share: float = PROSE_SHARE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """__host and __key, the hashes of its recurring subtrees (inside a container: their keys)."""
    names = ("__host", "__key", "__kind", "__body")
    kind = ", ".join(f"{n} long" for n in names)

    def every(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                out = []
                for host, text in zip(*(c.to_pylist() for c in batch.slice(start, ROWS).columns), strict=True):
                    page = Page(text or "")
                    digest, inner = page.inner()
                    out += [(host, k, OUTSIDE, page.hash[0]) for k in (ALL, *page.candidates())]
                    out += [(host, k, x, digest) for k, x in inner.items()]
                yield _batch(out, names)

    at = _host(pages, url).select("__host", html)
    counts = _counted(at.mapInArrow(every, kind))
    counts = checkpointed(spark, counts.where((F.col("__n") >= min_pages) | (F.col("__key") == ALL)))
    outside = _shared(counts.where(F.col("__kind") == OUTSIDE), min_share * F.col("__all"))
    recurring = counts.where(F.col("__kind") != OUTSIDE)
    if not recurring.limit(1).count():
        return outside
    again, known = _known(spark, at, html, recurring, broadcast_rows)

    def differing(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                out = []
                for host, text, listed in zip(*(c.to_pylist() for c in batch.slice(start, ROWS).columns), strict=True):
                    page = Page(text or "")
                    digest, inner = page.inner()
                    found = known.of(host, list(inner), listed)
                    if digest and page.differs(found):
                        out += [(host, ALL, BOX, digest), *((host, k, x, digest) for k, x in inner.items() if k in found)]
                yield _batch(out, names)

    counts = _counted(again.select("__host", html, "__listed").mapInArrow(differing, kind))
    share = F.when(F.col("__kind") == OWN, prose_share).otherwise(min_share)
    counts = counts.where((F.col("__n") >= min_pages) | (F.col("__key") == ALL))
    return outside.union(_shared(checkpointed(spark, counts), share * F.col("__all")))


def extract(spark: SparkSession, pages: DataFrame, url: str = "url", html: str = "html", keep: list[str] | None = None,
            text: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``keep`` columns (default: all but html) and the main text."""
    keep = [c for c in ([c for c in pages.columns if c != html] if keep is None else keep) if c != text]
    found = checkpointed(spark, templates(spark, pages, url, html, broadcast_rows=broadcast_rows))
    at, known = _known(spark, _host(pages, url), html, found, broadcast_rows)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                texts = []
                for h, host, listed in zip(*(part.column(len(keep) + k).to_pylist() for k in range(3)), strict=True):
                    page = Page(h or "")
                    texts.append(page.text(known.of(host, page.candidates() + list(page.inner()[1]), listed)))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), pa.array(texts, pa.string())],
                                                 names=[*keep, text])

    return at.select(*keep, F.col(html).alias("__html"), "__host", "__listed").mapInArrow(
        run, T.StructType([*[pages.schema[c] for c in keep], T.StructField(text, T.StringType())]))
