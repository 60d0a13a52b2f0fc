"""Operator 5: main text of web pages by nearest-URL page differencing.

1. Each page is cut into blocks of text with the element that each lies in. Elements that never hold main text are left out:
   by their name (navigation, footers, forms, scripts ...) or a class that says so (adverts, menus, comments ...).
2. Pages are put in order of host, URL path and content over ranges, so that a page's neighbours are the pages nearest to it by
   path on its host. Rows of equal URL path and content are one page and get one result.
3. A page's blocks are aligned with those of its nearest neighbour (the one whose path begins alike the longest, the one before of
   equals) by longest common subsequence. What is not shared shows where the article is: its core is the innermost element
   with several blocks that holds at least ``CORE`` of the text that is not shared.
4. Shared blocks outside the core are template and deleted. Shared blocks inside it stay: sites quote lines and repeat
   licence lines within articles, and these are article text. Pages that share all but ``COPY`` of their text are two addresses
   of one article and say nothing about templates; then the other neighbour is asked.
5. Where no neighbour says anything (the only page of a host, or copies on both sides), a page keeps its ``article`` or ``main`` elements, or
   else all of its blocks.

Ranges are cut from the sorted keys alone, and the first and last page of each range are given to the ranges beside it
too, so the result doesn't depend on partitions. A host that holds a third of all pages spans many ranges; in a task only a page
and its neighbours are held. The scan of a page is linear in its length, however its tags and quotes are broken.

Defined cases: a null or empty page has an empty text; a null URL counts as an empty host and path; a tag without an end
reaches to the end of the page; quotes count only around an attribute's value, and one that is never closed ends with its tag;
repeated rows give one result row each, with equal texts; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import forget, stored
from tidemark.llm.urlfilter import url_parts

#: Share of the text that isn't shared which the core holds, and share of a page's text below which it is a copy of its neighbour.
CORE, COPY = 0.8, 0.1

# Elements whose content is never main text.
DROPPED = ["script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio", "video", "head", "nav", "header", "footer", "aside", "form", "button", "select", "textarea", "dialog", "menu"]
# Dropped elements whose content is not markup.
RAW = ["script", "style", "textarea", "iframe", "noscript"]
# Elements without content.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
# Elements that stay inside a block of text.
INLINE = ["a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br"]
# Words in class, id or role that name something other than main text.
OTHER = ["ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "comment-list", "consent", "cookie", "cookies", "disqus", "footer", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "popup", "promo", "related", "replies", "reply", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "complementary", "contentinfo", "search"]
MAIN = ("article", "main")
# Class, id or role of an element that holds the main text where no element is named for it.
MAIN_NAMES = ["article", "article-body", "article-content", "main", "main-content", "post", "post-body", "post-content", "entry", "entry-content", "story", "story-body"]

NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME = re.compile(r"[^\s/>]+")
#: What may end a tag, or open a quoted value in it.
TAG_STOP = re.compile(r"""=\s*+(["'])|>""")
SPACE = re.compile(r"\s+")
PARTS = re.compile(r"[\s_]+")
#: Elements that a start tag ends; any that isn't inline ends a paragraph.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_DROPPED, _RAW, _VOID, _INLINE, _OTHER, _MAIN_NAMES = map(frozenset, (DROPPED, RAW, VOID, INLINE, OTHER, MAIN_NAMES))
_ENDS = {name: re.compile(rf"</{name}\s*+>", re.I) for name in RAW}
_SUFFIXES = tuple(f"-{w}" for w in ("ad", "ads", "banner", "comments", "footer", "menu", "nav", "sidebar"))


def _names(attributes: str) -> list[str]:
    """Words of an element's class, id and role."""
    return [w for m in NAMED.finditer(attributes) for w in PARTS.split((m[1] or m[2] or m[3] or "").lower())]


def _is_other(names: list[str]) -> bool:
    return any(w in _OTHER or w.startswith(("ad-", "ads-")) or w.endswith(_SUFFIXES) for w in names)


def tags(page: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, name, attributes) of each tag, the name of an end tag with a slash in front; comments and such have no name."""
    at, size, open_ended = 0, len(page), set()
    while (at := page.find("<", at)) >= 0:
        ahead = page[at + 1 : at + 2]
        if ahead in ("!", "?"):
            stop = "-->" if page.startswith("<!--", at) else "]]>" if page.startswith("<![CDATA[", at) else ">"
            end = page.find(stop, at + (4 if stop == "-->" else 1))
            end = size if end < 0 else end + len(stop)
            yield at, end, "", ""
        elif (ahead.isascii() and ahead.isalpha()) or (ahead == "/" and page[at + 2 : at + 3].isascii() and page[at + 2 : at + 3].isalpha()):
            slash = ahead == "/"
            name = NAME.match(page, at + 1 + slash)
            inside = name.end()
            end = inside
            while (m := TAG_STOP.search(page, end)) is not None:
                if m[1] is None:
                    end = m.end()
                    break
                close = -1 if m[1] in open_ended else page.find(m[1], m.end())
                if close < 0:
                    open_ended.add(m[1])  # no such quote from here on
                end = m.end() if close < 0 else close + 1
            else:
                end = size
            yield at, end, "/" * slash + name[0].lower(), page[inside : end - 1]
        else:
            at += 1
            continue
        at = end


class Page:
    """Blocks of a page in order: their texts, whether each lies in an element for main text, the element that each lies in;
    and of each element its parent and whether it can be a core."""

    def __init__(self, page: str | None) -> None:
        self.texts: list[str] = []
        self.marked: list[bool] = []
        self.element: list[int] = []
        self.parent, self.can_be_core = [0], [False]
        self._read(page or "")

    def _read(self, page: str) -> None:
        text: list[str] = []
        # Name, dropped, main, element, and place of the innermost element that isn't inline; the second and third hold for what is inside.
        open_: list[tuple[str, bool, bool, int, int]] = []
        depth: dict[str, list[int]] = {}  # where the stack holds each name
        dropped = main = False
        at = here = 0

        def end() -> None:
            if text:
                line = SPACE.sub(" ", entities.unescape("".join(text))).strip()
                text.clear()
                if line:
                    self.texts.append(line)
                    self.marked.append(main)
                    self.element.append(here)

        def close(k: int) -> None:
            nonlocal dropped, main, here
            while len(open_) > k:
                depth[open_.pop()[0]].pop()
            _, dropped, main, here, _ = open_[-1] if open_ else ("", False, False, 0, -1)

        for start, stop, name, attributes in tags(page):
            if start < at:
                continue
            if not dropped and start > at:
                text.append(page[at:start])
            at = stop
            if not name:
                continue
            ends = name[0] == "/"
            name = name.lstrip("/")
            if name not in _INLINE:
                end()
            elif name == "br":
                text.append(" ")
            if ends:
                k = depth[name][-1] if depth.get(name) else -1
                held = max((depth[m][-1] for m in MAIN if depth.get(m)), default=-1)
                if k >= held or (k >= 0 and name in ("body", "html")):
                    if k >= 0:
                        close(k)
            elif name not in _VOID and not attributes.rstrip().endswith("/"):
                while name not in _INLINE and open_ and (block := open_[-1][4]) >= 0 and open_[block][0] in CLOSES.get(name, CLOSES["p"]):
                    close(block)  # with the inline elements left open in it
                if name in _RAW:
                    m = _ENDS[name].search(page, at)
                    at = m.end() if m else len(page)
                    continue
                names = _names(attributes) if attributes and name not in ("html", "body") else []
                mine = name in MAIN or not _MAIN_NAMES.isdisjoint(names)
                dropped = dropped or name in _DROPPED or (not mine and _is_other(names))
                main = main or mine
                if name not in _INLINE:
                    self.parent.append(here)
                    self.can_be_core.append(name not in ("html", "body"))
                    here = len(self.parent) - 1
                depth.setdefault(name, []).append(len(open_))
                open_.append((name, dropped, main, here, len(open_) if name not in _INLINE else open_[-1][4] if open_ else -1))
        if not dropped and at < len(page):
            text.append(page[at:])
        end()

    def core(self, common: set[int]) -> set[int]:
        """Blocks of the core, given those that are shared."""
        own = [0] * len(self.parent)
        blocks = [0] * len(self.parent)
        for k, e in enumerate(self.element):
            blocks[e] += 1
            own[e] += 0 if k in common else len(self.texts[k])
        for e in range(len(own) - 1, 0, -1):
            own[self.parent[e]] += own[e]
            blocks[self.parent[e]] += blocks[e]
        least = CORE * own[0]
        core = max((e for e in range(len(own)) if self.can_be_core[e] and blocks[e] > 1 and own[e] >= least), default=-1)
        inside = [False] * len(own)
        for e in range(len(own)):
            inside[e] = e == core or (e > 0 and inside[self.parent[e]])
        return {k for k, e in enumerate(self.element) if inside[e]}


def shared(a: list[str], b: list[str]) -> set[int]:
    """Indexes in a of a longest common subsequence of lines of a and b.

    Equal lines at both ends are matched first; between them the rows of the length table are kept as the bits of
    one number each (a bit-parallel longest common subsequence), from which the matches are read back.
    """
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    found = set(range(lo)) | set(range(len(a) - hi, len(a)))
    x, y = a[lo : len(a) - hi], b[lo : len(b) - hi]
    common = set(x) & set(y)
    if not common:
        return found
    where: dict[str, int] = {}
    for i, line in enumerate(x):
        if line in common:
            where[line] = where.get(line, 0) | 1 << i
    full = (1 << len(x)) - 1
    rows, v = [full], full
    for line in y:
        u = v & where.get(line, 0)
        v = (v + u | v - u) & full
        rows.append(v)
    i, j = len(x), len(y)
    while i and j:
        if rows[j] >> (i - 1) & 1:
            i -= 1
        elif not rows[j - 1] >> (i - 1) & 1:
            j -= 1
        else:
            found.add(lo + i - 1)
            i, j = i - 1, j - 1
    return found


def without_template(own: Page, neighbour: Page) -> str | None:
    """The page's text without the template that it shares with its neighbour; None if the neighbour is a copy and tells nothing."""
    common = shared(own.texts, neighbour.texts)
    size = [len(t) for t in own.texts]
    if sum(size) - sum(size[k] for k in common) <= COPY * sum(size):
        return None
    keep = own.core(common)
    return "\n\n".join(t for k, t in enumerate(own.texts) if k not in common or k in keep)


def alike(a: str, b: str) -> int:
    """Letters with which both begin."""
    n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), None)
    return min(len(a), len(b)) if n is None else n


def main_text(own: Page, path: str, neighbours: list[tuple[Page, str]]) -> str:
    """Text of a page, given the pages of its host before and behind it, if any, each with its path."""
    if own.texts:
        for page, _ in sorted(neighbours, key=lambda x: -alike(x[1], path)):
            text = without_template(own, page)
            if text is not None:
                return text
    marked = any(own.marked)
    return "\n\n".join(t for t, m in zip(own.texts, own.marked, strict=True) if m or not marked)


def ranges(keyed: DataFrame, parts: int) -> tuple[list[tuple], dict[tuple, list[int]]]:
    """First key of each range of pages, and for keys of pages beside a range the ranges that need them too.

    Keys are (host, path, digest). Only the first and last key of each range come to the driver.
    """
    names = ["host", "path", "digest"]
    keys = keyed.select(*names).distinct()
    ranged = stored(keys.repartitionByRange(parts, *names).select(F.spark_partition_id().alias("part"), *names), "page-keys")
    edges = ranged.groupBy("part").agg(F.min(F.struct(*names)).alias("lo"), F.max(F.struct(*names)).alias("hi")).collect()
    forget(ranged)
    edges = sorted((tuple(r["lo"]), tuple(r["hi"])) for r in edges)
    also: dict[tuple, list[int]] = {}
    for i in range(1, len(edges)):
        also.setdefault(edges[i - 1][1], []).append(i)
        also.setdefault(edges[i][0], []).append(i - 1)
    return [lo for lo, _ in edges], also


def extract(pages: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per page: page_id, url, text and n_chars (code points). ``parts``: ranges, four for each shuffle partition if not given."""
    host, path = url_parts(F.col("url"))
    parts = parts or 4 * int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = pages.schema["page_id"].dataType.simpleString()
    keyed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"), path.alias("path")).withColumn("digest", F.md5("html"))
    shared_ = pages.sparkSession.sparkContext.broadcast(ranges(keyed, parts))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        firsts, also = shared_.value
        seen: set = set()
        for b in batches:
            rows = []
            for page_id, url, page, *key in b[["page_id", "url", "html", "host", "path", "digest"]].itertuples(index=False):
                key = tuple(key)
                again = hash(key) in seen  # the page's content has been sent from here
                seen.add(hash(key))
                part = max(0, bisect_right(firsts, key) - 1)
                rows.append((part, *key, 1 if again else 0, 0, page_id, url, None if again else page))
                if not again:
                    rows += [(p, *key, 0, 1, None, None, page) for p in also.get(key, ())]
            yield pd.DataFrame(rows, columns=["part", "host", "path", "digest", "bare", "edge", "page_id", "url", "html"]).astype({"page_id": object})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The page before, the page at hand with the rows that ask for it, and where it is.
        before = own = where = None
        asked: list = []

        def texts(behind: tuple | None) -> list[tuple]:
            beside = [(p, w[2]) for p, w in (x for x in (before, behind) if x) if w[:2] == where[:2]]
            text = main_text(own, where[2], beside) if asked else ""
            return [(page_id, url, text) for page_id, url in asked]

        for b in batches:
            rows: list[tuple] = []
            for part, host, path, digest, edge, page_id, url, page in b[["part", "host", "path", "digest", "edge", "page_id", "url", "html"]].itertuples(index=False):
                if (part, host, path, digest) != where:
                    fresh = Page(page)
                    if where is not None:
                        rows += texts((fresh, (part, host, path, digest)))
                        before = (own, where)
                    own, where, asked = fresh, (part, host, path, digest), []
                if not edge:
                    asked.append((page_id, url))
            yield pd.DataFrame(rows, columns=["page_id", "url", "text"])
        if where is not None:
            yield pd.DataFrame(texts(None), columns=["page_id", "url", "text"])

    columns = f"part int, host string, path string, digest string, bare int, edge int, page_id {kind}, url string, html string"
    dealt = keyed.mapInPandas(deal, columns).repartition("part").sortWithinPartitions("part", "host", "path", "digest", "bare", "edge")
    out = dealt.mapInPandas(run, f"page_id {kind}, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
