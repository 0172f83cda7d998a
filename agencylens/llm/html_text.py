"""HTML extraction by line-block distribution.

Markup is stripped to lines, one for each block of the page. Lines of menus, adverts, forms and other containers that are
not the article weigh nothing, nor do lines that are mostly links and say less than `SAID` beside them, nor, where the page
marks its article or main part, lines outside of it. The weights, which are text lengths, are summed over sliding windows of
`WINDOW` lines; a section surges where a sum exceeds `SURGE`, begins where that rise left 0, and dives where the sum is back
at 0. The text between is kept, of every section that surges. Where nothing surges, every rise from 0 counts whose section
weighs at least `SHARE` of the heaviest.

A page that is null or empty, or has no text, gives no block. Very long pages are read whole, in one walk. Repeated pages are
read alike, row by row. Original columns travel in one struct, so no name clashes; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from agencylens.llm.shared import packed

WINDOW, SURGE, SHARE, SAID = 3, 80, 0.25, 20

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.DOTALL
)
#: Elements of HTML whose content is no text, that are never the article, and that start a line.
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes template svg math object canvas audio video head".split())
OUTSIDE = frozenset("nav footer aside form header menu button select dialog fieldset label input".split())
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MARKED = frozenset(("article", "main"))
#: Words of class, id and role that name what is not the article.
NAMES = frozenset(
    "ad ads adbox adsbygoogle adslot advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner nav navbar navigation menu submenu breadcrumb breadcrumbs "
    "sidebar aside widget widgets footer contentinfo complementary cookie cookies cookiebar consent gdpr notice notices notification alert popup modal overlay dialog "
    "newsletter subscribe subscription signup login search share sharing social related recommended recommendations trending comment comments commentlist disqus respond "
    "reply replies discussion copyright disclaimer pagination pager toolbar paywall".split()
)
#: The same, but only outside of a marked article, which may have a header of its own.
PAGE_NAMES = frozenset("header masthead topbar branding".split())
#: Those that an article element itself can have, as comments and teasers do; words before which a name tells of a layout.
ARTICLE_NAMES = frozenset("ad advert comment comments reply related recommended promo sponsored teaser".split())
LAYOUT = frozenset("has with no without".split())
#: Elements of a marked article whose id can name what is not the article; other elements' ids are anchors to what they say.
CONTAINERS = frozenset(("div", "aside"))
#: Whole ids by which readers' comments are known in any element.
ARTICLE_IDS = frozenset("comments comment-list commentlist comment-section disqus disqus_thread".split())
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_ARTICLE = re.compile(r"<(?:article|main)\b", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z0-9]+")


class Line(NamedTuple):
    text: str
    weight: int
    #: inside a marked article or main part
    marked: bool


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)} if raw else {}


def _hidden(own: dict[str, str]) -> bool:
    return "hidden" in own or own.get("aria-hidden", "").lower() == "true" or "display:none" in own.get("style", "").replace(" ", "").lower()


def _named(own: dict[str, str], names: frozenset[str], by_id: bool = True) -> bool:
    for k in ("class", "id", "role") if by_id else ("class", "role"):
        words = [w.lower() for w in _CAMEL.split(own.get(k, ""))]
        if any(w in names and (not i or words[i - 1] not in LAYOUT) for i, w in enumerate(words)):
            return True
    return False


def lines(html: str, reopen: bool = False) -> list[Line]:
    """The blocks of a page that have text, in order; blocks of other parts than the article are empty lines.

    reopen: an article element ends every other part that is open around it.
    """
    out: list[Line] = []
    said: list[str] = []
    linked: list[str] = []
    skip: list[str] = []  # open elements within a part that is not the article, its own first
    marked = links = 0
    at, lower = 0, None

    def close() -> None:
        text = " ".join(unescape("".join(said)).split())
        if text:
            beside = len(text) - len(" ".join(unescape("".join(linked)).split()))
            out.append(Line(text, len(text) if 2 * beside >= len(text) else beside if beside >= SAID else 0, marked > 0))
        said.clear()
        linked.clear()

    def text(part: str) -> None:
        if part and not skip:
            said.append(part)
            if links:
                linked.append(part)

    while True:
        tag = _TAG.search(html, at)
        text(html[at : tag.start()] if tag else html[at:])
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        ends, raw = bool(tag[1] or tag[4]), tag[3] or tag[6] or ""
        if name in RAW and not ends and not raw.endswith("/"):
            lower = html.lower() if lower is None else lower  # lengths can differ only for letters that no tag has
            stop = lower.find(f"</{name}", at) if len(lower) == len(html) else html.find(f"</{name}", at)
            at = len(html) if stop < 0 else stop
            continue
        if name in BLOCKS:
            close()
        if ends:
            if skip:
                if name in skip:
                    del skip[len(skip) - 1 - skip[::-1].index(name) :]
                continue
            marked -= name in MARKED and marked > 0
            links -= name == "a" and links > 0
            continue
        if name in VOID or raw.endswith("/"):
            continue
        if reopen and name in MARKED and not marked:
            skip.clear()
        if skip:
            if name in BLOCKS and name not in ("p", "li", "dt", "dd", "td", "th", "tr", "option") or name == skip[0]:
                skip.append(name)
            continue
        own = _attributes(raw)
        names = ARTICLE_NAMES if name == "article" else frozenset() if name == "main" else NAMES if marked else NAMES | PAGE_NAMES
        if name not in ("body", "html") and (name in OUTSIDE and not (name == "header" and marked) or own and (_hidden(own) or _named(own, names, not marked or name in CONTAINERS or own.get("id", "").lower() in ARTICLE_IDS))):
            close()
            out.append(Line("", 0, marked > 0))
            skip.append(name)
        elif name in MARKED:
            marked += 1
        elif name == "a":
            links += 1
    close()
    return out


def sections(weights: list[int], window: int = WINDOW, surge: int = SURGE, share: float = SHARE) -> list[tuple[int, int]]:
    """(first, last + 1) of the lines between each surge's rise from 0 and its dive to 0; without a surge, of the sections that weigh enough."""
    n = len(weights)
    sums = [sum(weights[i : i + window]) for i in range(n)]
    runs, i = [], 0
    while i < n:
        start = i
        while i < n and sums[i]:
            i += 1
        if i > start:
            first = next(k for k in range(start, i) if weights[k])
            runs.append((first, i, max(sums[start:i]), sum(weights[start:i])))
        i += 1
    if found := [(a, b) for a, b, most, _ in runs if most > surge]:
        return found
    heaviest = max((mass for *_, mass in runs), default=0)
    return [(a, b) for a, b, _, mass in runs if mass >= share * heaviest]


def weighed(page: list[Line]) -> list[Line]:
    """The lines as the distribution sees them. In a page that marks its article, only the article's own lines weigh, all of them, and what was stripped inside of it leaves no gap."""
    if not any(line.marked and line.text for line in page):
        return page
    return [line._replace(weight=len(line.text) if line.marked else 0) for line in page if line.text or not line.marked]


def main_blocks(html: str | None) -> list[str]:
    """The main text's blocks in page order; none of a page that is null, empty or has no text."""
    if not html:
        return []
    page = lines(html)
    if not any(line.marked and line.text for line in page) and _ARTICLE.search(html):  # a part around it is never closed, or is a layout
        page = lines(html, reopen=True)
    page = weighed(page)
    return [line.text for a, b in sections([line.weight for line in page]) for line in page[a:b] if line.text]


def extracted(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Struct `doc` of the kept columns and `blocks`, the blocks of the main text of every whole `html`."""
    rows = packed(pages, keep, html=F.col("html"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = pa.array([main_blocks(h.as_py()) for h in batch.column("html")], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), blocks], ["doc", "blocks"])

    return rows.mapInArrow(extract, f"doc {rows.schema['doc'].dataType.simpleString()}, blocks array<string>")


def extraction_report(pages: DataFrame) -> DataFrame:
    """Digest: page_id, url, text, n_chars."""
    found = extracted(pages, keep=["page_id", "url"]).select("doc.page_id", "doc.url", F.array_join("blocks", " ").alias("text"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
