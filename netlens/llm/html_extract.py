"""Main-text extraction from HTML by tag-path ratios.

Each text node lies on a root-to-leaf tag path.  Over all nodes of a path, the text
length and the punctuation per node tell running text from menus and labels.  The
two ratios are smoothed over the page order, fused (their product, less the share
of linked text) and thresholded by the spread of the page's scores; blocks above it
are content and kept wherever they are.  The element that holds most of that content,
or the outermost ``article`` and ``main`` elements if they hold half of it, are the
region of the article: its other blocks are kept too, so that a short paragraph or a
heading on a path of low ratio is not lost (items that are all link only within
``article`` and ``main``).  Outside it an ``h1`` and the headings right before a kept
block are kept, unless they are all link.  Elements
that say themselves that they are no article text (``nav``, ``footer``, ``form``) are
left out before the ratios are taken, and so are those whose class or id says it
(``sidebar``, ``comments``), unless they wrap the article: they hold an ``h1``, an
``article`` or ``main`` that is not small beside the largest one, or more than half of
the text around them (nine tenths for comments) with no ``article`` beside them.  A
heading, a section and an id within the article count as named only if the whole name
says it (``related-posts``, not ``related-work``).

Pages are independent; Spark deals them out and a task parses one page at a time.

Defined results: null or empty html, and html without article text, give an empty
text of 0 characters.  Broken markup is read like a browser does: an open tag at the
end is dropped, missing end tags are implied, stray ones ignored; ``noscript``,
``iframe``, ``select``, ``object`` and the like without an end tag end at the next block,
``svg`` and ``math`` at any HTML block, ``head`` at the first tag or text of the body.
Only ``script``, ``style``, ``textarea`` and ``title`` reach to the end of the page, as
in a browser.  Rows that repeat give equal rows; null ids and urls are passed on.  Further columns are kept; those
named like an output are replaced.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import with_column

# Elements of the HTML standard by the way they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu "
    "nav ol option p pre section summary table tbody td tfoot th thead tr ul caption".split())
TEXT_BLOCKS = frozenset("h1 h2 h3 h4 h5 h6 p li pre blockquote td th dt dd figcaption".split())
CLOSED_BY = {  # an open element of the value's kinds ends where one of the key's kind starts
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table select article section div body html "
                   "noscript template svg math iframe object canvas head".split())
RAW = "script|style|textarea|title"  # no tags inside; without an end tag, or "/>", to the end
# Elements that are no text whatever they hold; what they hold is read as elements.
SKIPPED = frozenset("noscript template select svg math iframe object canvas head".split())
NESTING = frozenset("template object".split())
HEAD_TAGS = frozenset("base basefont bgsound link meta noscript template head".split())
HTML_IN = frozenset("foreignobject desc annotation-xml".split())  # HTML within svg and math
# Names by which pages mark what is not article text.
NOT_TEXT_TAGS = frozenset("nav footer aside form button label dialog menu fieldset".split())
NOT_TEXT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu "
    "menubar toolbar".split())
NOT_TEXT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo "
    "promotion banner nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar "
    "sidebars rail widget widgets footer masthead cookie cookies consent gdpr notice notices "
    "notification alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations comment comments reply replies "
    "disqus respond form pagination pager toolbar".split())
HEADER_NAMES = frozenset("header topbar".split())
COMMENT_NAMES = frozenset("comment comments reply replies disqus respond".split())
LAYOUT_WORDS = frozenset(  # words that say nothing beside a name: "comments-area"
    "area bar block body bottom box button buttons col column container content footer form group "
    "header heading holder icons inner item items label left links list module outer panel post "
    "posts articles stories region right section slot thread title top unit wrap wrapper".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NOT_BEFORE = frozenset("has with no is".split())  # "has-sidebar" is not a sidebar
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")

TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)
    | <(?P<raw>{RAW})(?=[\s/>])(?:(?:[^>]*["'\s])?/>|[^>]*>.*?(?:</(?P=raw)\s*>|\Z))
    | <(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*"|'[^']*')*+)>
    | <[a-z/!?][^>]*(?:>|\Z)
    | (?P<text>[^<]+|<)""", re.S | re.I | re.X)
ATTR = re.compile(r"""(class|id|role|style|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""",
                  re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class _Element:
    __slots__ = ("tag", "up", "out", "article", "named", "size", "wraps", "skipped", "unclosed")

    def __init__(self, tag: str, up: _Element | None, attrs: str):
        self.tag, self.up = tag, up
        in_article = bool(up and up.article)
        self.article = tag in ("article", "main") or in_article
        self.out = bool(up and up.out) or _not_text(tag, attrs, in_article)
        self.named = _named(tag, attrs, in_article)  # the word that says "no article text", or ""
        self.skipped = tag in SKIPPED or bool(up and up.skipped)
        self.out |= self.skipped
        self.unclosed = False  # a skipped element without an end tag: ends at the next block
        self.size, self.wraps = 0, False  # unlinked characters; holds an h1 or a large article


def _not_text(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in NOT_TEXT_TAGS or tag == "header" and not in_article:
        return True
    if not attrs.strip() or tag in ("html", "body", "main", "article"):
        return False
    for key, *values in ATTR.findall(attrs):
        value, key = "".join(values), key.lower()
        if key == "hidden" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
        if key == "role" and value.lower().strip() in NOT_TEXT_ROLES:
            return True
    return False


def _named(tag: str, attrs: str, in_article: bool) -> str:
    """The word of a class or id that says that the element is no article text, or ""."""
    if not attrs.strip() or tag in ("html", "body", "main"):
        return ""
    for key, *values in ATTR.findall(attrs):
        key = key.lower()
        if key not in ("class", "id"):
            continue
        slug = (tag in HEADINGS or tag == "section" and (in_article or key == "id")
                or key == "id" and in_article)
        for name in "".join(values).split():
            parts = [x.lower() for x in NAME.findall(name)]
            hits = [p for p, q in zip(parts, ["", *parts], strict=False) if q not in NOT_BEFORE
                    and (p in NOT_TEXT_NAMES or not in_article and p in HEADER_NAMES)]
            if hits and not (slug and any(p not in NOT_TEXT_NAMES and p not in LAYOUT_WORDS
                                          and not p.isdigit() for p in parts)):
                return next((p for p in hits if p in COMMENT_NAMES), hits[0])
    return ""


def _drop_named(elements: list[_Element], blocks: list[_Block]) -> None:
    """Mark as out what its name says is no article text and what does not wrap the article."""
    for b in blocks:
        for at, (_, text, linked) in zip(b.within, b.nodes, strict=True):
            n = 0 if linked else len(text.strip())
            for e in _chain(at) if n else ():
                e.size += n
    comments = {e for e in elements if e.named in COMMENT_NAMES}
    articles = [e for e in elements if e.tag in ("article", "main") and e.size and not (
        e in comments and any(x in comments and x is not e for x in _chain(e)))]
    least = max((e.size for e in articles), default=0) / 4
    articles = [e for e in articles if e.size >= least]
    for e in [*articles, *(e for e in elements if e.tag == "h1" and not e.out)]:
        for x in _chain(e):
            x.wraps = True
    for e in elements:  # in page order, so after the element around it
        if e.up is not None and e.up.out:
            e.out = True
        if e.out or not e.named or e.wraps or e.tag in ("article", "h1"):
            continue
        around = next((x for x in _chain(e.up) if x.tag in ("article", "main")), None)
        most = e.size > (0.9 if e in comments else 0.5) * (around or elements[0]).size
        if not most or around is None and articles:
            e.out = True


class _Block:
    __slots__ = ("at", "nodes", "within", "text")

    def __init__(self, at: _Element):
        self.at, self.nodes, self.within, self.text = at, [], [], ""


def blocks_of(html: str) -> list[_Block]:
    """The blocks of running text outside what marks itself as something else; each with
    its innermost block element and its text nodes (tag path, text, whether linked)."""
    top = _Element("#", None, "")
    stack, blocks, now, elements = [top], [], _Block(top), [top]
    marks: dict[str, list[tuple[int, int]]] = {}  # where tags of skipped elements are

    def end_block() -> None:
        nonlocal now
        if now.nodes:
            blocks.append(now)
        now = _Block(next(e for e in reversed(stack) if e.tag in BLOCK or e is top))

    def closed(tag: str, after: int) -> bool:
        """Whether an end tag belongs to the start tag that ends at ``after``."""
        if tag not in marks:
            marks[tag] = [(m.start(), -1 if m[1] else 1) for m in
                          re.finditer(rf"<(/?){tag}(?=[\s/>])[^>]*(?<!/)>", html, re.I)]
        open_ = 1
        for _, change in marks[tag][bisect_left(marks[tag], (after,)):]:
            open_ += change
            if not open_ or tag not in NESTING:
                return not open_
        return False

    def end_skipped(tag: str) -> None:
        """End the skipped elements that cannot hold a new element ``tag``."""
        for i in range(1, len(stack)):
            e = stack[i]
            if (e.tag == "head" and tag not in HEAD_TAGS
                    and (tag == "body" or i == len(stack) - 1)
                    or e.tag in ("svg", "math") and tag in BLOCK
                    and not any(x.tag in HTML_IN for x in stack[i:])
                    or e.unclosed and tag in BLOCK and not (
                        e.tag == "select" and tag in ("option", "hr"))):
                del stack[i:]
                if stack[-1].skipped:
                    end_skipped(tag)
                return

    def close(kinds, scope) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in kinds:
                del stack[i:]
                return
            if stack[i].tag in scope:
                return

    for m in TOKEN.finditer(html):
        if (text := m["text"]) is not None:
            if stack[-1].tag == "head" and text.strip():
                stack.pop()
            here = stack[-1]
            if not here.out:
                path = "/".join(e.tag for e in stack[1:])
                now.nodes.append((path, unescape(text), any(e.tag == "a" for e in stack)))
                now.within.append(here)
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        block = tag in BLOCK
        if tag == "br":
            now.nodes.append(("", " ", False))
            now.within.append(stack[-1])
        elif m["end"]:
            if tag in SKIPPED:
                close({tag}, ())
            elif block:
                open_ = next((e for e in reversed(stack) if e.tag == tag), None)
                if open_ is not None and open_.skipped:
                    close({tag}, ())
                elif open_ is not None:
                    end_block()
                    close({tag}, ())
                    now.at = next(e for e in reversed(stack) if e.tag in BLOCK or e is top)
            else:
                close({tag}, BLOCK)
        else:
            if stack[-1].skipped:
                end_skipped(tag)
            block = block and not stack[-1].skipped  # what is skipped does not part a text
            if stack[-1].skipped and tag in CLOSED_BY:
                close(CLOSED_BY[tag], SCOPES)
            if block:
                end_block()
                close({"p"}, SCOPES)
                if tag in CLOSED_BY:
                    close(CLOSED_BY[tag], SCOPES)
                    if tag == "tr":
                        close({"tr"}, SCOPES)
                while len(stack) > 1 and stack[-1].tag not in BLOCK:
                    stack.pop()  # formatting does not reach into a block it did not close before
            if tag not in VOID and not m["attrs"].endswith("/"):
                stack.append(_Element(tag, stack[-1], m["attrs"]))
                elements.append(stack[-1])
                if tag in SKIPPED and tag not in ("head", "svg", "math"):
                    stack[-1].unclosed = not closed(tag, m.end())
            if block:
                now.at = next(e for e in reversed(stack) if e.tag in BLOCK or e is top)
    end_block()
    if any(e.named for e in elements):
        _drop_named(elements, blocks)
    for b in blocks:
        b.nodes = [n for n, at in zip(b.nodes, b.within, strict=True) if not at.out]
        b.text = " ".join("".join(t for _, t, _ in b.nodes).split())
    return [b for b in blocks if b.text]


def _smoothed(values: list[float]) -> list[float]:
    """Gaussian over the neighbours, radius 1 (weights e^0, e^-1/2)."""
    side, out = math.exp(-0.5), []
    for i, v in enumerate(values):
        near = values[max(0, i - 1):i] + values[i + 1:i + 2]
        out.append((v + side * sum(near)) / (1 + side * len(near)))
    return out


def content_scores(blocks: list[_Block]) -> list[float]:
    """The fused tag-path ratio of each block."""
    paths: dict[str, list[int]] = {}
    for b in blocks:
        for path, text, _ in b.nodes:
            if text.strip():
                s = paths.setdefault(path, [0, 0, 0])
                s[0] += len(text.strip())
                s[1] += len(PUNCTUATION.findall(text))
                s[2] += 1
    lengths, points, unlinked = [], [], []
    for b in blocks:
        size = [(path, len(t.strip()), linked) for path, t, linked in b.nodes if t.strip()]
        total = sum(n for _, n, _ in size) or 1
        lengths.append(sum(n * paths[p][0] / paths[p][2] for p, n, _ in size) / total)
        points.append(sum(n * paths[p][1] / paths[p][2] for p, n, _ in size) / total)
        unlinked.append(1 - sum(n for _, n, linked in size if linked) / total)
    return [a * (0.1 + p) * u for a, p, u in
            zip(_smoothed(lengths), _smoothed(points), unlinked, strict=True)]


def main_text(html: str | None) -> str:
    """The article's text, its blocks in page order joined by an empty line."""
    blocks = blocks_of(html or "")
    if not blocks:
        return ""
    scores = content_scores(blocks)
    mean = sum(scores) / len(scores)
    spread = math.sqrt(sum((s - mean) ** 2 for s in scores) / len(scores))
    line = min(mean, spread) if len(blocks) > 1 else 0.0
    content = [s >= line for s in scores]

    held: dict[_Element, int] = {}
    for b, is_content in zip(blocks, content, strict=True):
        e = b.at
        while is_content and e is not None:
            held[e] = held.get(e, 0) + len(b.text)
            e = e.up
    total = max(held.values(), default=0)
    # The outermost named articles; else the innermost element with most content.
    regions = {e for e in held if e.article and not (e.up and e.up.article)}
    if not regions or sum(held[e] for e in regions) < 0.5 * total:
        depth = {e: sum(1 for _ in _chain(e)) for e in held}
        region = max((e for e in held if held[e] >= 0.8 * total), key=depth.__getitem__, default=None)
        while region is not None and region.tag in TEXT_BLOCKS:
            region = region.up
        regions = {region} if region is not None and region.tag not in ("#", "html", "body") else set()
    kept: list[str] = []
    next_kept = False
    for b, is_content in zip(reversed(blocks), reversed(content), strict=True):
        if is_content:
            keep = True
        elif any(e in regions for e in _chain(b.at)):
            keep = b.at.article or not (b.at.tag == "li" and _all_linked(b))
        elif b.at.tag in HEADINGS:
            keep = (b.at.tag == "h1" or next_kept) and not _all_linked(b) or not regions
        else:
            keep = not regions and b.at.tag in TEXT_BLOCKS and not (b.at.tag == "li" and _all_linked(b))
        next_kept = keep
        if keep:
            kept.append(b.text)
    return "\n\n".join(reversed(kept))


def _all_linked(b: _Block) -> bool:
    return all(linked or not t.strip() for _, t, linked in b.nodes)


def _chain(e: _Element | None):
    while e is not None:
        yield e
        e = e.up


def extract_main_text(pages: DataFrame, html_col: str = "html",
                      text_col: str = "text") -> DataFrame:
    """``pages`` without ``html_col``, with ``text_col`` and ``n_chars``."""
    def add(b):
        return pa.array([main_text(h.as_py()) for h in b.column(b.schema.get_field_index(html_col))],
                        pa.string())

    kept = [c for c in pages.columns if c not in (text_col, "n_chars")]
    return (with_column(pages.select(*kept), text_col, T.StringType(), add).drop(html_col)
            .withColumn("n_chars", F.char_length(text_col).cast("long")))
