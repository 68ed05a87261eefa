"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  Scripts, styles, comments and
other unseen parts never become text.  The first pass decides each block:

- parts of menus, site headers, footers, sidebars, forms, notices, adverts and
  reader comments (by element, role, or whole names of class or id) are rejected;
- blocks that are mostly link text are rejected;
- long blocks rich in stop words are accepted; on pages in a language without
  listed stop words, long blocks are accepted by their length;
- an article (else main) element that holds most of the unmarked text is a
  further sign: blocks inside it are accepted, short and middling ones outside
  rejected;
- other blocks stay undecided.

The second pass lets undecided blocks inherit the label of their nearest
decided neighbours; longer ones ask unmarked neighbours only.  Accepted blocks
are joined in page order.

Defined cases: null or empty html gives an empty text; markup without a close
runs to the end of the page; pages of any length are read whole; repeated rows
are done one by one; null ids and urls pass through; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerline.llm.bpe import slices
from ledgerline.llm.common import col

# Elements that hold no visible text, or whose content is no markup.
RAW = {"script", "style", "title", "textarea", "iframe", "noscript", "noembed", "noframes", "xmp", "template", "svg", "math",
       "object", "canvas", "audio", "video", "head"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir",
         "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
         "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre",
         "search", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
# Elements, roles and words of class and id that mark boilerplate.  The firm ones hold even around an article.
FIRM = {"aside", "footer", "dialog", "complementary", "contentinfo", "alert", "alertdialog", "ad", "ads", "adsense", "adbox",
        "sidebar", "related", "recommended", "recommendations", "promo", "promoted", "outbrain", "taboola", "disqus",
        "replies", "respond"}
FIRM_START = ("advert", "sponsor", "comment", "cookie", "consent")
SOFT = {"nav", "menu", "form", "button", "select", "option", "optgroup", "search", "navigation", "banner", "header", "navbar",
        "topbar", "toolbar", "masthead", "breadcrumb", "breadcrumbs", "pagination", "pager", "notice", "notices", "popup",
        "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social",
        "gdpr", "widget", "skip", "copyright", "legal", "disclaimer"}
# Words that say where a marked part is or what holds it, not what it is.
PLACE = {"site", "page", "global", "top", "bottom", "left", "right", "primary", "secondary", "main", "box", "container", "wrapper",
         "wrap", "list", "section", "block", "area", "inner", "outer", "bar", "links", "link", "item", "items", "menu", "posts",
         "articles", "stories", "buttons", "icons", "text", "slot", "unit", "col", "column", "row", "form", "media", "user", "reader", "google",
         "thread", "threads", "feed", "count", "body", "content"}
# Function words of English, German, French and Spanish.
STOP_WORDS = frozenset("""
a an and are as at be been but by for from had has have he her his if in into is it its not of on or she so than that the
their them then there these they this to was we were what when which who will with would you your
aber als am an auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat ich im in ist
man mit nach nicht noch nur oder sich sie sind so über um und von vor war wie wird zu zum zur
au aux avec ce ces cette comme dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas pour
plus qui que sa se ses son sont sur un une vous
al como con de del el ella en entre era es esta este ha la las lo los más me muy no o para pero por que se ser si sin
sobre son su sus también un una uno y ya
""".split())

SHORT = 70          # characters under which a block is not decided by its words
LONG = 200          # characters from which a block rich in stop words is accepted
STOP_LOW, STOP_HIGH = 0.15, 0.25  # shares of stop words: of a page in a listed language, of an accepted block
LINKS_HIGH = 0.5

CUE_WORDS = re.compile("[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>""")
WORD = re.compile(r"[^\W\d_]+")
NONE, MILD, HARD = 0, 1, 2
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


def boilerplate(name: str, attributes: str) -> int:
    """How firmly an element is marked as boilerplate.

    A class or id counts if it is a cue as a whole (``side-bar``), or if all of
    its words are cues or say where something is; only such single words match
    by their start, so ``comment-list`` is a mark and ``comment-on-policy`` is not.
    """
    cues, starts = {name}, set()
    if attributes:
        for key, a, b, c in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), a or b or c
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true" \
                    or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return HARD
            if key == "role":
                cues.add(value.lower())
                starts.add(value.lower())
            elif key in ("class", "id"):
                for token in value.split():
                    words = {w.lower() for w in CUE_WORDS.findall(token) if len(w) > 1}
                    cues.add("".join(re.findall("[a-z]+", token.lower())))
                    if all(w in FIRM or w in SOFT or w in PLACE or w.startswith(FIRM_START) for w in words):
                        cues |= words - PLACE | words & SOFT
                        starts |= words
    if name in ("html", "body", "main") or name in HEADINGS:
        return NONE
    if cues & FIRM or any(c.startswith(FIRM_START) and c != "commentary" for c in starts):
        return HARD
    return MILD if name != "article" and cues & SOFT else NONE


class Block:
    __slots__ = ("text", "in_link", "marked", "in_article", "in_main", "label")

    def __init__(self, text: str, in_link: int, marked: int, in_article: bool, in_main: bool):
        self.text, self.in_link, self.marked = text, in_link, marked
        self.in_article, self.in_main, self.label = in_article, in_main, None


def blocks(html: str) -> list[Block]:
    """Text blocks in page order."""
    out: list[Block] = []
    stack: list[tuple[str, int, bool, bool]] = []  # name, boilerplate so far, in an article, in main
    opened: dict[str, int] = {}
    text, in_link, links = [], 0, 0
    at, n = 0, len(html)

    def end_block():
        nonlocal text, in_link
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                _, marked, article, main = stack[-1] if stack else ("", NONE, False, False)
                out.append(Block(joined, in_link, marked, article, main))
            text, in_link = [], 0

    def add(piece: str):
        nonlocal in_link
        if "&" in piece:
            piece = unescape(piece)
        text.append(piece)
        if links:
            in_link += len(" ".join(piece.split()))

    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            add(html[at:])
            break
        if lt > at:
            add(html[at:lt])
        nxt = html[lt + 1:lt + 2]
        if nxt in ("!", "?"):
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            else:
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            continue
        m = TAG.match(html, lt)
        if m is None:
            if nxt == "/" or nxt.isalpha():  # a tag that is cut off, or has an open quote
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                add("<")
                at = lt + 1
            continue
        at = m.end()
        closing, name = m[1], m[2].lower()
        if closing:
            if name in BLOCK:
                end_block()
            if opened.get(name):
                while True:
                    top = stack.pop()[0]
                    opened[top] -= 1
                    links -= top == "a"
                    if top == name:
                        break
            continue
        if name in RAW and not m[3].endswith("/"):
            close = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>?", re.I).search(html, at)
            if name == "head":  # an unclosed head ends with the body
                body = re.compile("</head(?=[\\s/>])[^>]*>?|(?=<body[\\s/>])", re.I).search(html, at)
                if body is None:
                    continue
                close = body
            at = n if close is None else close.end()
            continue
        if name == "br":
            text.append(" ")
        if name in BLOCK:
            end_block()
        if name in VOID or m[3].endswith("/") and name not in BLOCK:
            continue
        if name in ("p", "li", "a", "option", "td", "th", "tr", "dt", "dd") and stack and stack[-1][0] == name:
            top = stack.pop()[0]  # these do not nest in themselves
            opened[top] -= 1
            links -= top == "a"
        _, marked, article, main = stack[-1] if stack else ("", NONE, False, False)
        own = boilerplate(name, m[3])
        if name == "article" or name == "main":
            marked = HARD if HARD in (marked, own) else NONE
            article, main = article or name == "article", main or name == "main"
        elif name == "header" and article and own == MILD:
            pass  # an article's own header has its title
        else:
            marked = max(marked, own)
        stack.append((name, marked, article, main))
        opened[name] = opened.get(name, 0) + 1
        links += name == "a"
    end_block()
    return out


def stop_share(texts: list[str]) -> float:
    words = [w for t in texts for w in WORD.findall(t.lower())]
    return sum(w in STOP_WORDS for w in words) / max(len(words), 1)


def first_pass(found: list[Block]) -> None:
    """Decide blocks by marks, links, length, stop words and the article's bounds; None: undecided."""
    usable = [b for b in found if not b.marked and b.in_link <= LINKS_HIGH * len(b.text)]
    total = sum(len(b.text) for b in usable)
    where = next((w for w in ("in_article", "in_main") if 2 * sum(len(b.text) for b in usable if getattr(b, w)) > total), None)
    listed = stop_share([b.text for b in usable if len(b.text) >= SHORT]) >= STOP_LOW
    for b in found:
        n = len(b.text)
        if b.marked or b.in_link > LINKS_HIGH * n:
            b.label = False
        elif n >= LONG and (not listed or stop_share([b.text]) >= STOP_HIGH):
            b.label = True
        elif where:
            b.label = False if not getattr(b, where) else True if n >= SHORT or not b.in_link else None
        elif n < SHORT:
            b.label = False if b.in_link else None
    # A page without one long block is judged by what is left of it.
    if not where and not any(b.label for b in found):
        for b in found:
            b.label = b.label is None


def second_pass(found: list[Block]) -> None:
    """Undecided blocks take the label of their nearest decided neighbours; where the two differ, the nearer
    one's, and at equal distance they are accepted.  For blocks that are not short, marked parts of the page
    and link lists are no neighbours."""
    n = len(found)

    def nearest(order, counts):
        last, out = None, [None] * n
        for i in order:
            last = (i, found[i].label) if counts(found[i]) else last
            out[i] = last
        return out

    def decided(b):
        return b.label is not None

    def unmarked(b):
        return b.label is not None and not b.marked and not b.in_link

    sides_of = {f: (nearest(range(n), f), nearest(range(n - 1, -1, -1), f)) for f in (decided, unmarked)}
    for i, b in enumerate(found):
        if b.label is None:
            sides = [(abs(i - s[0]), not s[1]) for s in (x[i] for x in sides_of[decided if len(b.text) < SHORT else unmarked]) if s]
            b.label = not min(sides)[1] if sides else True


def main_text(html: str | None) -> str:
    found = blocks(html or "")
    first_pass(found)
    second_pass(found)
    return " ".join(b.text for b in found if b.label)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, ``text`` and ``n_chars`` (code points) of every page."""
    src = pages.select(col(id_col).alias("id"), col(url_col).alias("url"), col(html_col).cast("string").alias("html"))
    schema = T.StructType([T.StructField(id_col, src.schema["id"].dataType), T.StructField(url_col, src.schema["url"].dataType),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rows in slices(batch.column(2)):
                texts = [main_text(h) for h in rows]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(rows)), batch.column(1).slice(at, len(rows)),
                                                  pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names)

    return src.mapInArrow(run, schema)
