"""HTML extraction (9): two-pass block rules.

A page's markup is cut into blocks at block-level tags.  The first pass decides a
block by link density, length and stop-word density; blocks in parts that the
page itself names as something else (menus, headers, footers, sidebars, notices,
adverts, forms, reader comments) are out at once.  The second pass gives short
and ambiguous blocks the label of their nearest decided neighbours: out if both
are out, in if the nearest one on either side is in.  If a page marks its article,
only blocks inside it can be in, and short blocks there are in.  With a ``main`` element the
article is in it, and an ``article`` inside an ``aside`` or the like counts only where there is no other.

A name in a class or id, and a form, put a part outside only while the part does not hold most of the text
that could be the article: one word of a compound class (``with-sidebar``) never deletes a page.

A page without a marked article in which known stop words are next to none (another
language) is decided by length and link density.  In other such pages, blocks of
low stop-word density (code, tables) are in if the nearest decided blocks of the
flow on both sides are in.

Defined results: NULL and empty pages give an empty text; unclosed and stray tags,
comments and references never end the extraction; NULL urls stay NULL; every row
gives one row; other columns of the table are not looked at.
"""

from __future__ import annotations

import html as html_entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.llm.shared import ship

ship(__name__)

MAX_LINK_DENSITY = 0.5
SHORT, LONG = 70, 200            # characters
FEW_LINKS = 0.25                 # link density of text in a language without known stop words
KNOWN_STOP = 0.05                # share of stop words in a page's letters below which its language is unknown
STOP_LOW, STOP_HIGH = 0.15, 0.30

# Frequent function words of four languages.
STOP_WORDS = frozenset("""
a an and are as at be been but by for from had has have he her his i in is it its not of on or she so that the their
they this to was we were which will with you
au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qui que
sa se ses son sur un une vous
aber als am auch auf aus bei bin das dass dem den der des die durch ein eine einem einen einer er es für hat ich im
ist mit nach nicht noch nur oder sein sich sie sind so und vom von vor war wie wir wird zu zum zur
al como con del el ella en entre era es esta este fue ha hay la las le lo los más me mi muy no o para pero por porque
que se ser si sin sobre son su sus también te tiene todo un una y ya
""".split())

# Element names.
RAW = frozenset(("script", "style", "noscript", "iframe", "title", "textarea"))  # raw text up to the end tag
#: Elements whose content is no text of the page; one without an end tag of its own is skipped as a tag only.
MUTE = frozenset(("template", "svg", "math", "object", "canvas", "head", "audio", "video", "select", "button", "datalist"))
OUTSIDE = frozenset(("nav", "footer", "aside", "form", "dialog", "menu"))
MAIN = frozenset(("article", "main"))
BLOCKS = frozenset(("address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl",
                    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
                    "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "section",
                    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"))
#: Elements whose end matters for what is inside them.
HOLDERS = frozenset(("article", "aside", "body", "details", "dialog", "div", "fieldset", "figure", "footer", "form", "header",
                     "main", "menu", "nav", "ol", "section", "table", "ul", "dl", "p", "span", "li", "td", "tr", "tbody")) | MUTE
# Words in class, id or role that name parts outside the article.
NAMES = frozenset("""
ad ads adsense advert advertisement advertising adverts banner sponsor sponsored promo promotion sidebar menu nav navbar
navigation breadcrumb breadcrumbs footer masthead topbar cookie cookies consent gdpr notice alert popup modal overlay
newsletter subscribe subscription signup login share sharing social related recommended recommendations pagination pager
search searchbox widget toolbar copyright disclaimer contentinfo complementary dialog
""".split())
COMMENT_NAMES = frozenset("comment comments commentlist reply replies discussion disqus respond responses".split())
HEADER_NAMES = frozenset(("header", "heading", "banner"))

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
                        |<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)>""", re.S | re.X)
#: Comments, raw elements, and start, end and empty tags of ``MUTE`` elements.
_MUTE_TAG = re.compile(rf"""<!--.*?(?:-->|\Z)|<({"|".join(sorted(RAW))})\b.*?(?:</\1\s*>|\Z)
                           |<(/?)({"|".join(sorted(MUTE))})(?![A-Za-z0-9:-])(?:[^<>]*+(?<=/)(>))?""", re.S | re.X | re.I)
_UNFINISHED = re.compile(r"<[A-Za-z/!?]")  # a tag that the page's end cuts off: nothing follows it
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_NAME = re.compile(r"[a-z]+(?:[0-9]+)?")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[^\W\d_]+")


def named(attributes: str) -> tuple[set[str], bool]:
    """Words in class, id and role, and whether the element is hidden."""
    words: set[str] = set()
    hidden = False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "style":
            hidden = hidden or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
        elif name == "hidden" or name == "aria-hidden":
            hidden = hidden or name == "hidden" or value.lower() == "true"
        else:
            words.update(_NAME.findall(_CAMEL.sub(" ", value).lower()))
    return words, hidden


def closed(page: str) -> set[int]:
    """Where the ``MUTE`` elements start that have an end tag of their own."""
    open_: dict[str, list[int]] = {}
    out: set[int] = set()
    for m in _MUTE_TAG.finditer(page):
        if m[3] and not m[4]:
            starts = open_.setdefault(m[3].lower(), [])
            if not m[2]:
                starts.append(m.start())
            elif starts:
                out.add(starts.pop())
    return out


class Blocks:
    """Blocks of a page: (text, characters inside links, outside?, inside the article?).

    While the page is read, a block also has a rank (0, inside an article that lies in an outside part 1, inside an
    article 2, inside ``main`` 3) and the numbers of the parts around it that are named as outside.
    """

    def __init__(self, page: str):
        self.found: list[tuple[str, int, bool, bool, int, tuple[int, ...]]] = []
        self.parts = 0
        self.text: list[str] = []
        self.linked = self.links = self.breaks = 0
        #: open holders: (name, out of the article: 0 no, 1 yes, 2 reader comments; inside the article;
        #: without text: 0 no, 1 yes, 2 also if an article starts; rank; named parts)
        self.open: list[tuple[str, int, bool, int, int, tuple[int, ...]]] = [("", 0, False, 0, 0, ())]
        #: open blocks inside a mute element that are no holders
        self.inner: list[str] = []
        mute: set[int] | None = None
        #: how many holders of a name are open
        self.count: dict[str, int] = {}
        at, last = 0, max(page.rfind(">"), page.rfind("<!--"))
        while at <= last and (m := _TOKEN.search(page, at)):
            self.add(page[at:m.start()])
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
            if name in RAW and not closing:
                if not attributes.endswith("/"):
                    at = re.compile(rf"</{name}\s*>|\Z", re.I).search(page, at).end()
            elif name in MUTE and not closing:
                mute = closed(page) if mute is None else mute
                if m.start() in mute:
                    self.mute(name)
            elif closing:
                self.end(name)
            else:
                self.start(name, attributes)
        self.add(_UNFINISHED.split(page[at:], maxsplit=1)[0])
        self.flush()
        self.out = self.resolved()

    def resolved(self) -> list[tuple[str, int, bool, bool]]:
        """The blocks, with named parts outside that hold at most half of the plain text that could be the article."""
        best = max((rank for _, _, outside, _, rank, _ in self.found if not outside), default=0)
        held: dict[int, int] = {}
        total = 0
        for text, linked, outside, _, rank, parts in self.found:
            if not outside and rank == best:
                plain = max(0, len("".join(text.split())) - linked)
                total += plain
                for part in parts:
                    held[part] = held.get(part, 0) + plain
        kept = {part for part, plain in held.items() if 2 * plain > total}
        return [(text, linked, outside or any(x not in kept for x in parts), inside and rank == best)
                for text, linked, outside, inside, rank, parts in self.found]

    def add(self, raw: str) -> None:
        if not raw or self.open[-1][3]:
            return
        text = html_entities.unescape(raw)
        if text.strip():
            self.breaks = 0
        self.text.append(text)
        if self.links:
            self.linked += len("".join(text.split()))

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            _, outside, inside, _, rank, parts = self.open[-1]
            self.found.append((text, self.linked, bool(outside), inside, rank, parts))
        self.text, self.linked, self.breaks = [], 0, 0

    def push(self, name: str, outside: int, inside: bool, mute: int, rank: int, parts: tuple[int, ...]) -> None:
        self.open.append((name, outside, inside, mute, rank, parts))
        self.count[name] = self.count.get(name, 0) + 1

    def cut(self, k: int) -> None:
        for gone, *_ in self.open[k:]:
            self.count[gone] -= 1
        del self.open[k:]

    def mute(self, name: str) -> None:
        _, outside, inside, mute, rank, parts = self.open[-1]
        if not mute:
            self.inner = []
        self.push(name, outside, inside, max(mute, 2 if name == "template" else 1), rank, parts)

    def unmute(self) -> None:
        self.cut(next(k for k, x in enumerate(self.open) if x[3]))

    def start(self, name: str, attributes: str) -> None:
        _, outside, inside, mute, rank, parts = self.open[-1]
        if mute == 1 and (name == "body" or name in MAIN and outside < 2):
            self.unmute()  # the element was left open
        elif mute:
            if name in HOLDERS and not attributes.endswith("/"):
                self.push(name, outside, inside, mute, rank, parts)
            elif name in BLOCKS and name != "hr":
                self.inner.append(name)
            return
        if name == "br":
            self.breaks += 1
            self.text.append(" ")
            if self.breaks == 2:
                self.flush()
            return
        if name == "a":
            self.links += 1
        if name in BLOCKS:
            self.flush()
            self.links = 0
        if name == "p" and self.open[-1][0] == "p":
            self.open.pop()
            self.count["p"] -= 1
        if name not in HOLDERS or attributes.endswith("/"):
            return
        _, outside, inside, _, rank, parts = self.open[-1]
        words, hidden = named(attributes)
        if words & COMMENT_NAMES:
            outside = 2
        elif name in MAIN and outside < 2:
            # an article is one, whatever was left open before it
            rank = max(rank, 3 if name == "main" else 1 if outside else 2)
            outside, inside, parts = 0, True, ()
        if name in OUTSIDE and name != "form" or hidden or not inside and name == "header":
            outside = max(outside, 1)
        elif name == "form" or name not in MAIN and name != "body" and words & (NAMES - HEADER_NAMES if inside else NAMES | HEADER_NAMES):
            self.parts += 1
            parts = (*parts, self.parts)
        self.push(name, outside, inside, 0, rank, parts)

    def end(self, name: str) -> None:
        if self.open[-1][3]:
            if name in HOLDERS:
                self.close(name)
            elif name in self.inner:
                self.inner.remove(name)
            elif name in BLOCKS:
                self.unmute()  # the block around it ends
            if name in BLOCKS and not self.open[-1][3]:
                self.flush()
                self.links = 0
            return
        if name == "a":
            self.links = max(0, self.links - 1)
        if name in BLOCKS:
            self.flush()
        if name in HOLDERS:
            self.close(name)

    def close(self, name: str) -> None:
        if self.count.get(name):
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k][0] == name:
                    self.cut(k)
                    break
                if self.open[k][0] in MAIN and name not in MAIN and name not in ("body", "html"):
                    break  # a stray end tag doesn't end the article


def _width(text: str) -> int:
    """Characters; those of East Asian scripts count twice."""
    return len(text) + sum(c >= "\u2e80" for c in text)


def known_language(blocks: list[tuple[str, int, bool, bool]]) -> bool:
    """Whether the text outside named parts and link lists has stop words of the four languages."""
    stop = letters = 0
    for text, linked, outside, _ in blocks:
        if not outside and linked <= MAX_LINK_DENSITY * len("".join(text.split())):
            for w in _WORD.findall(text.lower()):
                n = _width(w)
                letters += n
                stop += n if w in STOP_WORDS else 0
    return stop >= KNOWN_STOP * letters


def between(labels: list[bool | None], low: list[bool], flow: list[bool]) -> list[bool]:
    """Blocks of ``low`` whose nearest decided blocks of the flow on both sides, other low ones aside, are in."""
    def near(order) -> dict[int, bool]:
        out, last = {}, False
        for i in order:
            if low[i]:
                out[i] = last
            elif flow[i] and labels[i] is not None:
                last = labels[i]
        return out

    ahead, after = near(range(len(labels))), near(range(len(labels) - 1, -1, -1))
    return [low[i] and ahead[i] and after[i] for i in range(len(labels))]


def first_pass(text: str, linked: int, outside: bool, inside: bool, article: bool, known: bool = True) -> bool | None:
    """In, out or undecided; ``known``: the page is in a language with known stop words."""
    if outside or article and not inside:
        return False
    chars = max(1, len("".join(text.split())))
    if linked / chars > MAX_LINK_DENSITY:
        return False
    if (len(text) if known else _width(text)) < SHORT:
        return None
    words = _WORD.findall(text.lower())
    stop = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if stop >= STOP_HIGH or stop >= STOP_LOW and len(text) > LONG:
        return True
    if inside or stop >= STOP_LOW:
        return None
    if known:
        return False
    return True if linked / chars <= FEW_LINKS else None


def main_text(page: str | None) -> str:
    """The article of a page, a line for each block."""
    if not page:
        return ""
    blocks = Blocks(page).out
    article = any(inside and not outside for _, _, outside, inside in blocks)
    known = article or known_language(blocks)
    labels = [first_pass(*b, article, known) for b in blocks]
    if not article and True in labels:
        flow = [not outside for _, _, outside, _ in blocks]
        low = [x is False and here and linked <= MAX_LINK_DENSITY * len("".join(text.split()))
               for x, here, (text, linked, _, _) in zip(labels, flow, blocks)]
        labels = [True if kept else x for x, kept in zip(labels, between(labels, low, flow))]
    own = [inside or not article for _, _, _, inside in blocks]
    ahead: list[bool | None] = []
    last: bool | None = None
    for label, here in zip(labels, own):
        ahead.append(last)
        if label is not None and here:
            last = label
    last = None
    out = []
    for i in range(len(blocks) - 1, -1, -1):
        label = labels[i]
        if label is None:
            found = [x for x in (ahead[i], last) if x is not None]
            label = blocks[i][3] or any(found)
        if labels[i] is not None and own[i]:
            last = labels[i]
        if label:
            out.append(blocks[i][0])
    return "\n".join(reversed(out))


def _extract(batches):
    for batch in batches:
        texts = [main_text(x) for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page."""
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).alias("html")).mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
