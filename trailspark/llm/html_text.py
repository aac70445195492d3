"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Pass one classifies every block
on its own: blocks inside navigation, headers, footers, sidebars, forms and
other furniture (by tag, role, class or id) are boilerplate, and so are blocks
of links; long blocks with many stop words, and the blocks of an article or
main element (where a page has none, of elements named so by class or id), are
main text; long blocks without stop words outside it are
boilerplate; short blocks stay ambiguous. In pass two an ambiguous block
inherits the label of its nearest decided neighbours, good only if both sides
agree; a heading inherits from the block below it.

What markup says comes first where it says anything; the rules of the two passes
decide the other blocks. ``marks`` takes either kind of markup out of the
decision, so that the rules can be measured against it on the same pages.

Defined results: a null or empty page has the text ""; an unclosed element
ends with its parent; repeated rows give equal texts; an empty table gives an
empty result; input columns may have any names.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame

from .common import map_rows

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>",
    re.DOTALL)
ATTRIBUTE = re.compile(
    r"""(?<![\w-])(class|id|role|hidden|aria-hidden|itemprop|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""",
    re.IGNORECASE)

#: Elements by how a page reader treats them.
SILENT = frozenset("script style noscript template svg math iframe object canvas audio video head "
                   "title select textarea".split())
RAW = frozenset("script style textarea title noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
FURNITURE = frozenset("nav header footer aside form button menu dialog fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar "
                  "dialog alert alertdialog toolbar".split())
MAIN = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEMS = frozenset("p li td th tr dt dd".split())
#: Words of class and id names that mark furniture (stems first, then whole words).
MARKS = re.compile(
    r"(?:^|[\s_-])(?:(?:navbar|breadcrumb|sidebar|footer|menu|cookie|comment|advert|newsletter|widget|"
    r"sponsor|disqus|subscri|pagination|adsbygoogle|masthead)\w*|"
    r"(?:nav|navigation|header|foot|side|aside|ads?|promo|promotion|banner|consent|gdpr|notices?|"
    r"alert|popup|modal|overlay|signup|login|replies|reply|respond|discussion|share|sharing|social|"
    r"related|recommended|recommendations|pager|toolbar|topbar|tags|tagcloud|skip|search|copyright|"
    r"colophon|legal|disclaimer|form)(?:$|[\s_\d-]))", re.IGNORECASE)
#: The same on an article or main element, whose names often tell of its parts.
MARKS_OF_MAIN = re.compile(
    r"(?:^|\s)(?:ads?|adverts?|sponsored|promo|related|teaser|reply|"
    r"comment(?!s?-(?:open|closed|status)))(?:$|[\s_\d-])", re.IGNORECASE)
MAIN_ELEMENT = re.compile(r"<(?:article|main)[\s>]|role=[\"']?(?:main|article)\b", re.IGNORECASE)
#: Names of the main part, for pages without an article or main element.
MAIN_MARKS = re.compile(
    r"(?:^|\s)(?:(?:main|page|site|post|entry|article|story)[_-]?)?"
    r"(?:article|post|entry|story|content|main|body|text)(?:$|\s)", re.IGNORECASE)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: Layout names that only say which parts a page has.
LAYOUT = re.compile(r"\b(?:has|with|no|without|hide|show)[_-]\w+", re.IGNORECASE)
STOP_WORDS = frozenset(
    "the of and to in is that was for it with as by on are this from at be or an have not a "
    "der die das und ist von zu den mit im sich auf für dem nicht ein eine des auch "
    "de la le et les des en un une du que est pour dans sur avec pas par qui au "
    "el los las y se del por con para una su al lo como más".split())

LONG, STOP_DENSITY, LINK_DENSITY, ONLY_LINKS = 70, 0.15, 0.33, 0.9
GOOD, BAD, SHORT = "good", "bad", "short"
#: Markup that decides: elements and names of furniture, and of the main part.
MARKUP = ("furniture", "main")


@dataclass
class Block:
    text: list[str] = field(default_factory=list)
    linked: int = 0
    furniture: bool = False
    article: bool = False
    heading: bool = False


def _names(attributes: str) -> list[tuple[str, str]]:
    return [(m[1].lower(), (m[2] or "").strip("\"'")) for m in ATTRIBUTE.finditer(attributes)]


def _furniture(tag: str, names: list[tuple[str, str]], in_article: bool) -> bool:
    if tag in FURNITURE and not (tag == "header" and in_article):
        return True
    marks = MARKS_OF_MAIN if tag in MAIN else MARKS
    for name, value in names:
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if (name in ("class", "id", "itemprop") and tag not in ("body", "html")
                and marks.search(LAYOUT.sub("", CAMEL.sub("-", value)))
                and not (in_article and re.fullmatch(r"[\w-]*header", value, re.IGNORECASE))):
            return True
    return False


def _main(tag: str, names: list[tuple[str, str]], by_name: bool) -> bool:
    """Whether an element is the page's main part; ``by_name``: class and id say so, too."""
    if tag in MAIN or any(
            (n, v.lower()) in (("role", "main"), ("role", "article"), ("itemprop", "articlebody"))
            for n, v in names):
        return True
    return by_name and tag not in INLINE and tag not in ("body", "html") and any(
        n in ("class", "id") and MAIN_MARKS.search(v) for n, v in names)


class Open(NamedTuple):
    """An open element."""

    tag: str
    furniture: bool
    main: bool
    mute: bool


class Path:
    """The open elements, with counts of what they are, so a step costs the same at any depth."""

    def __init__(self) -> None:
        self.open: list[Open] = []
        self.tags: Counter[str] = Counter()
        self.furniture = self.main = self.mute = 0

    def _count(self, x: Open, by: int) -> None:
        self.tags[x.tag] += by
        self.furniture += by * x.furniture
        self.main += by * x.main
        self.mute += by * x.mute

    def push(self, x: Open) -> None:
        self.open.append(x)
        self._count(x, 1)

    def pop(self) -> Open:
        x = self.open.pop()
        self._count(x, -1)
        return x

    def end(self, tag: str) -> None:
        """The end tag of ``tag`` ends what is open inside it, too; a stray one ends nothing."""
        if self.tags[tag]:
            while self.pop().tag != tag:
                pass

    def end_sibling(self, tag: str) -> None:
        """A new item ends an open one unless another container stands between."""
        if not self.tags[tag]:
            return
        for x in reversed(self.open):
            if x.tag == tag:
                self.end(tag)
                return
            if x.tag not in INLINE and (x.tag not in ITEMS or x.tag == "li"):
                return

    def block(self) -> Block:
        return Block(furniture=self.furniture > 0, article=self.main > 0,
                     heading=any(self.tags[h] for h in HEADINGS))


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order, cut at block-level tags."""
    done: list[Block] = []
    path, now, at = Path(), Block(), 0
    by_name = not MAIN_ELEMENT.search(page)

    def close() -> None:
        nonlocal now
        if "".join(now.text).strip():
            done.append(now)
        now = path.block()

    def say(text: str) -> None:
        if text and not path.mute:
            text = html.unescape(text)
            now.text.append(text)
            if path.tags["a"]:
                now.linked += len("".join(text.split()))

    while m := TOKEN.search(page, at):
        say(page[at:m.start()])
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                say(html.escape(m[0][9:-3]))
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in VOID:
            if tag == "br":
                say(" ")
            elif tag == "hr":
                close()
            continue
        block = tag not in INLINE
        if closing:
            path.end(tag)
            if block:
                close()
            continue
        if m[3].endswith("/") and tag in SILENT:
            continue
        if tag in ITEMS:
            path.end_sibling(tag)
        names = _names(m[3]) if m[3] else []
        furniture = _furniture(tag, names, path.main > 0)
        path.push(Open(tag, furniture, _main(tag, names, by_name),
                       tag in SILENT or furniture and not block))
        if block:
            close()
        if tag in RAW:  # no markup inside: jump to its end
            end = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
            at = end.start() if end else len(page)
    say(page[at:])
    close()
    return done


def labelled(page: str | None, marks: tuple[str, ...] = MARKUP) -> list[tuple[str, str]]:
    """``(text, label)`` of a page's blocks, white space folded."""
    found = []
    for b in blocks(page or ""):
        text = " ".join("".join(b.text).split())
        b.furniture &= "furniture" in marks
        b.article &= "main" in marks
        found.append((b, text, _alone(b, text)))
    labels = [x for *_, x in found]
    before, after = _nearest(labels), _nearest(labels[::-1])[::-1]
    out = []
    for (b, text, label), above, below in zip(found, before, after, strict=True):
        if label == SHORT:
            label = below if b.heading else (GOOD if above == below == GOOD else BAD)
        out.append((text, label))
    return out


def main_text(page: str | None) -> str:
    """Main blocks of a page, joined by line feeds."""
    return "\n".join(text for text, label in labelled(page) if label == GOOD)


def _nearest(labels: list[str]) -> list[str]:
    """Per place the last decided label up to it (the page's edge counts as boilerplate)."""
    out, last = [], BAD
    for x in labels:
        last = last if x == SHORT else x
        out.append(last)
    return out


def _alone(b: Block, text: str) -> str:
    """Pass one: the label of a block by itself."""
    if b.furniture:
        return BAD
    links = b.linked / max(1, len(text.replace(" ", "")))
    if b.article:  # a block that is nothing but links is a menu there, too
        return BAD if links > ONLY_LINKS else GOOD
    if links > LINK_DENSITY:
        return BAD
    if len(text) < LONG:
        return SHORT
    w = text.lower().split()
    return GOOD if sum(x.strip(".,;:!?") in STOP_WORDS for x in w) >= STOP_DENSITY * len(w) else BAD


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url",
            page: str = "html") -> DataFrame:
    """Per row: ``page_id, url, text, n_chars``."""

    def run(rows: dict[str, list]) -> dict[str, list]:
        texts = [main_text(p) for p in rows["html"]]
        return {"page_id": rows["page_id"], "url": rows["url"], "text": texts,
                "n_chars": [len(t) for t in texts]}

    picked = pages.select(pages[f"`{page_id}`"].alias("page_id"), pages[f"`{url}`"].alias("url"),
                          pages[f"`{page}`"].alias("html"))
    kind = dict(picked.dtypes)["page_id"]
    return map_rows(picked, run, f"page_id {kind}, url string, text string, n_chars long")
