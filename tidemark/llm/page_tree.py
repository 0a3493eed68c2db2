"""One page of HTML as a row of blocks and a row of template tokens; small helpers of ``page_template``.

Reading is forgiving: unclosed paragraphs and list items end where browsers end them, stray end tags are passed over, and
what cannot be a tag is text. A block is the text between two starts or ends of block elements.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass

import xxhash

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: numbers in ids count pages or articles, as do long ones in class names; shorter ones name boxes
_DIGITS, _LONG = re.compile(r"\d+"), re.compile(r"\d{3,}")

# Fixed values of HTML: how elements nest and show.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre search "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
_CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_CLOSES |= {part: {"tbody", "thead", "tfoot", "tr", "td", "th"} for part in ("tbody", "thead", "tfoot")}
_BOXES = frozenset("html body div section center article main td".split())
_STOPS = frozenset("ul ol dl table select menu".split())
# Elements, roles and names of what is not the article.
_NEVER = frozenset(
    "nav footer aside form script style noscript template iframe svg math button select textarea dialog menu head title "
    "object canvas audio video datalist fieldset search".split()
)
_ROLES = frozenset("navigation contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tooltip banner".split())
_SURE = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored comment comments commentlist disqus replies "
    "respond cookie cookies consent gdpr newsletter popup modal breadcrumb breadcrumbs pagination share sharing".split()
)
_LIKELY = frozenset(
    "sidebar aside nav navbar navigation menu menus header masthead footer banner promo promotion notice notices alert overlay "
    "subscribe signup login search related recommended social toolbar widget widgets skip discussion hidden".split()
)
_FRAMES = frozenset("with without has no wrapper wrap container content main article layout page post entry body".split())


class Element:
    """An open element: its role (a hash of its path), whether it is outside any article, and its place among elements."""

    __slots__ = ("tag", "role", "skip", "region", "number", "children", "block")

    def __init__(self, tag: str, role: int, skip: bool, region: str, number: int):
        self.tag, self.role, self.skip, self.region, self.number = tag, role, skip, region, number
        self.children: dict[str, int] = {}
        self.block = tag in _BLOCKS


@dataclass(slots=True)
class Block:
    text: str
    links: int
    skip: bool
    token: int
    #: (role, number) of the boxes around it, outermost first; paragraphs, items and the like are none
    around: tuple[tuple[int, int], ...]
    #: number of the ``article`` or ``main`` around it, and which of them it is
    region: tuple[str, int]
    #: number of the list it is an item of, or -1
    list_number: int


_ROLE_OF: dict[tuple, int] = {}


def _role(parent: int, tag: str, name: str, at: int) -> int:
    key = (parent, tag, name, at)
    found = _ROLE_OF.get(key)
    if found is None:
        if len(_ROLE_OF) > 200_000:
            _ROLE_OF.clear()
        found = _ROLE_OF[key] = xxhash.xxh64_intdigest(f"{parent}/{tag}.{name}#{at}") >> 1
    return found


def _attributes(written: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(written):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def _unwanted(tag: str, attributes: dict[str, str], inside: str) -> bool:
    """Whether an element is no part of an article by its tag, role or names; ``inside``: the region around it."""
    if tag in _NEVER or (tag == "header" and not inside):
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", ""):
        return True
    role = attributes.get("role", "").lower()
    if role in _ROLES and not (role == "banner" and inside):
        return True
    names = {w.lower() for w in _WORD.findall(attributes.get("class", "") + " " + attributes.get("id", ""))}
    if names & _SURE:
        return True
    likely = names & _LIKELY
    return bool(likely) and not names & _FRAMES and not (inside and likely <= {"header"})


class Page:
    """The blocks of a page, and its tokens: (token, is text), in their order."""

    def __init__(self, html: str):
        self.blocks: list[Block] = []
        self.tokens: list[tuple[int, bool]] = []
        self._open = [Element("", 0, False, "", 0)]
        self._numbers = 0
        self._pieces: list[str] = []
        self._links = 0
        self._read(html)
        self._flush()

    def _read(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            found = _MARKUP.search(html, at)
            begin = found.start() if found else end
            if begin > at:
                self._text(html[at:begin])
            if not found:
                return
            at = found.end()
            name = found[2] or found[5]
            if name is None:
                if found[0].startswith("<![CDATA["):
                    self._text(found[0][9:].removesuffix("]]>"), decode=False)
                continue
            tag = name.lower()
            if found[1] or found[4]:
                self._close(tag)
                continue
            written = found[3] or found[6] or ""
            self._start(tag, written)
            if tag in _RAW:
                closing = re.compile(f"</{tag}[^a-z0-9]", re.I).search(html, at)
                at = closing.start() if closing else end

    def _text(self, text: str, decode: bool = True) -> None:
        top = self._open[-1]
        if top.tag in _RAW or top.skip and not text.strip():
            return
        if decode and "&" in text:
            text = entities.unescape(text)
        if top.skip and not self._skips_block():
            return  # a button or the like inside a paragraph
        self._pieces.append(text)
        if any(e.tag == "a" for e in self._open):
            self._links += len(text)

    def _skips_block(self) -> bool:
        """Whether the block itself is skipped, and not only an inline part of it."""
        for element in reversed(self._open):
            if element.block:
                return element.skip
        return False

    def _flush(self) -> None:
        if self._pieces:
            text = " ".join("".join(self._pieces).split())
            if text:
                around = [e for e in self._open if e.block]
                top = around[-1] if around else self._open[0]
                token = xxhash.xxh64_intdigest(f"{top.role}={text}") >> 1
                region = next(((e.region, e.number) for e in around if e.tag in ("article", "main") and e.region == top.region), ("", 0))
                lists = [e.number for e in around if e.tag in ("ul", "ol", "menu", "dir")]
                self.tokens.append((token, True))
                self.blocks.append(
                    Block(text, self._links, top.skip, token, tuple((e.role, e.number) for e in around if e.tag in _BOXES), region, lists[-1] if lists else -1)
                )
            self._pieces.clear()
        self._links = 0

    def _start(self, tag: str, written: str) -> None:
        if tag == "br":
            self._pieces.append(" ")
            return
        if tag in _BLOCKS:
            self._flush()
            if tag not in ("td", "th", "tr", "option"):
                self._end_paragraph()
            for at in range(len(self._open) - 1, 0, -1):
                open_tag = self._open[at].tag
                if open_tag in _CLOSES.get(tag, ()):
                    del self._open[at:]
                elif open_tag in _STOPS or open_tag in ("div", "section", "article"):
                    break
        if tag in _VOID:
            return
        parent = self._open[-1]
        attributes = _attributes(written) if written.strip() else {}
        name = _LONG.sub("#", attributes.get("class", "")) + "," + _DIGITS.sub("#", attributes.get("id", "")) if attributes else ","
        at = 0
        if name == "," and tag in ("div", "section", "table", "td"):
            at = parent.children.get(tag, 0)  # nothing else tells such siblings apart
            parent.children[tag] = at + 1
        inside = parent.region
        region = tag if tag in ("article", "main") and inside != "article" else inside
        self._numbers += 1
        skip = parent.skip or _unwanted(tag, attributes, inside)
        element = Element(tag, _role(parent.role, tag, name, at), skip, region, self._numbers)
        self.tokens.append((element.role, False))
        self._open.append(element)

    def _end_paragraph(self) -> None:
        for at in range(len(self._open) - 1, 0, -1):
            if self._open[at].tag == "p":
                del self._open[at:]
                return
            if self._open[at].block:
                return

    def _close(self, tag: str) -> None:
        block = tag in _BLOCKS
        if block:
            self._flush()
        if tag == "br":
            self._pieces.append(" ")
            return
        for at in range(len(self._open) - 1, 0, -1):
            if self._open[at].tag == tag:
                del self._open[at:]
                return
            if not block and self._open[at].block:
                return  # an inline end tag does not end blocks
