"""A tolerant DOM for feature extraction: elements, their texts and what the classifier sees of them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template title textarea iframe".split())  # their contents are no text of the page
INLINE = frozenset(  # phrasing content, that of formulas and drawings included
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var "
    "noscript object canvas select optgroup option math semantics annotation annotation-xml mi mn mo ms mtext mspace mrow mfrac msqrt mroot "
    "mstyle merror mpadded mphantom msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mtd svg g defs desc "
    "symbol use path rect circle ellipse line polyline polygon text tspan textpath marker pattern clippath mask lineargradient radialgradient "
    "stop filter foreignobject".split()
)
_SPACED = frozenset("option optgroup mtr mtd text desc annotation".split())  # parts that no white space needs to part
CLOSES = {  # an element whose begin tag ends an open one of these, up to the border
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "body": ({"head"}, set()),
}
P_STAYS_IN = frozenset({"div", "td", "th", "li", "section", "article", "main", "aside", "blockquote", "body", "form", "footer", "header", "nav"})

# Words of class, id and role attributes that hint at what an element is for.
ASIDE_WORDS = frozenset(
    "nav navigation navbar menu menubar breadcrumb breadcrumbs header masthead topbar footer foot colophon copyright sidebar side aside widget "
    "ad ads adv advert adverts advertisement banner sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay "
    "comment comments reply replies disqus respond discussion share sharing social related recommended more tags newsletter subscribe signup "
    "login search form toolbar pager pagination skip contentinfo complementary meta toc".split()
)
MAIN_WORDS = frozenset("article content contents post entry main body story text maincontent articlebody page prose".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[a-zA-Z/][^>]*\Z", re.S
)
_ATTRIBUTE = re.compile(r"([\w-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")
_WORD = re.compile(r"[a-z]+")
_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I | re.A) for name in HIDDEN}
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Element:
    tag: str
    parent: int
    depth: int
    words: list[str] = field(default_factory=list)
    main: bool = False  # inside an element with data-main, which only generated training pages have


@dataclass
class Page:
    elements: list[Element]
    texts: list[tuple[int, int, bool, str]]  # element (never an inline one), block number, inside a link, decoded text
    tags: list[int]  # begin tags inside each element itself, inline and void ones included
    inputs: list[int]


def parse(source: str) -> Page:
    """Elements and texts in page order; unclosed, unopened and cut off tags are put up with."""
    root = Element("#root", -1, 0)
    elements, texts, tags, inputs = [root], [], [0], [0]
    stack: list[tuple[str, int]] = [("#root", 0)]
    block, links, at = 0, 0, 0

    def say(text: str) -> None:
        if text.strip():
            texts.append((stack[-1][1], block, links > 0, html.unescape(text)))
        elif text:
            texts.append((stack[-1][1], block, links > 0, " "))

    def leave(position: int) -> None:
        nonlocal block, links
        for tag, _ in stack[position:]:
            links -= tag == "a"
            block += tag not in INLINE
        del stack[position:]

    while (m := _TOKEN.search(source, at)) is not None:
        if m.start() > at:
            say(source[at : m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        name = name.lower()
        if m.group(1):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    leave(k)
                    break
                if name in INLINE and stack[k][0] not in INLINE:
                    break
            continue
        tags[stack[-1][1]] += 1
        if name in ("input", "button", "select", "textarea"):
            inputs[stack[-1][1]] += 1
        if name in HIDDEN:
            if not m.group(3).rstrip().endswith("/"):
                end = _END[name].search(source, at)
                at = len(source) if end is None else source.find(">", end.end()) + 1 or len(source)
            continue
        if name in VOID:
            if name in ("br", "hr", "img"):
                say(" ")
            block += name == "hr"
            continue
        if name not in INLINE:
            ends, border = CLOSES.get(name, (set(), set()))
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ends or stack[k][0] == "p":
                    leave(k)
                    if stack[k - 1][0] not in ends:
                        break
                elif stack[k][0] in border or not ends and stack[k][0] in P_STAYS_IN:
                    break
        if name in INLINE:
            if name in _SPACED:
                say(" ")
            stack.append((name, stack[-1][1]))
            links += name == "a"
            continue
        block += 1
        words: list[str] = []
        main = elements[stack[-1][1]].main
        if m.group(3).strip():
            for key, *values in _ATTRIBUTE.findall(m.group(3)):
                value = "".join(values)
                if key in ("class", "id", "role", "itemprop", "aria-label"):
                    words += _WORD.findall(_CAMEL.sub(" ", value).lower())
                elif key == "data-main":
                    main = True
        parent = stack[-1][1]
        elements.append(Element(name, parent, elements[parent].depth + 1, words, main))
        tags.append(0)
        inputs.append(0)
        stack.append((name, len(elements) - 1))
    rest = source[at:]
    if rest:
        say(rest)
    return Page(elements, texts, tags, inputs)


TAG_KINDS = (
    ("p", "blockquote", "pre", "figcaption"), ("h1", "h2", "h3", "h4", "h5", "h6"), ("ul", "ol", "dl"), ("li", "dt", "dd"),
    ("table", "tbody", "tr", "td", "th"), ("nav", "menu"), ("header",), ("footer",), ("aside", "dialog"), ("form", "fieldset", "button"),
    ("article",), ("main",), ("section", "div"), ("body", "html", "#root"),
)
_KIND = {tag: k for k, tags in enumerate(TAG_KINDS) for tag in tags}
_OFF_KINDS = frozenset((5, 6, 7, 8, 9))
_MAIN_KINDS = frozenset((10, 11))
FEATURES = len(TAG_KINDS) + 20


def features(page: Page) -> np.ndarray:
    """A row for each element: its kind, attribute words, depth, subtree density, place among its siblings, ancestors."""
    n = len(page.elements)
    parent = np.array([e.parent for e in page.elements])
    own, link, stops = np.zeros(n), np.zeros(n), np.zeros(n)
    first = np.full(n, np.inf)
    total = 0
    for element, _, linked, text in page.texts:
        size = len(text.strip())
        own[element] += size
        link[element] += size * linked
        stops[element] += text.count(".") + text.count(",")
        if size:
            first[element] = min(first[element], total)
        total += size
    chars, links, marks = own.copy(), link.copy(), stops.copy()
    tags, inputs = np.array(page.tags, float), np.array(page.inputs, float)
    kind = np.array([_KIND.get(e.tag, len(TAG_KINDS)) for e in page.elements])
    items = (kind == 3).astype(float)
    for i in range(n - 1, 0, -1):
        p = parent[i]
        for sums in (chars, links, marks, tags, inputs, items):
            sums[p] += sums[i]
        first[p] = min(first[p], first[i])
    rows = np.zeros((n, FEATURES))
    children: dict[int, list[int]] = {}
    for i in range(1, n):
        children.setdefault(int(parent[i]), []).append(i)
    off, main, off_word, main_word = (np.zeros(n) for _ in range(4))
    for i, e in enumerate(page.elements):
        p = max(0, e.parent)
        bad, good = sum(w in ASIDE_WORDS for w in e.words), sum(w in MAIN_WORDS for w in e.words)
        if i:
            off[i], main[i] = off[p] + (kind[i] in _OFF_KINDS), main[p] + (kind[i] in _MAIN_KINDS)
            off_word[i], main_word[i] = off_word[p] + (bad > 0), main_word[p] + (good > bad)
        if kind[i] < len(TAG_KINDS):
            rows[i, kind[i]] = 1
        brothers = children.get(int(e.parent), [i])
        same = [b for b in brothers if page.elements[b].tag == e.tag]
        rows[i, len(TAG_KINDS) :] = (
            bad, good, off_word[i], main_word[i], off[i], main[i], min(e.depth, 12),
            np.log1p(chars[i]), np.log1p(chars[i] / (1 + tags[i])), links[i] / (1 + chars[i]), np.log1p(own[i]),
            100 * marks[i] / (20 + chars[i]), inputs[i], items[i] / (1 + tags[i]),
            min((i - brothers[0]) / (1 + brothers[-1] - brothers[0]), 0.5), min(len(brothers), 20), min(len(same), 20),
            max(chars[i] / (1 + chars[p]), 0.05), max(chars[i] / (1 + total), 0.05), min(first[i] / (1 + total), 0.3),
        )
    return rows
