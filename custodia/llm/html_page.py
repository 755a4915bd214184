"""Pages as flat trees of elements and text runs."""

import html
import re
from typing import NamedTuple
from zlib import crc32

_REST = r"((?:[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+)>?"
#: Groups: an element of raw text, its attributes and text; the slash of a closing tag, a tag, its attributes; text.
_MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|xmp|noembed|noframes)(?=[\s/>]){_REST}(.*?)(?=</\1\b|\Z)"
    rf"|<(/?)([a-z][^\s/>]*){_REST}|<[!?/][^>]*>?|([^<]+|<)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORDS = re.compile(r"[a-z]+")

# Elements by how they are parsed.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: An opening tag of the key ends an open element of the values.
ENDS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("td", "th", "tr"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
#: Elements that an implied or stray end never reaches beyond.
SCOPES = frozenset("html body article main section table ul ol div aside nav footer header form td th".split())

#: Elements without text of an article.
HIDDEN = frozenset(
    "nav aside footer form script style noscript template iframe svg button select textarea object canvas audio "
    "video dialog menu head".split()
)
#: Words of class, id or role that may name what is not the article.
NOT_ARTICLE = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promotion banner "
    "sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer cookie cookies consent notice "
    "notices alert alerts popup modal comment comments disqus respond discussion share sharing social related "
    "complementary contentinfo newsletter subscribe search login signup masthead".split()
)

#: Of these, words that no part of an article has as its topic.
CLUTTER_WORDS = NOT_ARTICLE - frozenset(
    "alert alerts complementary consent discussion login notice notices promotion related search share sharing "
    "signup social subscribe".split()
)
#: Elements whose id names them; in others it is the anchor of a part of the text.
NAMED_BY_ID = frozenset("div ul ol article".split())

#: NAMED and CLUTTER are proposals, which `html_template.settle` decides on; POST is an article element itself.
ARTICLE, MAIN, OUTSIDE, HEADER, HEADING, LINK, NAMED, CLUTTER, POST = 1, 2, 4, 8, 16, 32, 64, 128, 256
#: What an element hands down to those in it.
HANDED = ARTICLE | MAIN | OUTSIDE | HEADER | HEADING | LINK

#: Elements that make a page's skeleton, and how deep it goes: below the body, and a level further.
STRUCTURE = frozenset("html body div section article main header footer nav aside form center table tbody tr td".split())
COARSE, FINE = 3, 4

_MASK = (1 << 63) - 1


class Element(NamedTuple):
    parent: int
    tag: str
    token: int  # of the path from the root, the same on all pages of one layout
    flags: int
    start: int  # position among elements and texts
    key: int  # of the tag with its class and id, without its order


class Text(NamedTuple):
    parent: int
    block: int
    text: str
    start: int


class Page(NamedTuple):
    elements: list[Element]
    texts: list[Text]


def _names(tag: str, rest: str) -> tuple[str, frozenset[str], frozenset[str], bool]:
    """An element's class and id without digits, their words and the role's, those that name it, and whether it is hidden."""
    key, words, naming, hidden = [], set(), set(), False
    for name, a, b, c in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id"):
            key.append(f"{name}={re.sub(r'[0-9]+', '#', value)}")
            found = _WORDS.findall(value)
            words.update(found)
            naming.update(found if name == "class" or tag in NAMED_BY_ID else ())
        elif name == "role":
            words.update(_WORDS.findall(value))
            naming.update(_WORDS.findall(value))
            if value == "main":
                key.append("role=main")
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
    return ";".join(key), frozenset(words), frozenset(naming), hidden


class _Tag(NamedTuple):
    """What an opening tag says by itself."""

    tag: str
    key: int
    flags: int
    ordered: bool  # only its order tells it from its siblings
    void: bool
    inline: bool
    ends: tuple[str, ...]


def _tag(name: str, rest: str) -> _Tag:
    tag = name.lower()
    key, words, naming, hidden = "", frozenset(), frozenset(), False
    if "=" in rest or "hidden" in rest:
        key, words, naming, hidden = _names(tag, rest)
    flags = 0
    if tag in HIDDEN or hidden:
        flags |= OUTSIDE
    if naming & NOT_ARTICLE and tag not in ("html", "body", "main"):
        flags |= NAMED | (CLUTTER if naming & CLUTTER_WORDS else 0)
    if tag == "header" or words == {"header"} or {"site", "header"} <= words or {"page", "header"} <= words:
        flags |= HEADER
    if tag == "main" or "role=main" in key:
        flags |= MAIN
    flags |= {"article": ARTICLE | POST, "h1": HEADING, "a": LINK}.get(tag, 0)
    ordered = not key and tag in ("div", "section", "table", "tr", "td")
    void, inline = tag in VOID, tag in INLINE
    ends = () if inline or void else ENDS.get(tag, ("p",))
    return _Tag(tag, crc32(f"{tag}.{key}".encode()) + 1, flags, ordered, void, inline, ends)


_TAGS: dict[tuple[str, str], _Tag] = {}


def _known_tag(name: str, rest: str) -> _Tag:
    """Remembers tags; pages repeat few."""
    found = _TAGS.get((name, rest))
    if found is None:
        if len(_TAGS) >= 20_000:
            _TAGS.clear()
        found = _TAGS[name, rest] = _tag(name, rest)
    return found


def parse(source: str) -> Page:
    """Elements and texts in page order; markup that isn't closed ends with its parent or the page."""
    elements = [Element(-1, "", 1, 0, 0, 0)]
    texts: list[Text] = []
    stack = [0]
    siblings: dict[tuple[int, int], int] = {}
    block = place = 0
    for raw, raw_rest, raw_text, slash, name, rest, run in _MARKUP.findall(source):
        if run:
            place += 1
            texts.append(Text(stack[-1], block, html.unescape(run) if "&" in run else run, place))
            continue
        if slash:
            tag = name.lower()
            if tag not in INLINE:
                block += 1
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = elements[stack[depth]].tag
                if open_tag == tag:
                    del stack[depth:]
                    break
                if open_tag in SCOPES and (tag in INLINE or tag == "p"):
                    break
            continue
        if not (raw or name):
            continue  # a comment or declaration
        tag, key, flags, ordered, void, inline, ends = _known_tag(raw or name, raw_rest or rest)
        if not inline:
            block += 1
            if ends:
                for depth in range(len(stack) - 1, 0, -1):
                    open_tag = elements[stack[depth]].tag
                    if open_tag in ends:
                        del stack[depth:]
                        if tag != "tr":
                            break
                    elif open_tag in SCOPES:
                        break
        if void:
            continue
        up = elements[stack[-1]]
        kind = key
        if ordered:
            n = siblings[stack[-1], key] = siblings.get((stack[-1], key), 0) + 1
            key += n << 32
        place += 1
        token = (up.token * 0x9E3779B97F4A7C15 + key) & _MASK
        elements.append(Element(stack[-1], tag, token, up.flags & HANDED | flags, place, kind))
        stack.append(len(elements) - 1)
        if raw and raw_text and tag in ("title", "textarea"):
            place += 1
            texts.append(Text(stack[-1], block, html.unescape(raw_text), place))
    return Page(elements, texts)


def skeleton(page: Page) -> tuple[int, int]:
    """Signatures of the page's upper elements outside of articles: a fine one, and one without order and the last level."""
    paths: dict[int, tuple[int, int]] = {0: (0, 1)}  # depth and path without order
    fine, coarse = set(), set()
    for i, e in enumerate(page.elements):
        if e.parent not in paths or e.tag not in STRUCTURE:
            continue
        depth, path = paths[e.parent]
        depth, path = depth + 1, (path * 0x9E3779B97F4A7C15 + e.key) & _MASK
        if depth <= COARSE:
            coarse.add(path)
        fine.add(e.token if depth <= COARSE else path)
        if depth < FINE and e.tag != "article":
            paths[i] = depth, path
    low = crc32(repr(sorted(coarse)).encode())
    return crc32(repr(sorted(fine)).encode()) << 31 ^ low, low


def join_blocks(texts: list[Text]) -> str:
    """White space inside a block becomes one space; blocks are joined by one."""
    blocks: list[list[str]] = []
    last = None
    for text in texts:
        if text.block != last:
            blocks.append([])
            last = text.block
        blocks[-1].append(text.text)
    words = (" ".join("".join(parts).split()) for parts in blocks)
    return " ".join(block for block in words if block)
