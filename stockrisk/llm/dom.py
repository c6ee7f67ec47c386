"""Reading a page as a tree of blocks: the part of HTML's rules that decides where text stands.

A block is the text between two block boundaries, with its character
references decoded (piece by piece between two tags) and its white space
folded. Each block knows the path of elements it stands in, as a hash that
each element works out from its parent's; the path's element names carry class
and id words, so pages made from one template give equal paths.

One pass, in time linear in the page whatever it holds: where a tag ends is
worked out for all quotes and brackets beforehand, open elements are found by
their tag, and no path is copied.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from html import unescape
from itertools import accumulate

import xxhash

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARKS = re.compile(r"""["'>]""")
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_SPLIT = re.compile(r"[^a-z]+")

# FIXED VALUES: HTML's element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style iframe textarea title xmp noframes".split())  # text up to their end tag, or the end of the page
FOREIGN = frozenset("svg math".split())  # may close themselves
HIDDEN = FOREIGN | frozenset("noscript template object select button".split())  # dropped with all they hold, if they end
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
CLOSED_BY = {  # an open element that the start of another one ends, and where the search for it stops
    "p": ("p", frozenset()),
    "li": ("li", frozenset(["ul", "ol"])),
    "dt": ("dd dt", frozenset(["dl"])),
    "dd": ("dd dt", frozenset(["dl"])),
    "tr": ("tr td th", frozenset(["table"])),
    "td": ("td th", frozenset(["tr", "table"])),
    "th": ("td th", frozenset(["tr", "table"])),
    "option": ("option", frozenset(["select"])),
}
P_ENDS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
NOISE_TAGS = frozenset("nav aside footer dialog menu head".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu".split())
PLACE_WORDS = frozenset(  # say where or how, beside a noise word
    "area bar block bottom box button buttons container content first form global group header icon icons inline inner item items "
    "last left link links list main outer page panel primary right row secondary section site text top user wrap wrapper".split()
)
STATE_WORDS = frozenset("has no not with without is layout open opened closed fixed enabled disabled".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar widget widgets footer header masthead topbar cookie cookies consent gdpr notice "
    "notices popup modal overlay newsletter subscribe subscription signup login comment comments commentlist respond disqus "
    "replies share sharing social related recommended recommendations pagination pager toolbar skip".split()
)


@dataclass
class Block:
    path: int
    text: str
    linked: int  # code points of the text inside links
    zone: int  # 0 in a branch taken for boilerplate, 1 in an article or main element, 2 elsewhere


@dataclass
class _Open:
    tag: str
    node: int
    path: int
    children: list[str]
    inline: dict[str, int]  # open inline elements it holds, by tag


@dataclass
class _Node:
    """An element that is not inline, as ``_zones`` needs it."""

    above: int
    tag: str
    mark: int  # what its tag, role and words say
    text: int = 0  # code points of its own blocks


PLAIN, BOILERPLATE, EVIDENCE = 0, 1, 2
LEAST_FREE = 0.05


def _named(tag: str, attributes: str) -> tuple[str, int]:
    """Name of an element in a path, and what its tag, role and words say.

    A token of class or id is evidence as a whole: all its parts are noise
    words or say where they stand (comment-list, page-sidebar), and one is a
    noise word. Any other part makes it a subject (social-policy,
    related-work). A token that holds a state word (has-sidebar,
    comments-open) says how a layout looks, not what stands in the branch.
    """
    words: list[str] = []
    telling: list[str] = []
    role = ""
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if key in ("class", "id"):
                for token in value.split():
                    parts = [w for w in _SPLIT.split(token) if w]
                    words += parts
                    if STATE_WORDS.isdisjoint(parts) and NOISE_WORDS.union(PLACE_WORDS).issuperset(parts):
                        telling += parts
            elif key == "role":
                role = value.strip()
    mark = PLAIN
    if tag in NOISE_TAGS:
        mark = BOILERPLATE
    elif tag not in ("html", "body", "main"):
        if role in NOISE_ROLES:
            mark = BOILERPLATE
        elif tag == "form" or role == "form" or not NOISE_WORDS.isdisjoint(telling):
            mark = EVIDENCE
    return ".".join([tag, *sorted(set(words))]), mark


def _zones(nodes: list[_Node]) -> list[int]:
    """Zone of every element, given in page order.

    Evidence is overruled where a branch holds more than half of the page's
    text that is no certain boilerplate. Such branches lie within each other;
    they are opened from the outside until ``LEAST_FREE`` of that text stands
    free in article or main elements, or all of them where it never does.
    """
    size = len(nodes)
    certain, shut, in_main, depth = [False] * size, [False] * size, [False] * size, [0] * size
    own = [n.text for n in nodes]
    for i, n in enumerate(nodes):
        above = max(n.above, 0)
        certain[i] = certain[above] or n.mark == BOILERPLATE or (n.tag == "header" and not in_main[above])
        in_main[i] = in_main[above] or n.tag in ("article", "main")
        own[i] *= not certain[i]
    whole = own[:]
    for i in range(size - 1, 0, -1):
        whole[nodes[i].above] += whole[i]
    free = [0] * (size + 1)  # article and main text by the number of wide branches it stands in
    for i, n in enumerate(nodes):
        above = max(n.above, 0)
        wide = n.mark == EVIDENCE and 2 * whole[i] > whole[0]
        shut[i] = shut[above] or certain[i] or (n.mark == EVIDENCE and not wide)
        depth[i] = depth[above] + wide
        if in_main[i] and not shut[i]:
            free[depth[i]] += own[i]
    reached = accumulate(free)
    opened = next((k for k, text in enumerate(reached) if text and text >= LEAST_FREE * whole[0]), size)
    return [0 if shut[i] or depth[i] > opened else 1 if in_main[i] else 2 for i in range(size)]


def _tag_ends(html: str) -> tuple[list[int], list[int], list[int]]:
    """Places of quotes and closing brackets; for each, where a tag ends whose next mark it is: by quotes, and by brackets alone (-1: nowhere)."""
    marks = [m.start() for m in _MARKS.finditer(html)]
    ends, loose = [-1] * (len(marks) + 1), [-1] * (len(marks) + 1)
    following = {}  # of a quote: the next one of its kind
    for i in range(len(marks) - 1, -1, -1):
        mark = html[marks[i]]
        if mark == ">":
            ends[i] = loose[i] = marks[i]
        else:
            loose[i] = loose[i + 1]
            partner = following.get(mark)
            ends[i] = -1 if partner is None else ends[partner + 1]
            following[mark] = i
    return marks, ends, loose


def _hidden_ends(html: str) -> dict[int, int]:
    """Start and end of the hidden elements that do end; one that never does is no element. A button can't hold a button."""
    if not _HIDDEN.search(html):
        return {}
    open_: dict[str, list[int]] = {}
    found = {}
    for m in _HIDDEN.finditer(html):
        starts = open_.setdefault(m[2].lower(), [])
        if not m[1]:
            if m[2].lower() == "button":
                starts.clear()
            starts.append(m.start())
        elif starts:
            found[starts.pop()] = m.end()
    return found


_HIDDEN = re.compile(rf"<(/?)({'|'.join(sorted(HIDDEN))})(?=[\s/>])", re.IGNORECASE)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in RAW}


def path_hash(above: int, name: str) -> int:
    return xxhash.xxh64_intdigest(above.to_bytes(8, "little") + name.encode("utf-8", "surrogatepass"))


def read_blocks(html: str) -> tuple[list[Block], dict[int, list[str]], dict[int, int]]:
    """Blocks of a page in order, the child element names of each path, and the path above it (the page's own: itself)."""
    blocks: list[Block] = []
    styles: dict[int, list[str]] = {}
    around = {0: 0}
    nodes = [_Node(-1, "", PLAIN)]  # the page itself
    stack = [_Open("", 0, 0, [], {})]
    open_at: dict[str, list[int]] = {}  # depths of the open elements, by tag
    inline_at: dict[str, list[int]] = {}  # depths of the elements that hold the open inline ones, by tag
    pieces: list[tuple[str, bool]] = []
    links = 0

    def flush() -> None:
        if pieces:
            text = " ".join("".join(p for p, _ in pieces).split())
            if text:
                linked = sum(len(" ".join(p.split())) for p, inside in pieces if inside)
                top = stack[-1]
                blocks.append(Block(top.path, text, min(linked, len(text)), top.node))  # its zone is known at the end
                nodes[top.node].text += len(text)
            pieces.clear()

    def close(depth: int) -> None:
        nonlocal links
        while len(stack) > depth:
            flush()
            gone = stack.pop()
            open_at[gone.tag].pop()
            for tag, many in gone.inline.items():
                if many:
                    del inline_at[tag][-many:]
                    links -= many * (tag == "a")
            styles.setdefault(gone.path, []).extend(gone.children)

    def close_for(names: set[str], stops: set[str]) -> None:
        """Close the outermost of the named elements that stands inside the innermost of the stops."""
        stop = max((open_at[t][-1] for t in stops - names if open_at.get(t)), default=0)
        inside = [held[i] for held in map(open_at.get, names) if held and (i := bisect_right(held, stop)) < len(held)]
        if inside:
            close(min(inside))

    marks, ends, loose = _tag_ends(html)
    hidden = _hidden_ends(html)
    at, size, mark = 0, len(html), 0
    while at < size:
        low = html.find("<", at)
        if low < 0:
            low = size
        if low > at:
            pieces.append((unescape(html[at:low]), links > 0))
        if low == size:
            break
        if html.startswith("<!--", low):
            end = html.find("-->", low + 4)
            at = size if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), low):
            end = html.find(">", low)
            at = size if end < 0 else end + 1
            continue
        named = _NAME.match(html, low)
        mark = bisect_left(marks, low, mark)
        end = ends[mark] if ends[mark] >= 0 else loose[mark]
        if not named or end < 0:
            pieces.append(("<", links > 0))
            at = low + 1
            continue
        tag, attributes, at = named[1].lower(), html[named.end() : end], end + 1
        if html[low + 1] == "/":
            if tag in INLINE:
                held = inline_at.get(tag)
                if held:
                    stack[held.pop()].inline[tag] -= 1
                    links -= tag == "a"
            elif open_at.get(tag):
                close(open_at[tag][-1])
            elif tag not in VOID and tag not in HIDDEN:
                flush()
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(html, at)
            end = html.find(">", end.end()) if end else -1
            at = size if end < 0 else end + 1
            continue
        if tag in HIDDEN:
            if low in hidden and not (tag in FOREIGN and attributes.endswith("/")):
                end = html.find(">", hidden[low])
                at = max(at, size if end < 0 else end + 1)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag in ("br", "wbr"):
                pieces.append((" ", links > 0))
            continue
        if tag in INLINE:
            inline_at.setdefault(tag, []).append(len(stack) - 1)
            stack[-1].inline[tag] = stack[-1].inline.get(tag, 0) + 1
            links += tag == "a"
            continue
        names, stop = CLOSED_BY.get(tag, ("", frozenset()))
        close_for({*names.split(), *(["p"] if tag in P_ENDS else [])}, {*stop, "td", "th", "table"})
        flush()
        name, told = _named(tag, attributes)
        above = stack[-1]
        above.children.append(name)
        nodes.append(_Node(above.node, tag, told))
        open_at.setdefault(tag, []).append(len(stack))
        path = path_hash(above.path, name)
        around[path] = above.path
        stack.append(_Open(tag, len(nodes) - 1, path, [], {}))
    close(1)
    flush()
    styles.setdefault(0, []).extend(stack[0].children)
    zones = _zones(nodes)
    for b in blocks:
        b.zone = zones[b.zone]
    return blocks, styles, around
