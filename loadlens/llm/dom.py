"""A small tree of an HTML page: elements, the text of its blocks, and simple tree matching of two pages."""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import numpy as np

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

#: Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table caption tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCK - frozenset("option optgroup caption tbody td tfoot th thead tr legend summary figcaption body html head".split())
#: An element that opens closes an open one of these kinds, unless one of the second set lies between.
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
}
#: Elements that never hold main text, and words in class, id or role that say so.
ASIDE_TAGS = frozenset(
    "head title script style noscript template iframe nav aside footer form button select textarea input label fieldset "
    "dialog menu svg canvas object audio video map search xmp noembed noframes".split()
)
ASIDE_WORDS = frozenset(
    "ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead footer colophon sidebar side aside complementary contentinfo notice notices "
    "cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login search form comment comments "
    "disqus reply replies respond share sharing social related recommended widget toolbar pagination pager skip alert".split()
)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element:
    """``items`` holds texts and elements in page order; ``number`` is the place in preorder, ``weight`` the number of
    elements, and ``holds`` whether an article or main element is below. ``marks`` names texts of the element that may be
    template, and ``marked`` counts the elements with marks. ``shape`` is a hash of the keys and marks of the element and all below it, for this process only."""

    __slots__ = ("tag", "key", "words", "items", "number", "weight", "holds", "shape", "marks", "marked")

    def __init__(self, tag: str, attrs: str):
        self.tag, self.items, self.number, self.weight, self.holds, self.shape, self.marks, self.marked = tag, [], 0, 1, False, 0, (), 0
        self.key, self.words = tag, ()
        if attrs and "=" in attrs:
            named = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
            said = " ".join(named.get(x, "") for x in ("class", "id", "role"))
            if said.strip():
                self.key = f"{tag} {said}"
                self.words = _said(said)

    @property
    def children(self) -> list[Element]:
        return [x for x in self.items if not isinstance(x, str)]

    def is_aside(self, in_article: bool) -> bool:
        if self.tag in ASIDE_TAGS or (self.tag == "header" and not in_article):
            return True
        return not self.holds and not ASIDE_WORDS.isdisjoint(self.words)


def _said(names: str) -> tuple[str, ...]:
    """Words of class, id and role; names like ``has-sidebar`` say something about the page, not the element."""
    words = []
    for name in names.split():
        parts = [x.lower() for x in _WORDS.findall(name)]
        if parts and parts[0] not in ("has", "with", "no", "without", "is", "not"):
            words += parts
    return tuple(words)


def parse(page: str) -> Element:
    """The page's tree. Tags that are not closed, or closed twice, are mended as browsers do for the common cases."""
    root = Element("#page", "")
    stack, at, size = [root], 0, len(page)
    while at < size:
        tag = _TOKEN.search(page, at)
        if tag is None:
            stack[-1].items.append(page[at:])
            break
        if tag.start() > at:
            stack[-1].items.append(page[at : tag.start()])
        at = tag.end()
        if tag["tag"] is None:
            continue
        name = tag["tag"].lower()
        if tag["end"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == name:
                    del stack[depth:]
                    break
            continue
        if name in ENDS_P:
            _close(stack, frozenset(["p"]), BLOCK - {"p"})
        if name in CLOSES:
            _close(stack, *CLOSES[name])
        element = Element(name, tag["attrs"])
        stack[-1].items.append(element)
        if name in VOID or tag["attrs"].endswith("/") and name not in BLOCK:
            continue
        if name in RAW:  # its text ends at its own end tag only
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            element.items.append(page[at : end.start() if end else size])
            at = end.end() if end else size
            continue
        stack.append(element)
    _number(root)
    return root


def _close(stack: list[Element], kinds: frozenset[str], walls: frozenset[str]) -> None:
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in kinds:
            del stack[depth:]
            return
        if stack[depth].tag in walls:
            return


def _order(root: Element) -> list[Element]:
    todo, order = [root], []
    while todo:
        order.append(todo.pop())
        todo += reversed(order[-1].children)
    return order


def _number(root: Element) -> None:
    for element in reversed(measured(root)):
        element.holds = element.tag in ("html", "body", "main") or any(
            x.holds or x.tag in ("article", "main") and ASIDE_WORDS.isdisjoint(x.words) for x in element.children
        )


def measured(root: Element) -> list[Element]:
    """The elements in preorder, after their numbers, weights and shapes are set anew."""
    order = _order(root)
    for i, element in enumerate(order):
        element.number = i
    for element in reversed(order):
        children = element.children
        element.weight = 1 + sum(x.weight for x in children)
        element.marked = bool(element.marks) + sum(x.marked for x in children)
        element.shape = hash((element.key, element.marks, *(x.shape for x in children)))
    return order


def merge(base: Element, page: Element, known: Sizes | None = None) -> None:
    """Gives ``base`` the elements of ``page`` that match none of its own, each after what its left neighbour matches.

    Elements alone are taken over, without texts; ``base`` is measured anew.
    """
    pairs = match(page, base, known)
    own = _order(base)
    todo = [(page, base)]
    while todo:
        element, into = todo.pop()
        at = 0
        for child in element.children:
            place = pairs.get(child.number)
            if place is None:
                mate = _bare(child)
                into.items.insert(at, mate)
            else:
                mate = own[place]
                at = next(i for i in range(at, len(into.items)) if into.items[i] is mate)
                todo.append((child, mate))
            at += 1
    measured(base)


def _bare(element: Element) -> Element:
    """A copy of an element and all below it, without texts."""
    copy = Element(element.tag, "")
    todo = [(element, copy)]
    while todo:
        old, new = todo.pop()
        new.key, new.marks = old.key, old.marks
        for child in old.children:
            new.items.append(Element(child.tag, ""))
            todo.append((child, new.items[-1]))
    return copy


def dump(root: Element) -> str:
    """The elements below a tree's root, as text: of each the depth, key and marks, in preorder."""
    rows, todo = [], [(0, x) for x in reversed(root.children)]
    while todo:
        depth, element = todo.pop()
        rows.append([depth, element.key, *element.marks])
        todo += ((depth + 1, x) for x in reversed(element.children))
    return json.dumps(rows, separators=(",", ":"))


def load(text: str) -> Element:
    """The tree that ``dump`` wrote."""
    stack = [Element("#page", "")]
    for depth, key, *marks in json.loads(text):
        element = Element(key.split(" ", 1)[0], "")
        element.key, element.marks = key, tuple(marks)
        del stack[depth + 1 :]
        stack[-1].items.append(element)
        stack.append(element)
    measured(stack[0])
    return stack[0]


#: Weight of a matched pair of elements; below it counts, among matchings of one size, that all below the two is equal too.
PAIR = 1 << 32
#: What a pair of elements of the same marks counts for, in pairs.
MARKED = 1 << 8
#: Cells of the dynamic program over two lists of children up to which all its rows are held.
CELLS = 40_000
#: Sizes of matchings that are held for the next page.
KNOWN = 100_000

Sizes = dict[tuple[int, int], int]


def match(a: Element, b: Element, known: Sizes | None = None) -> dict[int, int]:
    """Simple tree matching: numbers of elements of ``a`` to those of ``b``.

    Equal elements match, in order, below matched parents, so that the number of matched elements is greatest; of such
    matchings one in which most pairs are equal in all that is below them. A pair with the same marks counts ``MARKED`` times,
    so that texts that may be template meet first. ``known`` has sizes by two shapes, of any pages.
    """
    known = {} if known is None else known
    if len(known) > KNOWN:
        known.clear()
    pairs = {a.number: b.number}
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        if x.shape != y.shape:
            _measure(x, y, known)
        for c, d in _paired(x.children, y.children, known):
            pairs[c.number] = d.number
            todo.append((c, d))
    return pairs


def _measure(a: Element, b: Element, known: Sizes) -> None:
    """Adds the sizes of all pairs of children that the matching of a and b weighs, deepest first."""
    todo = [(a, b, False)]
    while todo:
        x, y, ready = todo.pop()
        if (x.shape, y.shape) in known:
            continue
        low, xs, ys = _trimmed(x.children, y.children)
        if not ready:
            todo.append((x, y, True))
            inner = [d for d in ys if d.weight > 1]
            below = {(c.shape, d.shape): (c, d, False) for c in xs if c.weight > 1 for d in inner if c.key == d.key and c.shape != d.shape}
            todo += (v for k, v in below.items() if k not in known)
            continue
        same = sum(_size(c, c, known) for c in low)
        known[x.shape, y.shape] = _own(x, y) + same + (int(_last(xs, ys, known)[-1]) if xs and ys else 0)


def _own(x: Element, y: Element) -> int:
    return PAIR * MARKED if x.marks and x.marks == y.marks else PAIR


def _size(x: Element, y: Element, known: Sizes) -> int:
    """Of the greatest matching of two elements; none of unlike ones."""
    if x.shape == y.shape:
        return (x.weight + x.marked * (MARKED - 1)) * PAIR + x.weight
    if x.key != y.key:
        return 0
    return _own(x, y) if x.weight == 1 or y.weight == 1 else known[x.shape, y.shape]


def _trimmed(xs: list[Element], ys: list[Element]) -> tuple[list[Element], list[Element], list[Element]]:
    """Equal children at both ends, which a greatest matching may pair up, and what is between them of each list."""
    low = high = 0
    least = min(len(xs), len(ys))
    while low < least and xs[low].shape == ys[low].shape:
        low += 1
    while high < least - low and xs[-1 - high].shape == ys[-1 - high].shape:
        high += 1
    return xs[:low] + xs[len(xs) - high :], xs[low : len(xs) - high], ys[low : len(ys) - high]


def _rows(xs: list[Element], ys: list[Element], known: Sizes) -> Iterator[np.ndarray]:
    """Rows of the dynamic program: the greatest sizes for the first children of xs and each beginning of ys."""
    row = np.zeros(len(ys) + 1, np.int64)
    yield row
    weights: dict[int, np.ndarray] = {}
    for x in xs:
        if x.shape not in weights:
            weights[x.shape] = np.array([_size(x, y, known) for y in ys], np.int64)
        row = row.copy()
        np.maximum(row[1:], row[:-1] + weights[x.shape], out=row[1:])
        row = np.maximum.accumulate(row)
        yield row


def _last(xs: list[Element], ys: list[Element], known: Sizes) -> np.ndarray:
    for row in _rows(xs, ys, known):
        last = row
    return last


def _paired(xs: list[Element], ys: list[Element], known: Sizes) -> list[tuple[Element, Element]]:
    """The pairs of a greatest matching of two lists of children, whose sizes are known."""
    out: list[tuple[Element, Element]] = []
    todo = [(xs, ys)]
    while todo:
        xs, ys = todo.pop()
        equal, x, y = _trimmed(xs, ys)
        low = next((i for i, (c, d) in enumerate(zip(xs, ys, strict=False)) if c.shape != d.shape), min(len(xs), len(ys)))
        high = len(equal) - low
        out += zip(xs[:low], ys[:low], strict=True)
        out += zip(xs[len(xs) - high :], ys[len(ys) - high :], strict=True)
        xs, ys = x, y
        if not xs or not ys:
            continue
        if len(xs) * len(ys) > CELLS and len(xs) > 1:  # Hirschberg: where the greatest matching cuts ys below half of xs
            half = len(xs) // 2
            cut = int(np.argmax(_last(xs[:half], ys, known) + _last(xs[half:][::-1], ys[::-1], known)[::-1]))
            todo += [(xs[:half], ys[:cut]), (xs[half:], ys[cut:])]
            continue
        best = list(_rows(xs, ys, known))
        i, j = len(xs), len(ys)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                out.append((xs[i - 1], ys[j - 1]))
                i, j = i - 1, j - 1
    return out


class Block:
    """A run of text within one block element: its words, joined by single spaces, and what it lies in."""

    __slots__ = ("text", "element", "in_article", "in_main", "linked")

    def __init__(self, text: str, element: Element, in_article: bool, in_main: bool, linked: int):
        self.text, self.element, self.in_article, self.in_main, self.linked = text, element, in_article, in_main, linked


def blocks(root: Element) -> list[Block]:
    """All blocks of a page outside of menus, headers, footers, forms, adverts and the like, in page order.

    Elements that are left out so are cut from the tree, whose numbers and shapes are then stale.
    """
    out: list[Block] = []
    cut: dict[int, tuple[Element, set[int]]] = {}
    held: list[str] = []
    linked = [0]

    def flush(element: Element, article: bool, main: bool) -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        if text:
            out.append(Block(text, element, article, main, linked[0]))
        held.clear()
        linked[0] = 0

    # (element, next item, nearest block element, in an article, in main, in a link)
    stack = [(root, 0, root, False, False, False)]
    while stack:
        element, i, block, article, main, link = stack.pop()
        if i == len(element.items):
            if block is element:
                flush(block, article, main)
            continue
        stack.append((element, i + 1, block, article, main, link))
        item = element.items[i]
        if isinstance(item, str):
            held.append(item)
            if link:
                linked[0] += len(item)
            continue
        if item.tag == "br":
            held.append(" ")
            continue
        apart = item.tag in BLOCK
        if apart:
            flush(block, article, main)
        if item.is_aside(article):
            cut.setdefault(id(element), (element, set()))[1].add(i)
            continue
        stack.append((item, 0, item if apart else block, article or item.tag == "article", main or item.tag == "main", link or item.tag == "a"))
    flush(root, False, False)
    for element, places in cut.values():
        element.items = [x for i, x in enumerate(element.items) if i not in places]
    return out
