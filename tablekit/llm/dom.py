"""A small document tree: forgiving parsing, simple tree matching, text of blocks."""

from __future__ import annotations

import re
from collections.abc import Generator, Iterator
from html import unescape

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_HIDDEN = frozenset("head script style noscript template iframe object svg canvas math audio video".split())
_FURNITURE = frozenset("nav aside form button select textarea input label fieldset dialog menu".split())
_BLOCK = frozenset("address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead "
                   "tr ul caption".split())
#: A start tag ends an open element of these kinds, up to the nearest of the fences.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"})}
#: Words in class, id or role that name furniture anywhere, and those that do outside the article only.
_ALWAYS = frozenset("nav navbar navigation menu sidebar breadcrumb breadcrumbs ad ads advert adverts advertisement "
                    "advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices gdpr popup "
                    "modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
                    "comment comments commentlist reply replies respond disqus pagination pager widget search toolbar "
                    "skip hidden alert complementary contentinfo".split())
_OUTSIDE = frozenset("header masthead footer top bottom legal copyright tags meta".split())
_TOKENS = re.compile(r"[a-z]+")
_NO_WORDS: frozenset[str] = frozenset()


class Node:
    """An element: its parts in order are texts and nodes."""

    __slots__ = ("tag", "label", "words", "parts", "children", "hidden", "index", "shape", "size")

    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag = tag
        self.label, self.words, self.hidden = tag, _NO_WORDS, tag in _HIDDEN
        if attrs:
            kind = attrs.get("class") or ""
            self.label = f"{tag}.{kind}"
            self.words = frozenset(_TOKENS.findall(f"{kind} {attrs.get('id') or ''} {attrs.get('role') or ''}".lower()))
            self.hidden = self.hidden or "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true" or (
                "display:none" in (attrs.get("style") or "").replace(" ", "").lower())
        self.parts: list[str | Node] = []
        self.children: list[Node] = []
        self.index, self.shape, self.size = 0, 0, 1

    def text(self) -> str:
        """The element's own text, without that of its children."""
        return " ".join(" ".join([x for x in self.parts if isinstance(x, str)]).split())


#: Comments and declarations, or a tag: slash, name, attributes; quotes in tags need not be balanced.
_MARK = re.compile(r"""<!--(?:.*?-->|.*)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>""",
                   re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_RAW_ENDS = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("script", "style")}


def _attributes(text: str) -> dict[str, str | None]:
    found: dict[str, str | None] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


class _Builder:
    def __init__(self):
        self.root = Node("#root", {})
        self.open = [self.root]
        #: Places in ``open`` by tag, so that no end tag has to look through a deep nest.
        self.places: dict[str, list[int]] = {}

    def _last(self, kinds: set[str] | frozenset[str]) -> int:
        return max((p[-1] for k in kinds if (p := self.places.get(k))), default=0)

    def _close(self, kinds: set[str] | frozenset[str], fences: set[str] | frozenset[str]) -> None:
        at = self._last(kinds)
        if at and at >= self._last(fences):
            while len(self.open) > at:
                self.places[self.open.pop().tag].pop()

    def feed(self, html: str) -> None:
        at = 0
        while mark := _MARK.search(html, at):
            if mark.start() > at:
                self.handle_data(html[at:mark.start()])
            at = mark.end()
            slash, tag, attrs = mark.group(1, 2, 3) if mark[2] else mark.group(4, 5, 6)
            if not tag:
                continue
            tag = tag.lower()
            if slash:
                self.handle_endtag(tag)
                continue
            self.handle_starttag(tag, attrs)
            if tag in _RAW_ENDS:
                end = _RAW_ENDS[tag].search(html, at)
                at = end.end() if end else len(html)
                self.handle_endtag(tag)
        if at < len(html):
            self.handle_data(html[at:])

    def _add(self, tag: str, attrs: str) -> Node:
        node = Node(tag, _attributes(attrs) if attrs and not attrs.isspace() else {})
        self.open[-1].parts.append(node)
        self.open[-1].children.append(node)
        return node

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCK:
            self._close({"p"}, {"td", "th", "button", "table", "article", "section", "div", "body"})
        if tag in _CLOSES:
            self._close(*_CLOSES[tag])
        node = self._add(tag, attrs)
        if tag not in _VOID and not attrs.endswith("/"):
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def handle_endtag(self, tag):
        if tag == "p" or tag not in _VOID:
            fences = {"td", "th", "table", "body"} if tag not in _BLOCK else {"body"} if tag not in ("body", "html") else set()
            self._close({tag}, fences)

    def handle_data(self, data):
        self.open[-1].parts.append(unescape(data) if "&" in data else data)


def parse(html: str) -> Node:
    """The tree of a page; anything can be parsed."""
    builder = _Builder()
    builder.feed(html)
    order = list(walk(builder.root))
    for i, node in enumerate(order):
        node.index = i
    for node in reversed(order):
        below = node.children
        node.size = 1 + sum(c.size for c in below)
        node.shape = hash((node.label, *[c.shape for c in below]))
    return builder.root


def walk(root: Node) -> Iterator[Node]:
    """All nodes, parents first, in page order."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(reversed(node.children))


def match(one: Node, two: Node) -> list[tuple[Node, Node]]:
    """Simple tree matching: the most pairs of nodes with equal labels that keep parents and order.

    Children of equal shape at either end are paired at once, which no other pairing can beat.
    """
    return list(_flat(_run(_match(one, two))[1])) if one.label == two.label else []


def _run(task: Generator) -> tuple[int, list]:
    """The result of a task that yields the tasks whose results it needs; trees may be deeper than calls."""
    stack, result = [task], None
    while stack:
        try:
            stack.append(stack[-1].send(result))
            result = None
        except StopIteration as done:
            stack.pop()
            result = done.value
    return result


def _flat(pairs: list) -> Iterator[tuple[Node, Node]]:
    """The pairs in nested lists, in order."""
    stack = [iter(pairs)]
    while stack:
        for x in stack[-1]:
            if isinstance(x, list):
                stack.append(iter(x))
                break
            yield x
        else:
            stack.pop()


def _match(one: Node, two: Node) -> Generator:
    """The number of pairs, and nested lists of them."""
    if one.shape == two.shape:
        return one.size, list(zip(walk(one), walk(two), strict=True))
    left, right = one.children, two.children
    low = 0
    while low < min(len(left), len(right)) and left[low].shape == right[low].shape:
        low += 1
    high = 0
    while high < min(len(left), len(right)) - low and left[-1 - high].shape == right[-1 - high].shape:
        high += 1
    pairs: list = [(one, two)]
    score = 1
    for a, b in [*zip(left[:low], right[:low], strict=True), *zip(left[len(left) - high:], right[len(right) - high:], strict=True)]:
        s, p = (a.size, list(zip(walk(a), walk(b), strict=True))) if a.shape == b.shape else (yield _match(a, b))
        score += s
        pairs.append(p)
    left, right = left[low:len(left) - high], right[low:len(right) - high]
    if left and right:
        known: dict[tuple[int, int], tuple] = {}  # equal shapes match alike, so each pair of shapes once

        best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
        for i, a in enumerate(left):
            row, above = best[i + 1], best[i]
            for j, b in enumerate(right):
                w = 0
                if a.label == b.label:
                    key = (a.shape, b.shape)
                    if key not in known:
                        known[key] = (*(yield _match(a, b)), a, b)
                    w = known[key][0]
                row[j + 1] = max(row[j], above[j + 1], above[j] + w if w else 0)
        score += best[-1][-1]
        i, j = len(left), len(right)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                a, b = left[i], right[j]
                _, p, was_a, was_b = known[a.shape, b.shape]
                if a is not was_a or b is not was_b:
                    ours, theirs = ({x.index: y for x, y in zip(walk(was), walk(now), strict=True)} for was, now in ((was_a, a), (was_b, b)))
                    p = [(ours[x.index], theirs[y.index]) for x, y in _flat(p)]
                pairs.append(p)
    return score, pairs


def furniture(node: Node, inside: bool) -> bool:
    """Is this element no part of an article, by its kind and names? ``inside`` an article headers and the like are."""
    if node.hidden or node.tag in _FURNITURE:
        return True
    if node.tag in ("html", "body", "article", "main", "#root"):
        return False
    if node.tag == "footer" or (node.tag == "header" and not inside):
        return True
    return bool(node.words & _ALWAYS) or (not inside and bool(node.words & _OUTSIDE))


def blocks(root: Node, dropped: frozenset[int] | set[int], first: bool = False) -> list[str]:
    """Texts of the blocks under ``root`` in page order, without furniture and the own text of nodes in ``dropped``.

    With ``first``, only the first of them.
    """
    found: list[str] = []
    now: list[str] = []

    def flush() -> None:
        text = " ".join("".join(now).split())
        if text:
            found.append(text)
        now.clear()

    stack: list = [(root, True)]
    while stack:
        part, opening = stack.pop()
        if isinstance(part, str):
            now.append(part)
        elif not opening:
            flush()
            if first and found:
                return found
        elif part is root or not furniture(part, True):
            if part.tag in _BLOCK:
                flush()
                stack.append((part, False))
            elif part.tag == "br":
                now.append(" ")
            keep = part.index not in dropped
            stack.extend((x, True) for x in reversed(part.parts) if keep or not isinstance(x, str))
    flush()
    return found


def _joined(a: tuple[int, bool, bool], b: tuple[int, bool, bool]) -> tuple[int, bool, bool]:
    """A text after another: (length without surplus blanks, blank before, blank behind)."""
    if not a[0] or not b[0]:
        blank = a[1] or a[2] or b[1] if not a[0] else a[1]
        return b[0] or a[0], blank, (b[2] if b[0] else a[2] or b[1]) if a[0] or b[0] else blank
    return a[0] + b[0] + (a[2] or b[1]), a[1], b[2]


_NO_TEXT = (0, False, False)


def _lengths(root: Node) -> dict[int, int]:
    """For each node under ``root`` the length of the texts that ``blocks`` finds in it, in one pass."""
    # what a node puts into its parent: its text up to the first end of a block, the length of whole blocks, the text
    # after the last end; None for the last two if no block ends in it
    put: dict[int, tuple] = {}
    found: dict[int, int] = {}
    for node in reversed(list(walk(root))):
        first, whole, last = _NO_TEXT, None, _NO_TEXT
        for part in node.parts:
            if isinstance(part, str):
                size = len(" ".join(part.split()))
                own = (size, part[:1].isspace(), part[-1:].isspace())
                begin, more, end = own, None, own
            else:
                begin, more, end = put[part.index]
            if whole is None:
                first = _joined(first, begin)
                last = first
                if more is not None:
                    whole, last = more, end
            elif more is None:
                last = _joined(last, begin)
            else:
                whole, last = whole + _joined(last, begin)[0] + more, end
        total = first[0] if whole is None else first[0] + whole + last[0]
        found[node.index] = total
        if furniture(node, True):
            put[node.index] = (_NO_TEXT, None, _NO_TEXT)
        elif node.tag in _BLOCK:
            put[node.index] = (_NO_TEXT, total, _NO_TEXT)
        elif node.tag == "br":
            put[node.index] = ((0, True, True), None, (0, True, True))
        else:
            put[node.index] = (first, whole, last)
    return found


def container(root: Node) -> Node:
    """The element that holds the article: the longest ``article``, else the main part, else the smallest element that
    holds most of the text outside furniture."""
    reached: list[Node] = []
    lengths: dict[int, int] = {}
    stack = [root]
    while stack:
        node = stack.pop()
        if not furniture(node, False):
            reached.append(node)
            stack.extend(reversed(node.children))
    for wanted in (lambda n: n.tag == "article", lambda n: n.tag == "main" or "main" in n.words and n.tag != "body"):
        held = [n for n in reached if wanted(n)]
        if len(held) > 1:
            lengths = lengths or _lengths(root)
            held = [max(held, key=lambda n: lengths[n.index])]
        if held and blocks(held[0], frozenset(), first=True):
            return held[0]
    now = next((n for n in reached if n.tag == "body"), root)
    lengths = lengths or _lengths(root)
    total = lengths[now.index]
    while True:
        inner = [c for c in now.children if not furniture(c, False) and lengths[c.index] >= 0.8 * total > 0]
        if not inner or inner[0].tag in ("p", "h1", "h2", "h3", "li", "td"):
            return now
        now = inner[0]
