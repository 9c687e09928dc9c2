"""Pages as trees of blocks: a forgiving parser that keeps what the extraction needs.

Nodes are block-level elements with text below them, and leaves are blocks of text: what stands between two
block boundaries, inline markup removed, character references decoded, white space turned into one space.
Scripts, styles, templates, embedded frames, controls of forms, drawings, what stands in for media, comments and
the page's head have no text. Missing end tags are supplied as browsers do for paragraphs, list items and cells. An
element without text that is not closed ends at the next one of its kind (controls) or at the end tag of a block
around it; if blocks begin in it, or the page ends, nothing is passed over. Work is linear in the page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from html import unescape

#: Fixed values of HTML: elements that bound blocks, elements without text of ours, raw text, empty elements.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
SKIPPED = frozenset("template svg select button datalist canvas audio video".split())
#: Start tags that end an open element of these names, which do not nest.
_ENDS = {"button": frozenset(("button",)), "select": frozenset(("select", "input", "textarea"))}
#: Parts of drawings that hold HTML; elsewhere in a drawing the start tag of a block ends it.
_HTML_IN_SVG = frozenset(("foreignobject", "desc", "title"))
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What a start tag closes if it is open, up to the nearest of the second set.
CLOSES = {"li": ("li", frozenset(("ul", "ol", "menu", "dir"))), "dt": ("dt dd", frozenset(("dl",))), "dd": ("dt dd", frozenset(("dl",))), "td": ("td th", frozenset(("tr", "table"))), "th": ("td th", frozenset(("tr", "table"))), "tr": ("tr td th", frozenset(("table",)))}
_CELLS = frozenset(("td", "th", "table"))
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-label|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""\shidden(?=[\s/=]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Tree:
    """parent and tag of each node in page order ('' for a text block); parts: names in class, id and role; texts and link characters of blocks; given: what `label_of` says of a start tag's attributes (None where nothing does)."""

    def __init__(self):
        self.parent: list[int] = []
        self.tag: list[str] = []
        self.parts: list[tuple[str, ...]] = []
        self.text: list[str] = []
        self.linked: list[int] = []
        self.given: list[int | None] = []

    def add(self, parent: int, tag: str, parts: tuple[str, ...] = (), text: str = "", linked: int = 0, given: int | None = None) -> int:
        for values, x in ((self.parent, parent), (self.tag, tag), (self.parts, parts), (self.text, text), (self.linked, linked), (self.given, given)):
            values.append(x)
        return len(self.parent) - 1

    def pruned(self) -> Tree:
        """Without nodes that have no text below them."""
        keep = [bool(t) for t in self.text]
        for k in range(len(keep) - 1, 0, -1):
            if keep[k] and self.parent[k] >= 0:
                keep[self.parent[k]] = True
        out, at = Tree(), {-1: -1}
        for k, yes in enumerate(keep):
            if yes:
                at[k] = out.add(at[self.parent[k]], self.tag[k], self.parts[k], self.text[k], self.linked[k], self.given[k])
        return out


def names(attributes: str) -> tuple[str, ...]:
    """Lower-case parts of class, id, role and label."""
    found = [p.lower() for _, *values in _ATTRIBUTE.findall(attributes) for p in _PART.findall(values[0] or values[1] or values[2])]
    if _HIDDEN.search(attributes):
        found.append("(hidden)")
    return tuple(dict.fromkeys(found))


class _Builder:
    def __init__(self, label_of: Callable[[str], int | None] | None = None):
        self.tree, self.label_of = Tree(), label_of
        self.open = [self.tree.add(-1, "html")]
        self.scopes = [Counter(["html"])]  # open elements by name, one counter for each open cell or table
        self.run: list[str] = []
        self.linked, self.link_from = 0, -1

    def has(self, tag: str) -> bool:
        """Whether an end tag of this name would close something."""
        return any(self.tree.tag[k] == tag for k in self.open) if tag in _CELLS else self.scopes[-1][tag] > 0

    def flush(self) -> None:
        if self.run:
            text = " ".join("".join(self.run).split())
            if text:
                self.tree.add(self.open[-1], "", text=text, linked=min(self.linked, len(text)))
            self.run.clear()
        self.linked = 0

    def words(self, s: str) -> None:
        if "&" in s:
            s = unescape(s)
        self.run.append(s)
        if self.link_from >= 0:
            self.linked += len(s)

    def pop(self) -> str:
        tag = self.tree.tag[self.open.pop()]
        if tag in _CELLS and len(self.scopes) > 1:
            self.scopes.pop()
        else:
            self.scopes[-1][tag] -= 1
        if self.link_from >= len(self.open):
            self.link_from = -1
        return tag

    def start(self, tag: str, attributes: str) -> None:
        self.flush()
        if self.scopes[-1]["p"] > 0:
            while self.pop() != "p":
                pass
        if tag in CLOSES:
            closed, bound = CLOSES[tag]
            wanted = closed.split()
            at = len(self.open) - 1
            while at > 0 and (t := self.tree.tag[self.open[at]]) not in bound and t not in wanted:
                at -= 1
            if at > 0 and self.tree.tag[self.open[at]] in wanted:
                while len(self.open) > at:
                    self.pop()
                if tag == "tr" and self.tree.tag[self.open[-1]] == "tr":
                    self.pop()
        given = self.label_of(attributes) if self.label_of else None
        self.open.append(self.tree.add(self.open[-1], tag, names(attributes) if attributes else (), given=given))
        if tag in _CELLS:
            self.scopes.append(Counter())
        else:
            self.scopes[-1][tag] += 1

    def end(self, tag: str) -> None:
        self.flush()
        if self.has(tag) and tag != "html":
            while self.pop() != tag:
                pass


class _Skip:
    """An element without text that is being passed over, from its start tag on."""

    def __init__(self, tag: str, at: int):
        self.tag, self.after = tag, at
        self.starts = [at]  # ends of the start tags of this name that are open
        self.blocks: Counter = Counter()  # open blocks in it, by name
        self.any_block = False
        self.html = 0  # open parts of a drawing that hold HTML

    def see(self, closing: str, tag: str, bare: bool, at: int, around: _Builder) -> str:
        """What a tag that ends at `at` does: "" nothing, "closed" its own end, "cut" ends it from outside."""
        if tag == self.tag and closing:
            self.starts.pop()
            return "" if self.starts else "closed"
        if not closing and tag in _ENDS.get(self.tag, ()):
            return "cut"
        if tag == self.tag:
            if not bare:
                self.starts.append(at)
        elif self.tag == "svg" and tag in _HTML_IN_SVG:
            self.html = max(0, self.html - 1) if closing else self.html + (not bare)
        elif tag in BLOCKS and tag not in ("hr", "html", "body"):
            if not closing:
                if self.tag == "svg" and not self.html:
                    return "cut"
                self.blocks[tag] += 1
                self.any_block = True
            elif self.blocks[tag] > 0:
                self.blocks[tag] -= 1
            elif self.tag != "template" and around.has(tag):
                return "cut"
        return ""


def parse(page: str, label_of: Callable[[str], int | None] | None = None) -> Tree:
    """The tree of a page; node 0 is the page itself. label_of reads labels from attributes (of pages made for training only)."""
    b, at, n = _Builder(label_of), 0, len(page)
    skip: _Skip | None = None
    kept: set[int] = set()  # ends of start tags whose elements are not passed over, as nothing closes them
    no_comment_end = False
    while at < n or skip:
        if at >= n:  # the page ended in an element without text: go back
            kept.update(skip.starts)
            at, skip = skip.after, None
            continue
        lt = page.find("<", at)
        if lt < 0 or lt == n - 1:
            if not skip:
                b.words(page[at:])
            at = n
            continue
        if lt > at and not skip:
            b.words(page[at:lt])
        c = page[lt + 1]
        if c == "!" or c == "?":
            if page.startswith("<!--", lt):
                end = -1 if no_comment_end else page.find("-->", lt + 2)
                no_comment_end = end < 0
                at = end + 3 if end >= 0 else n  # an open comment hides the rest
            else:
                end = page.find(">", lt)
                at = end + 1 if end >= 0 else n
            continue
        m = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if m is None:
            if (c.isascii() and c.isalpha()) or c == "/":
                at = n  # a tag that the page's end cuts off
                continue
            if not skip:
                b.words("<")
            at = lt + 1
            continue
        at, closing, tag, attributes = m.end(), m[1], m[2].lower(), m[3]
        if skip:
            done = skip.see(closing, tag, attributes.endswith("/"), at, b)
            if done == "cut" and skip.any_block:
                kept.update(skip.starts)
                at, skip = skip.after, None
                continue
            if done:
                of, skip = skip.tag, None
                if done == "closed" or (of, tag) == ("select", "select"):
                    continue  # browsers take the second start tag of a select for its end tag
            elif closing or tag not in RAW or tag == "title" or attributes.endswith("/"):
                continue  # a title in an element without text is a drawing's
        if closing:
            if tag in BLOCKS:
                b.end(tag)
            elif tag == "a":
                b.link_from = -1
        elif tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.IGNORECASE).search(page, at)
            close = page.find(">", end.end()) if end else -1
            at = close + 1 if close >= 0 else n
            if end and not skip:
                b.words(" ")
        elif tag in SKIPPED:
            if not attributes.endswith("/") and at not in kept:
                skip = _Skip(tag, at)
        elif tag == "head":
            continue
        elif tag in BLOCKS:
            if tag == "hr":
                b.flush()
            elif tag not in ("html", "body"):
                b.start(tag, attributes)
        elif tag == "a":
            b.link_from = len(b.open) - 1
        elif tag == "br":
            b.words(" ")
    b.flush()
    return b.tree.pruned()
