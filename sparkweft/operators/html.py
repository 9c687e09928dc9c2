"""What retrieval needs of a page, in one pass of the standard library's HTML parser: title, main text as plain text
and Markdown, counts of elements, and the entries of its tables of contents. Row by row."""

from __future__ import annotations

import re
from collections.abc import Sequence
from html.parser import HTMLParser

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from sparkweft.config import TOC_SELECTORS
from sparkweft.functions.rows import row_udf
from sparkweft.functions.url import absolute

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset("p div section article main ul ol li dl dt dd table tr td th pre blockquote h1 h2 h3 h4 h5 h6 header footer nav aside form figure figcaption body br hr".split())
_ASIDE = frozenset("nav aside header footer form script style noscript template button select textarea iframe svg".split())
_SILENT = frozenset("script style template noscript".split())
_CONSENT = re.compile("cookie|consent|gdpr", re.IGNORECASE)
_COMMENT = re.compile(r"\bcomments?\b", re.IGNORECASE)


def _squeezed(text: str) -> str:
    return " ".join(text.split())


class Page(HTMLParser):
    """Reads a page; afterwards its attributes hold what was found."""

    def __init__(self, html: str, selectors: Sequence[str] = ()):
        super().__init__(convert_charrefs=True)
        self.selectors = [(s[0] if s[0] in ".#" else "", s.lstrip(".#")) for s in selectors]
        self.stack: list[tuple[str, list[tuple[int, int]], bool, str | None]] = []  # tag, (selector, node) matched here, outside content, base URL
        self.nodes = 0
        self.counts = {"anchors": 0, "paragraphs": 0, "headings": 0, "list_items": 0}
        self.anchor_chars = 0
        self.titles: list[str] = []
        self.everything: list[str] = []
        self.blocks: list[tuple[str, str, bool]] = []  # tag, text, inside article or main
        self.links: list[dict] = []
        self._anchor: dict | None = None
        self._run: list[str] = []
        self.feed(html)
        self.close()
        self._end_anchor()
        self._flush()

    def _outside(self) -> bool:
        return bool(self.stack) and self.stack[-1][2]

    def _flush(self) -> None:
        text = _squeezed("".join(self._run))
        self._run.clear()
        if text:
            tags = [t for t, *_ in self.stack]
            tag = next((t for t in reversed(tags) if t in _BLOCKS), "body")
            self.blocks.append((tag, text, "article" in tags or "main" in tags))

    def _end_anchor(self) -> None:
        if self._anchor is not None:
            self._anchor["text"] = " ".join(self._anchor.pop("parts"))
            self.anchor_chars += len(self._anchor["text"])
            self._anchor = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _BLOCKS:
            self._flush()
        found = {k: v or "" for k, v in attrs}
        names = found.get("class", "").split()
        if tag == "p":
            self.counts["paragraphs"] += 1
        elif tag == "li":
            self.counts["list_items"] += 1
        elif len(tag) == 2 and tag[0] == "h" and tag[1] in "123456":
            self.counts["headings"] += 1
        elif tag == "a" and "href" in found:
            self._end_anchor()
            self.counts["anchors"] += 1
            base = next((b for *_, b in reversed(self.stack) if b), None)
            self._anchor = {"href": found["href"], "base": base, "parts": [], "within": [(s, n, sum(t in ("ul", "ol", "dl") for t, *_ in self.stack[k + 1 :])) for k, (_, hits, _, _) in enumerate(self.stack) for s, n in hits]}
            self.links.append(self._anchor)
        if tag in _VOID:
            return
        self.nodes += 1
        hits = [(k, self.nodes) for k, (kind, name) in enumerate(self.selectors) if (kind == "." and name in names) or (kind == "#" and found.get("id") == name) or (not kind and tag == name)]
        label = f"{found.get('class', '')} {found.get('id', '')}"
        in_article = any(t in ("article", "main") for t, *_ in self.stack)
        aside = tag in _ASIDE and not (tag == "header" and in_article) or bool(_CONSENT.search(label) or _COMMENT.search(label))
        self.stack.append((tag, hits, self._outside() or aside, found.get("data-base-url")))

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCKS:
            self._flush()
        if tag == "a":
            self._end_anchor()
        at = next((k for k in range(len(self.stack) - 1, -1, -1) if self.stack[k][0] == tag), None)
        if at is not None:
            del self.stack[at:]

    def handle_data(self, data: str) -> None:
        tag = self.stack[-1][0] if self.stack else ""
        if tag == "title":
            self.titles.append(data)
        if tag in _SILENT:
            return
        text = _squeezed(data)
        if text:
            self.everything.append(text)
            if self._anchor is not None:
                self._anchor["parts"].append(text)
        if tag != "title" and not self._outside():
            self._run.append(data)

    def extract(self) -> tuple[str, str, str]:
        """title, text, markdown; whole-page text for both where there is no main content."""
        title = _squeezed(" ".join(self.titles))
        inside = [b for b in self.blocks if b[2]] or self.blocks
        marks = {"li": "- ", "blockquote": "> ", **{f"h{k}": "#" * k + " " for k in range(1, 7)}}
        markdown = "\n\n".join(marks.get(tag, "") + text for tag, text, _ in inside)
        text = " ".join(text for _, text, _ in inside)
        if not text:
            text = markdown = " ".join(self.everything)
        return title, text, markdown

    def toc(self, base_url: str, whole_page_below: int = 0) -> list[dict]:
        """Links below the selected nodes, selector by selector; of an absolute URL the first. With fewer entries than
        whole_page_below (5 is usual for rendered pages) the page's other links follow; script links never count then."""
        placed = sorted(((s, n, k, level) for k, a in enumerate(self.links) if a["href"] for s, n, level in a["within"]))
        if whole_page_below:
            runs = [k for k, a in enumerate(self.links) if a["href"].strip().lower().startswith("javascript:")]
            placed = [x for x in placed if x[2] not in set(runs)]
            if len(placed) < whole_page_below:
                placed += [(len(self.selectors), 0, k, 0) for k, a in enumerate(self.links) if a["href"] and k not in set(runs)]
        out: dict[str, dict] = {}
        for _, _, k, level in placed:
            a = self.links[k]
            try:
                url = absolute(a["base"] or base_url, a["href"])
            except ValueError:  # an address that cannot be parsed
                continue
            if url not in out:
                out[url] = {"url": url, "text": a["text"], "level": level + 1, "ord": len(out)}
        return list(out.values())


@row_udf(StructType([StructField(n, StringType()) for n in ("title", "text", "markdown")]))
def extract_page(html: str | None) -> tuple[str, str, str]:
    return Page(html or "").extract()


@row_udf(StructType([StructField(n, IntegerType()) for n in ("anchors", "anchor_chars", "paragraphs", "headings", "list_items")]))
def dom_counts(html: str | None) -> dict[str, int]:
    page = Page(html or "")
    return {**page.counts, "anchor_chars": page.anchor_chars}


def toc_entries(html: Column, base_url: Column, selectors: Sequence[str] = TOC_SELECTORS, whole_page_below: int = 0) -> Column:
    """array of (url, text, level, ord)."""

    @row_udf("array<struct<url: string, text: string, level: int, ord: int>>")
    def entries(page: str | None, base: str | None) -> list[dict]:
        return Page(page or "", selectors).toc(base or "", whole_page_below)

    return entries(html, base_url)


def toc_links(html: Column, base_url: Column, selectors: Sequence[str] = TOC_SELECTORS) -> Column:
    return F.transform(toc_entries(html, base_url, selectors), lambda e: e["url"])
