"""Markdown into hierarchical sections.

A heading is up to six # and white space at a line's start. A section's text reaches to the next heading of any
level. Sections shorter than the least length are not emitted, yet their headings stay in the paths of those below,
whose parent is the nearest emitted one. Text before the first heading goes unless keep_preamble is set.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkweft.functions.rows import row_udf

_HEADING = re.compile(r"^(#{1,6})\s+(.+)$", re.MULTILINE)
SECTION = "struct<section_id: string, heading: string, level: int, order_in_page: int, text: string, parent_section_id: string, section_path: array<string>, section_slug_path: array<string>>"


def _id(*parts: object) -> str:
    return hashlib.sha256("::".join(map(str, parts)).encode()).hexdigest()


def slug(heading: str) -> str:
    return re.sub("[^a-z0-9]+", "-", heading.lower()).strip("-") or "section"


def split(url: str, markdown: str, least: int = 80, keep_preamble: bool = False) -> list[dict]:
    found = list(_HEADING.finditer(markdown))
    whole = {"section_id": _id(url, "root"), "heading": "Document", "level": 1, "order_in_page": 0, "parent_section_id": None, "section_path": ["Document"], "section_slug_path": ["document"]}
    ends = [*(m.start() for m in found[1:]), len(markdown)][: len(found)]
    out, above = [], []  # above: (level, heading, slug, id of the nearest emitted section at or over it)
    if keep_preamble or not found:
        text = markdown[: found[0].start() if found else None].strip()
        if len(text) >= least:
            out.append(whole | {"text": text})
    for k, (m, end) in enumerate(zip(found, ends, strict=True)):
        level, heading, body = len(m[1]), m[2].strip(), markdown[m.end() : end].strip()
        own, name = slug(heading), _id(url, slug(heading), k)
        above = above[: next((j for j, a in enumerate(above) if a[0] >= level), len(above))]
        parent = above[-1][3] if above else None
        emitted = len(body) >= least
        if emitted:
            path = [*(a[1] for a in above), heading]
            out.append({"section_id": name, "heading": heading, "level": level, "order_in_page": k, "text": body, "parent_section_id": parent, "section_path": path, "section_slug_path": [*(a[2] for a in above), own]})
        above.append((level, heading, own, name if emitted else parent))
    return out


def sections_of(url: Column, markdown: Column, least: int = 80, keep_preamble: bool = False) -> Column:
    @row_udf(f"array<{SECTION}>")
    def cut(url: str | None, text: str | None) -> list[dict]:
        return split(url or "", text or "", least, keep_preamble)

    return cut(url, markdown)


def sectionize(docs: DataFrame, markdown_col: str = "markdown_content", least: int = 80, keep_preamble: bool = False) -> DataFrame:
    """One row a section: collection, canonical_url, doc_type (if docs has it) and the section's columns."""
    keep = [c for c in ("collection", "canonical_url", "doc_type") if c in docs.columns]
    return docs.select(*keep, F.explode(sections_of(F.col("canonical_url"), F.col(markdown_col), least, keep_preamble)).alias("s")).select(*keep, "s.*")
