"""Text and identity, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_all(c: Column) -> Column:
    """Without white space (of Unicode) at either end."""
    return F.regexp_replace(c, r"^(?U:[\s\x1c-\x1f])+|(?U:[\s\x1c-\x1f])+$", "")


def normalize_whitespace(c: Column) -> Column:
    return strip_all(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " "))


def estimate_tokens(c: Column) -> Column:
    """A quarter of the characters, at least one."""
    return F.greatest(F.lit(1), F.floor(F.length(c) / 4).cast("int"))


def sha256_hex(c: Column) -> Column:
    return F.sha2(c, 256)


def joined_id(*parts: Column) -> Column:
    """SHA-256 of the parts joined by two colons; null if a part is."""
    out = [parts[0].cast("string")]
    for p in parts[1:]:
        out += [F.lit("::"), p.cast("string")]
    return F.sha2(F.concat(*out), 256)


def node_id(collection: Column, canonical_url: Column) -> Column:
    return joined_id(collection, canonical_url)


def root_section_id(canonical_url: Column) -> Column:
    return joined_id(canonical_url, F.lit("root"))


def section_id(canonical_url: Column, slug: Column, index: Column) -> Column:
    return joined_id(canonical_url, slug, index)


def chunk_id(section: Column, order: Column) -> Column:
    return joined_id(section, order)


def content_hash(markdown: Column, text: Column) -> Column:
    """Of the markdown, or of the text where that is empty."""
    return F.sha2(F.coalesce(F.nullif(markdown, F.lit("")), text), 256)


def slugify(c: Column, fallback: str = "section") -> Column:
    slug = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit(fallback))


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))
