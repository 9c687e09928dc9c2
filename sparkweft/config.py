"""Settings of a build or a query, with the defaults that an installation starts from."""

from __future__ import annotations

import logging
import os
import re
from dataclasses import dataclass, field
from urllib.parse import parse_qs, urlsplit

#: Where tables of contents are looked for, and what is never followed.
TOC_SELECTORS = ("nav", "aside", ".sidebar", ".sphinxsidebar", ".toctree-wrapper", ".toc", "#toc", ".tree-node", ".nav-list", ".manual-toc", "#main_book_toc", ".main_book_toc", "#docs-menu", ".docs-nav", "#big_toc", ".big_toc_container")
EXCLUDE_PATTERNS = ("/search", "/genindex", "/py-modindex", "/login", "/logout")


@dataclass(frozen=True)
class Config:
    """All knobs; 0 (for max_depth: a negative number) means no limit.

    toc_fallback_below: of a page with fewer entries in its tables of contents than this, all links are followed (5 is
    usual where pages are rendered). retry_backoff: seconds between attempts.
    """

    root_url: str
    collection: str = ""
    allowed_domains: tuple[str, ...] = ()
    allowed_path_prefixes: tuple[str, ...] = ()
    sitemap_urls: tuple[str, ...] = ()
    toc_selectors: tuple[str, ...] = TOC_SELECTORS
    include_patterns: tuple[str, ...] = ()
    exclude_patterns: tuple[str, ...] = EXCLUDE_PATTERNS
    max_pages: int = 300
    max_depth: int = 2
    max_runtime_minutes: int = 0
    max_failures: int = 0
    max_total_bytes: int = 0
    respect_robots_for_toc: bool = False
    user_agent: str = field(default_factory=lambda: os.environ.get("SPARKWEFT_USER_AGENT", "sparkweft/0.1"))
    retry_attempts: int = 3
    retry_backoff: float = 2.0
    toc_fallback_below: int = 0
    chunk_size: int = 1200
    chunk_overlap: int = 150
    min_section_length: int = 80
    lossless_chunks: bool = False
    keep_preamble: bool = False
    index_navigation_pages: bool = False
    embedding_provider: str = "hashing"
    embedding_model: str = ""
    embedding_dimension: int = 384
    embedding_batch: int = 32
    device: str = "auto"
    lexical_limit: int = 20
    vector_limit: int = 20
    fused_limit: int = 8
    rrf_k: int = 60


def build_config(root_url: str, **knobs) -> Config:
    """A Config with what follows from the root: collection, domain, path scope and include pattern, unless given."""
    parts = urlsplit(root_url)
    if parts.scheme not in ("http", "https") or not parts.netloc:
        raise ValueError(f"not an absolute http(s) URL: {root_url!r}")
    knobs = {k: tuple(v) if isinstance(v, list) else v for k, v in knobs.items() if v is not None}
    prefix = scope_prefix(root_url)
    knobs.setdefault("collection", os.environ.get("SPARKWEFT_COLLECTION") or collection_name(root_url))
    knobs.setdefault("allowed_domains", (parts.netloc.lower(),))
    if prefix:
        knobs.setdefault("allowed_path_prefixes", (prefix,))
        if prefix != "/":
            knobs.setdefault("include_patterns", (prefix,))
    return Config(root_url=normalized_root(root_url), **knobs)


def normalized_root(url: str) -> str:
    """The root with a slash at its end, unless a query or fragment follows the path."""
    if "?" in url or "#" in url or urlsplit(url).path.endswith("/"):
        return url
    return url + "/"


def scope_prefix(url: str) -> str | None:
    """The directory that crawling stays in: the path (of returnurl, if there is one) without a file's name."""
    parts = urlsplit(url)
    inner = parse_qs(parts.query).get("returnurl")
    path = urlsplit(inner[0]).path if inner else parts.path
    if not path:
        return None
    segments = path.rstrip("/").split("/")
    if "." in segments[-1]:
        segments.pop()
    return "/" + "/".join(s for k, s in enumerate(segments) if s or k)


def collection_name(url: str) -> str:
    parts = urlsplit(url)
    return re.sub("[^a-z0-9]+", "-", f"{parts.netloc}-{parts.path}".lower()).strip("-") or "default-collection"


def data_paths(root: str, collection: str) -> dict[str, str]:
    """Where a collection's files are, below a folder of any file system."""
    base = f"{root.rstrip('/')}/{collection}"
    raw = {n: f"{base}/raw/{n}.jsonl" for n in ("inventory", "skipped_urls", "discovered_nodes")} | {"link_tree": f"{base}/raw/link_tree.json", "discovery_report": f"{base}/raw/discovery_report.json"}
    return raw | {n: f"{base}/processed/{n}.jsonl" for n in ("documents", "sections", "chunks")} | {"coverage": f"{base}/processed/coverage.json"}


def configure_logging(level: str = "INFO") -> logging.Logger:
    """The library's logger at a level given by name; an unknown name raises ValueError."""
    number = logging.getLevelNamesMapping().get(level.upper())
    if number is None:
        raise ValueError(f"unknown log level: {level}")
    logging.basicConfig(level=number, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    return logging.getLogger("sparkweft")
