"""Sections, chunks, classification, extraction, identity and URLs."""

from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkweft.config import build_config, collection_name, scope_prefix
from sparkweft.functions import text as T
from sparkweft.functions import url as U
from sparkweft.operators import chunks, classify, sections
from sparkweft.operators.html import Page


def test_section_hierarchy():
    found = sections.split("u", "intro\n# Root Topic\n\nRoot body text\n\n## Child Topic\n\nChild body text\n\n### Leaf Topic\n\nLeaf body text", 10)
    assert [len(s["section_path"]) for s in found] == [1, 2, 3]
    assert [s["parent_section_id"] for s in found] == [None, found[0]["section_id"], found[1]["section_id"]]
    assert found[2]["section_slug_path"] == ["root-topic", "child-topic", "leaf-topic"]
    assert found[1]["section_id"] == hashlib.sha256(b"u::child-topic::1").hexdigest()


def test_short_sections_leave_gaps_and_paths():
    found = sections.split("u", "# A\nlong enough body\n## B\nx\n### C\nlong enough body\n## D\nlong enough body", 10)
    assert [s["order_in_page"] for s in found] == [0, 2, 3]
    assert found[1]["section_path"] == ["A", "B", "C"] and found[1]["parent_section_id"] == found[0]["section_id"]
    assert found[2]["parent_section_id"] == found[0]["section_id"]


def test_preamble_and_root():
    assert sections.split("u", "before the heading\n# A\nlong enough body", 10)[0]["heading"] == "A"
    assert [s["heading"] for s in sections.split("u", "before the heading\n# A\nlong enough body", 10, keep_preamble=True)] == ["Document", "A"]
    assert sections.split("u", "plain text alone", 10)[0]["section_id"] == hashlib.sha256(b"u::root").hexdigest()
    assert sections.split("u", "short", 10) == [] == sections.split("u", "", 1)


def test_chunk_offsets():
    found = chunks.chunk("Sentence one. Sentence two. Sentence three. Sentence four.", 24, 8)
    assert [(c["start_char"], c["end_char"]) for c in found] == [(0, 13), (14, 27), (28, 43), (44, 58)]
    assert {c["chunk_strategy"] for c in found} == {"semantic_boundary"}


def test_long_unit_is_cut_and_passed_over_unless_lossless():
    text = "a" * 30 + ". Tail."
    found = chunks.chunk(text, 10, 2)
    assert [(c["start_char"], c["end_char"], c["chunk_strategy"]) for c in found] == [(0, 10, "char_window_fallback"), (32, 37, "semantic_boundary")]
    whole = chunks.chunk(text, 10, 2, lossless=True)
    covered = {k for c in whole for k in range(c["start_char"], c["end_char"])}
    assert covered >= {k for k, ch in enumerate(text) if ch != " "}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .!?\n", max_size=300), st.integers(1, 60), st.integers(0, 30), st.booleans())
def test_chunk_invariants(text, size, overlap, lossless):
    body, last = text.strip(), -1
    for c in chunks.chunk(text, size, overlap, lossless):
        assert body[c["start_char"] : c["end_char"]] == c["text"] == c["text"].strip() != ""
        assert c["end_char"] - c["start_char"] <= size and c["start_char"] > last - 1
        last = c["start_char"]


def test_navigation_page(spark):
    html = "<ul>" + "".join(f"<li><a href='/{n}'>{n}</a></li>" for n in ("Intro", "Install", "API", "CLI", "FAQ")) + "<li>x</li></ul>"
    row = classify.classify(spark.createDataFrame([(html, "Collapse all table of contents intro install api cli faq")], "html string, text string")).first()
    assert (row.doc_type, row.navigation_score, row.quality_score) == ("navigation", 0.75, 0.25)
    assert row.classification_signals.link_density == 0.375 and row.classification_signals.navigation_term_hits == 2


def test_page_extraction():
    p = Page("<title> A  title </title><body><nav>menu <a href='/m'>m</a></nav><main><h1>Head</h1><p>One &amp; two</p><ul><li>x</li></ul></main><footer>f</footer>", ["nav", ".toc", "#main"])
    assert p.extract() == ("A title", "Head One & two x", "# Head\n\nOne & two\n\n- x")
    assert p.toc("https://e.com/a/") == [{"url": "https://e.com/m", "text": "m", "level": 1, "ord": 0}]
    assert Page("<nav>only menu</nav>").extract()[1] == "only menu"


def test_toc_entries_keep_the_first_and_their_depth():
    html = "<div class='toc'><ul><li><a href='a'>A</a><ul><li><a href='b#x'>B</a></li></ul></li><li><a href='a'>again</a></li><li><a href=''>none</a></li></ul></div><aside><a href='c'>C</a></aside>"
    found = Page(html, ["aside", ".toc"]).toc("https://e.com/d/")
    assert [(e["url"], e["level"], e["ord"]) for e in found] == [("https://e.com/d/c", 1, 0), ("https://e.com/d/a", 2, 1), ("https://e.com/d/b#x", 3, 2)]


def test_toc_of_a_rendered_page():
    html = "<nav><a href='a'>A</a><a href='javascript:x()'>X</a></nav><p><a href='b'>B</a></p>"
    assert [e["url"] for e in Page(html, ["nav"]).toc("https://e.com/")] == ["https://e.com/a", "javascript:x()"]
    assert [(e["url"], e["level"]) for e in Page(html, ["nav"]).toc("https://e.com/", 5)] == [("https://e.com/a", 1), ("https://e.com/b", 1)]


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("https://docs.example.com/path/?b=2&a=1#anchor", "https://docs.example.com/path?a=1&b=2"),
        ("https://e.com", "https://e.com/"),
        ("https://e.com/a//", "https://e.com/a/"),
        ("https://e.com/a?x=&y", "https://e.com/a?x=&y="),
        ("HTTP://E.com/A;p=1", "http://E.com/A"),
    ],
)
def test_canonical(spark, url, want):
    assert U.canonical(url) == want


def test_wrapped_links():
    base = "https://ansyshelp.ansys.com/public/account/secured?returnurl=/Views/Secured/corp/v261/en/flu_ug/flu_ug.html/"
    assert U.absolute(base, "flu_ug_materials_task_page.html") == "https://ansyshelp.ansys.com/public/account/secured?returnurl=%2FViews%2FSecured%2Fcorp%2Fv261%2Fen%2Fflu_ug%2Fflu_ug_materials_task_page.html"
    assert U.absolute("https://e.com/a/b", "../c") == "https://e.com/c"


def test_scope(spark):
    urls = ["https://docs.e.com/manual/a", "https://docs.e.com/manual2", "ftp://docs.e.com/manual", "https://e.com.evil.org/manual", "https://docs.e.com/manual/search", "https://docs.e.com/manual"]
    d = spark.createDataFrame([(u,) for u in urls], "u string").select(U.scope_reason(F.col("u"), ["e.com"], ["/manual/"], ["/manual"], ["/search"]))
    assert [r[0] for r in d.collect()] == ["allowed", "outside_scope", "invalid_scheme", "outside_domain", "excluded_pattern", "allowed"]


def test_text_columns(spark):
    d = spark.createDataFrame([("  a  b\n c\x1c ", "Ünï code: Title!", "")], "t string, h string, e string")
    row = d.select(T.normalize_whitespace(F.col("t")), T.slugify(F.col("h")), T.slugify(F.col("e")), T.estimate_tokens(F.col("e")), T.content_hash(F.col("e"), F.col("h"))).first()
    assert tuple(row) == ("a b c", sections.slug("Ünï code: Title!"), "section", 1, hashlib.sha256("Ünï code: Title!".encode()).hexdigest())


def test_config():
    c = build_config("https://docs.e.com/v2/manual/index.html")
    assert c.allowed_path_prefixes == ("/v2/manual",) and c.include_patterns == ("/v2/manual",) and c.allowed_domains == ("docs.e.com",)
    assert c.collection == collection_name(c.root_url.rstrip("/")) == "docs-e-com-v2-manual-index-html"
    assert scope_prefix("https://e.com/s?returnurl=/a/b.html/") == "/a" and scope_prefix("https://e.com") is None
    with pytest.raises(ValueError):
        build_config("not a url")
