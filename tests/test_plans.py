"""Physical plans: what is read, where top-k is cut, what is joined how."""

from __future__ import annotations

import re

import pytest

from sparkweft import session
from sparkweft.operators import corpus, retrieve
from sparkweft.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def plan(spark, name: str) -> str:
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    ("name", "columns"),
    [("vector_topk", {"vec_id", "embedding"}), ("lexical_and_match", {"doc_id", "text"}), ("grouped_by_url", {"doc_id", "lang", "source"}), ("url_scope_reason", {"page_id", "url"}), ("recent_documents", {"event_id", "user_id", "ts"})],
)
def test_only_needed_columns_are_read(spark, name, columns):
    read = re.findall(r"ReadSchema: struct<([^\n]*)>", plan(spark, name))
    assert read and {c.partition(":")[0] for c in re.split(r",(?![^<]*>)", read[0])} == columns


def test_filters_reach_the_scan(spark):
    assert "EqualTo(lang,en)" in plan(spark, "clear_collection") or "Not(EqualTo(lang,en))" in plan(spark, "clear_collection")
    assert "EqualTo(lang,en)" in plan(spark, "fk_orphans")


def test_top_k_is_cut_before_the_shuffle(spark):
    assert "TakeOrderedAndProject" in plan(spark, "vector_topk")
    assert "TakeOrderedAndProject" in plan(spark, "recent_documents")
    assert "WindowGroupLimit" in plan(spark, "vector_topk_batch")


def test_counts_are_combined_before_the_shuffle(spark):
    assert plan(spark, "source_distribution").count("HashAggregate") >= 2


@pytest.mark.parametrize("name", ["hybrid_retriever", "sections_hierarchy", "chunks", "corpus_build", "html_extract", "toc_entries_of_pages", "cover_density_plain", "nav_filtered_docs", "root_sections"])
def test_texts_come_to_python_a_hundred_rows_at_a_time(spark, name, monkeypatch):
    plans = []
    cut = session.cut_lineage
    for module in (corpus, retrieve):  # what stands before a cut is not in the plan of the result
        monkeypatch.setattr(module, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    plans.append(plan(spark, name))
    found = "\n".join(plans)
    assert "BatchEvalPython" in found and "ArrowEvalPython" not in found


def test_python_runs_once_a_row(spark, monkeypatch):
    plans = [plan(spark, "cover_density_plain")]
    cut = session.cut_lineage
    monkeypatch.setattr(retrieve, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    plan(spark, "hybrid_retriever")
    assert len(plans) == 3 and [p.count("BatchEvalPython") for p in plans] == [2, 2, 1]


@pytest.mark.parametrize("name", ["missing_urls", "orphan_urls", "upsert_documents", "replace_chunks", "incremental_changes", "duplicate_skips", "eval_hit_rate", "discovered_nodes"])
def test_joins_are_by_keys(spark, name):
    found = plan(spark, name)
    assert "CartesianProduct" not in found and not re.search(r"BroadcastNestedLoopJoin BuildRight, (LeftAnti|FullOuter|LeftOuter)", found)
