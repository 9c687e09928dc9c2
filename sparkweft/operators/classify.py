"""Navigation or content: counts of a page's elements, scored by native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkweft.operators.html import dom_counts

#: Fixed value: words of pages that only navigate.
NAVIGATION_TERMS = r"(?i)\b(collapse\s+all|table\s+of\s+contents|toc|navigation|index|next|previous)\b"
NAVIGATION_FROM = 0.55


def term_hits(text: Column) -> Column:
    """Navigation words among the first 12,000 characters."""
    return F.regexp_count(F.substring(text, 1, 12000), F.lit(NAVIGATION_TERMS))


def link_density(anchor_chars: Column, text: Column) -> Column:
    return anchor_chars / F.greatest(F.lit(1), F.length(text))


def navigation_score(density: Column, paragraphs: Column, headings: Column, list_items: Column, hits: Column) -> Column:
    parts = [
        F.when(density >= 0.60, 0.50).when(density >= 0.40, 0.30),
        F.when(paragraphs <= 2, 0.20).when(paragraphs <= 5, 0.10),
        F.when(headings <= 1, 0.10),
        F.when(hits > 0, 0.30),
        F.when(list_items > F.greatest(F.lit(5), 3 * paragraphs), 0.15),
    ]
    total = F.lit(0.0)
    for p in parts:
        total = total + F.coalesce(p, F.lit(0.0))
    return F.least(F.lit(1.0), total)


def doc_type(score: Column) -> Column:
    # Sums of the parts lie either below or at the bound but for rounding of the last bits.
    return F.when(score >= NAVIGATION_FROM - 1e-9, "navigation").otherwise("content")


def classify(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """pages with doc_type, quality_score, navigation_score and classification_signals."""
    d = pages.withColumn("_dom", dom_counts(html_col)).withColumn("_hits", F.coalesce(term_hits(F.col(text_col)), F.lit(0)))
    density = link_density(F.col("_dom.anchor_chars"), F.coalesce(F.col(text_col), F.lit("")))
    score = navigation_score(density, F.col("_dom.paragraphs"), F.col("_dom.headings"), F.col("_dom.list_items"), F.col("_hits"))
    signals = F.struct(F.round(density, 4).alias("link_density"), F.col("_dom.paragraphs").alias("paragraph_count"), F.col("_dom.headings").alias("heading_count"), F.col("_dom.list_items").alias("list_item_count"), F.col("_hits").cast("int").alias("navigation_term_hits"))
    d = d.withColumn("_score", score)
    return d.withColumns({"doc_type": doc_type(F.col("_score")), "quality_score": F.round(F.greatest(F.lit(0.0), 1 - F.col("_score")), 4), "navigation_score": F.round("_score", 4), "classification_signals": signals}).drop("_dom", "_hits", "_score")
