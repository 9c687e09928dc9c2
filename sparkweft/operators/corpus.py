"""The build: pages to documents, sections, chunks and embeddings, as one lazy plan."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkweft.config import Config
from sparkweft.functions.text import content_hash, first_filled
from sparkweft.operators.chunks import chunk_sections
from sparkweft.operators.classify import classify
from sparkweft.operators.embed import Embedder, build_embedder
from sparkweft.operators.html import extract_page
from sparkweft.operators.retrieve import embed_chunks
from sparkweft.operators.sections import sectionize
from sparkweft.session import cut_lineage


class Corpus(NamedTuple):
    documents: DataFrame
    sections: DataFrame
    chunks: DataFrame
    errors: DataFrame


def stats(corpus: Corpus) -> dict[str, int]:
    """Rows of each table, and pages by kind, in one job a table."""
    docs = corpus.documents.agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("doc_type") == "navigation").alias("navigation_documents"), F.count_if("indexed_for_retrieval").alias("indexed_documents")).first().asDict()
    return {**docs, **{n: getattr(corpus, n).count() for n in ("sections", "chunks", "errors")}}


def build(inventory: DataFrame, fetched: DataFrame, config: Config, embedder: Embedder | None = None) -> Corpus:
    """inventory: collection, canonical_url, url. fetched: url, html, status, error. Pages without html are in errors.

    Navigation pages stay as documents; they get sections and chunks only with index_navigation_pages.
    """
    joined = inventory.select("collection", "canonical_url", "url").join(fetched, "url", "left")
    errors = joined.filter("html is null").select("collection", "canonical_url", "url", F.coalesce("error", F.lit("not fetched")).alias("error"))
    pages = joined.filter("html is not null").withColumn("_x", extract_page("html")).select("collection", "canonical_url", F.col("url").alias("source_url"), "html", F.col("status").alias("http_status"), F.col("_x.title").alias("title"), F.col("_x.text").alias("text_content"), F.col("_x.markdown").alias("markdown_content"))
    documents = cut_lineage(classify(pages, "html", "text_content").withColumns({"content_hash": content_hash(F.col("markdown_content"), F.col("text_content")), "fetched_at": F.current_timestamp()}))
    wanted = documents if config.index_navigation_pages else documents.filter("doc_type <> 'navigation'")
    body = wanted.withColumn("markdown_content", first_filled(F.col("markdown_content"), F.col("text_content")))
    sections = cut_lineage(sectionize(body, "markdown_content", config.min_section_length, config.keep_preamble))
    chunks = embed_chunks(chunk_sections(sections, config.chunk_size, config.chunk_overlap, config.lossless_chunks), embedder or build_embedder(config))
    indexed = sections.filter(F.length("text") > 0).select("collection", "canonical_url").distinct().withColumn("indexed_for_retrieval", F.lit(True))
    documents = documents.join(indexed, ["collection", "canonical_url"], "left").withColumn("indexed_for_retrieval", F.coalesce("indexed_for_retrieval", F.lit(False)))
    return Corpus(documents, sections, chunks, errors)
