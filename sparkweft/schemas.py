"""Tables of a corpus: columns, keys and references. All but crawl_runs are partitioned by collection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import ArrayType, StructType

HIT = "struct<chunk_id: string, canonical_url: string, section_id: string, text: string, score: double, source: string>"


@dataclass(frozen=True)
class Table:
    ddl: str
    keys: tuple[str, ...]
    references: tuple[tuple[str, tuple[str, ...]], ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


TABLES = {
    "crawl_runs": Table("run_id string, collection string, started_at timestamp, status string, seed_urls array<string>", ("run_id",)),
    "raw_documents": Table(
        "collection string, canonical_url string, source_url string, title string, html string, text_content string, markdown_content string, http_status int, content_hash string, fetched_at timestamp, "
        "doc_type string, quality_score double, navigation_score double, classification_signals struct<link_density: double, paragraph_count: int, heading_count: int, list_item_count: int, navigation_term_hits: int>, indexed_for_retrieval boolean, metadata map<string, string>",
        ("collection", "canonical_url"),
    ),
    "discovered_nodes": Table(
        "collection string, node_id string, canonical_url string, url string, title string, source string, depth int, parent_node_id string, parent_canonical_url string, toc_level int, toc_order int, doc_version string, metadata map<string, string>",
        ("collection", "node_id"),
    ),
    "sections": Table(
        "collection string, section_id string, canonical_url string, heading string, level int, order_in_page int, text string, parent_section_id string, section_path array<string>, section_slug_path array<string>, doc_type string",
        ("collection", "section_id"), (("raw_documents", ("collection", "canonical_url")),),
    ),
    "chunks": Table(
        "collection string, chunk_id string, section_id string, canonical_url string, order_in_section int, text string, token_estimate int, heading string, section_path array<string>, start_char int, end_char int, chunk_strategy string, doc_type string, embedding array<float>",
        ("collection", "chunk_id"), (("sections", ("collection", "section_id")), ("raw_documents", ("collection", "canonical_url"))),
    ),
    "postings": Table("collection string, term string, chunk_id string, canonical_url string, positions array<int>", ("collection", "term", "chunk_id"), (("chunks", ("collection", "chunk_id")),)),
    "retrieval_traces": Table(f"trace_id string, collection string, query string, created_at timestamp, lexical_hits array<{HIT}>, vector_hits array<{HIT}>, fused_hits array<{HIT}>", ("trace_id",)),
}
INVENTORY = "collection string, url string, canonical_url string, source string, depth int, discovered_from string, doc_version string, parent_canonical_url string, link_text string, toc_level int, toc_order int"
SKIPPED = "url string, canonical_url string, source string, depth int, reason string, discovered_from string, parent_canonical_url string, link_text string, toc_level int, toc_order int, error string"


def check_embedding_size(chunks, dim: int) -> int:
    """Number of chunks whose embedding has another size than dim."""
    assert isinstance(chunks.schema["embedding"].dataType, ArrayType)
    return chunks.filter(f"embedding is not null and size(embedding) <> {int(dim)}").count()
