"""Retrieval: a lexical branch, a vector branch, reciprocal rank fusion, and the trace of what was found."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkweft.functions.vector import cosine_similarity
from sparkweft.operators import fts
from sparkweft.operators.embed import Embedder, embedding
from sparkweft.operators.nearest import nearest
from sparkweft.session import BROADCAST_ROWS, cut_lineage

#: Queries of a batch that are searched at once have at most about this many bytes (and BROADCAST_ROWS rows).
BLOCK_BYTES = 32 << 20


def vector_topk(chunks: DataFrame, query: list[float], k: int = 20, id_col: str = "chunk_id", vector_col: str = "embedding", assume_normalized: bool = False) -> DataFrame:
    """The k rows nearest to one query by cosine (score falling, then id): a scan and TakeOrderedAndProject."""
    q = F.array(*(F.lit(float(x)) for x in query))
    found = chunks.filter(F.col(vector_col).isNotNull()).select(id_col, cosine_similarity(F.col(vector_col), q, assume_normalized).alias("score"))
    return found.orderBy(F.col("score").desc(), id_col).limit(k)


def vector_topk_batch(chunks: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "chunk_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, id, score, rank for queries (query_id, query_vector): every query against every row.

    The queries are counted before they go to the workers; each task keeps its k best of a query before the shuffle
    (operators.nearest). More than one block may hold are dealt into blocks by their hash; one block after
    the other is searched and its hits are checkpointed, so the driver never holds more than a block.
    """
    wide = F.coalesce(F.greatest(F.size("query_vector"), F.lit(0)), F.lit(0)).cast("long")
    n, size = queries.agg(F.count(F.lit(1)), F.coalesce(F.sum(8 * wide + 64), F.lit(0))).first()
    blocks = max(1, -(-n // BROADCAST_ROWS), -(-size // BLOCK_BYTES))

    def best(some: DataFrame) -> DataFrame:
        return fts.ranked(nearest(chunks, some, k, id_col, vector_col), k, id_col)

    if blocks == 1:
        return best(queries)
    block = F.pmod(F.xxhash64("query_id", "query_vector"), F.lit(blocks))
    hits = [cut_lineage(best(queries.filter(block == b))).drop("rank") for b in range(blocks)]
    return fts.ranked(reduce(DataFrame.unionByName, hits), k, id_col)


def reciprocal_rank_fusion(hits: DataFrame, k: int = 60, limit: int | None = 8, id_col: str = "chunk_id", by: tuple[str, ...] = ()) -> DataFrame:
    """hits: list_ix, rank, id, score (and the columns in by). Score is the sum of 1 / (k + rank); an id that a list
    has twice counts twice. Equal scores keep the order of first sight: list, then rank."""
    seen = F.struct("list_ix", "rank")
    fused = hits.groupBy(*by, id_col).agg(F.sum(F.lit(1.0) / (F.lit(k) + F.col("rank"))).alias("score"), F.min(seen).alias("_seen"), F.min_by(F.col("score"), seen).alias("first_score"))
    order = Window.partitionBy(*(by or [F.lit(0)])).orderBy(F.col("score").desc(), "_seen")
    if not by and limit is not None:
        fused = fused.orderBy(F.col("score").desc(), "_seen").limit(limit)
    out = fused.withColumn("rank", F.row_number().over(order))
    return (out if limit is None else out.filter(F.col("rank") <= limit)).drop("_seen")


def hits_of(lists: list[DataFrame], id_col: str = "chunk_id", keep: tuple[str, ...] = (), limit: int = 1000) -> DataFrame:
    """Ranked lists as one frame with list_ix. A list without ranks is cut to its best `limit` (score falling, then id) before they are numbered."""
    out = None
    for k, one in enumerate(lists):
        ranked = one
        if "rank" not in one.columns:
            best = one.orderBy(F.col("score").desc(), id_col).limit(limit)
            ranked = fts.ranked(best.withColumn("_all", F.lit(0)), limit, id_col, ("_all",)).drop("_all")
        part = ranked.select(*keep, F.lit(k).alias("list_ix"), "rank", id_col, "score")
        out = part if out is None else out.unionByName(part)
    return out


def listed(hits: DataFrame, id_col: str = "chunk_id") -> DataFrame:
    """list_ix, ids: the ids of each list in the order of their ranks, joined by commas, as a trace keeps them."""
    ids = F.array_sort(F.collect_list(F.struct("rank", id_col)))
    return hits.groupBy("list_ix").agg(F.array_join(F.transform(ids, lambda s: s[id_col].cast("string")), ",").alias("ids"))


class HybridRetriever:
    """Both branches over one chunks table, for a batch of queries at once."""

    def __init__(self, chunks: DataFrame, embedder: Embedder, lexical_limit: int = 20, vector_limit: int = 20, fused_limit: int = 8, rrf_k: int = 60, index: DataFrame | None = None):
        self.chunks, self.embedder = chunks, embedder
        self.limits, self.k = (lexical_limit, vector_limit, fused_limit), rrf_k
        self.index = index  # stored postings; without them they are made for each batch of queries, of their terms alone

    def branches(self, queries: dict[int, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Lexical, vector and fused hits: query_id, chunk_id, score, rank. The first two are kept (a few rows a query), so that each is found once."""
        found = fts.search_texts(self.chunks, queries, "chunk_id") if self.index is None else fts.search(self.index, queries, "chunk_id", self.chunks.select("chunk_id"))
        lexical = cut_lineage(fts.ranked(found, self.limits[0], "chunk_id"))
        spark = self.chunks.sparkSession
        vectors = spark.createDataFrame([(q, self.embedder.embed_query(t)) for q, t in queries.items()], "query_id int, query_vector array<float>")
        vector = cut_lineage(vector_topk_batch(self.chunks, vectors, self.limits[1]))
        fused = reciprocal_rank_fusion(hits_of([lexical, vector], keep=("query_id",)), self.k, self.limits[2], by=("query_id",))
        return lexical, vector, fused.drop("first_score")

    def search(self, collection: str, queries: dict[int, str]) -> DataFrame:
        """Traces, one a query: trace_id, collection, query, created_at and the three lists of hits."""
        spark = self.chunks.sparkSession
        out = spark.createDataFrame(list(queries.items()), "query_id int, query string")
        for (name, source), hits in zip((("lexical_hits", "lexical"), ("vector_hits", "vector"), ("fused_hits", "rrf")), self.branches(queries), strict=True):
            out = out.join(self._lists(hits, name, source), "query_id", "left").withColumn(name, F.coalesce(name, F.array().cast(f"array<{self._hit()}>")))
        stamp = F.current_timestamp()
        return out.select(F.sha2(F.concat_ws("::", F.lit(collection), "query", stamp.cast("string")), 256).alias("trace_id"), F.lit(collection).alias("collection"), "query", stamp.alias("created_at"), "lexical_hits", "vector_hits", "fused_hits")

    @staticmethod
    def _hit() -> str:
        return "struct<rank: int, chunk_id: string, canonical_url: string, section_id: string, text: string, score: double, source: string>"

    def _lists(self, hits: DataFrame, name: str, source: str) -> DataFrame:
        full = hits.join(self.chunks.select("chunk_id", "canonical_url", "section_id", "text"), "chunk_id")
        hit = F.struct("rank", "chunk_id", "canonical_url", "section_id", "text", "score", F.lit(source).alias("source"))
        return full.groupBy("query_id").agg(F.array_sort(F.collect_list(hit)).alias(name))


def embed_chunks(chunks: DataFrame, embedder: Embedder, text_col: str = "text") -> DataFrame:
    return chunks.withColumn("embedding", embedding(F.col(text_col), embedder))


def as_nodes(hits: DataFrame) -> DataFrame:
    """What a chat front end takes: text, metadata and score (1.0 where it is null or zero)."""
    return hits.select("text", F.create_map(F.lit("chunk_id"), F.col("chunk_id"), F.lit("canonical_url"), F.col("canonical_url")).alias("metadata"), F.coalesce(F.nullif(F.col("score"), F.lit(0.0)), F.lit(1.0)).alias("score"))


def hit_text(hit_score: Column, ident: Column, digits: int = 6) -> Column:
    """A hit as text, for reports."""
    return F.concat(ident.cast("string"), F.lit(":"), F.format_number(hit_score, digits))
