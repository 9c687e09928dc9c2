"""Evaluation of retrieval: the share of queries for which any expected URL was found (hit rate, reported as recall@k too)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def query_hits(retrieved: DataFrame, expected: DataFrame) -> DataFrame:
    """query, retrieved_urls (sorted), expected_urls, hit. retrieved: query, canonical_url; expected: query, expected_urls."""
    found = retrieved.groupBy("query").agg(F.array_sort(F.collect_set("canonical_url")).alias("retrieved_urls"))
    joined = expected.join(found, "query", "left").withColumn("retrieved_urls", F.coalesce("retrieved_urls", F.array().cast("array<string>")))
    return joined.select("query", "retrieved_urls", "expected_urls", F.coalesce(F.arrays_overlap("retrieved_urls", "expected_urls"), F.lit(False)).alias("hit"))


def hit_rate(hits: DataFrame) -> DataFrame:
    rate = F.coalesce(F.avg(F.col("hit").cast("double")), F.lit(0.0))
    return hits.agg(F.count(F.lit(1)).alias("queries"), rate.alias("hit_rate"), rate.alias("recall_at_k"))
