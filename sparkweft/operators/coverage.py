"""Coverage of a crawl: what was expected, crawled, skipped and why. Everything is counted in Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkweft.functions.text import first_filled


def _or_unknown(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("unknown"))


def distribution(rows: DataFrame, column: str, name: str = "key") -> DataFrame:
    """Rows by the column as text (null: unknown)."""
    return rows.groupBy(_or_unknown(F.col(column)).alias(name)).agg(F.count(F.lit(1)).alias("n"))


def missing_urls(inventory: DataFrame, documents: DataFrame) -> DataFrame:
    return inventory.select("canonical_url").distinct().join(documents.select("canonical_url"), "canonical_url", "left_anti")


def orphan_urls(inventory: DataFrame, documents: DataFrame) -> DataFrame:
    return missing_urls(documents, inventory)


def coverage_counts(inventory: DataFrame, documents: DataFrame, skipped: DataFrame | None = None) -> DataFrame:
    """One row of counts; URLs are counted once, pages and skips each time."""
    urls = lambda d: d.select("canonical_url").distinct()
    flags = urls(inventory).withColumn("e", F.lit(1)).join(urls(documents).withColumn("c", F.lit(1)), "canonical_url", "full_outer")
    of_urls = flags.agg(F.count("e").alias("expected_url_count"), F.count("c").alias("crawled_url_count"), F.count_if(F.col("e").isNotNull() & F.col("c").isNotNull()).alias("both"))
    kind = F.coalesce(F.col("doc_type"), F.lit("content"))
    of_docs = documents.agg(
        F.count_if(kind != "navigation").alias("content_url_count"), F.count_if(kind == "navigation").alias("navigation_url_count"),
        F.count_if((kind != "navigation") & F.coalesce(F.col("indexed_for_retrieval"), F.lit(False))).alias("indexed_content_url_count"),
    )
    of_inventory = inventory.agg(F.count(F.lit(1)).alias("discovered_url_count"))
    of_skipped = skipped.agg(F.count(F.lit(1)).alias("skipped_url_count")) if skipped is not None else inventory.limit(0).agg(F.count(F.lit(1)).alias("skipped_url_count"))
    one = of_urls.crossJoin(of_docs).crossJoin(of_inventory).crossJoin(of_skipped)  # four frames of one row each
    return one.select("expected_url_count", "crawled_url_count", F.coalesce(F.try_divide("both", "expected_url_count"), F.lit(0.0)).alias("coverage_ratio"), "discovered_url_count", "content_url_count", "indexed_content_url_count", "navigation_url_count", "skipped_url_count")


def _level1(rows: DataFrame, seeds: DataFrame) -> DataFrame:
    """Rows of tables of contents at depth one whose parent is a seed."""
    parent = first_filled(F.col("parent_canonical_url"), F.col("discovered_from"))
    own = rows.filter((F.col("source") == "toc") & (F.col("depth") == 1)).withColumn("_parent", parent)
    return own.join(seeds.select(F.col("canonical_url").alias("_parent")).distinct(), "_parent", "left_semi").drop("_parent")


def level1_report(inventory: DataFrame, documents: DataFrame, skipped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row: seed_toc_level1_total, seed_toc_level1_processed; rejections by reason, each skip counted)."""
    seeds = inventory.filter("source = 'seed'")
    rejected = _level1(skipped, seeds)
    wanted = _level1(inventory, seeds).select("canonical_url").union(rejected.select("canonical_url")).distinct()
    crawled = documents.select("canonical_url").distinct().withColumn("_c", F.lit(1))
    totals = wanted.join(crawled, "canonical_url", "left").agg(F.count(F.lit(1)).alias("seed_toc_level1_total"), F.count("_c").alias("seed_toc_level1_processed"))
    return totals, distribution(rejected.join(crawled, "canonical_url", "left_anti"), "reason", "reason")


def _as_map(counts: DataFrame, key: str) -> dict[str, int]:
    return {r[key]: r["n"] for r in sorted(counts.collect(), key=lambda r: r[key])}


def coverage_report(inventory: DataFrame, documents: DataFrame, skipped: DataFrame, stopped_reason: str = "completed") -> dict:
    """The whole report; distributions have a row for each kind, the lists of URLs are streamed in order."""
    totals, rejected = level1_report(inventory, documents, skipped)
    listed = lambda d: [r[0] for r in d.orderBy("canonical_url").toLocalIterator()]
    return {
        **coverage_counts(inventory, documents, skipped).first().asDict(), "stopped_reason": stopped_reason,
        "missing_urls": listed(missing_urls(inventory, documents)), "orphan_urls": listed(orphan_urls(inventory, documents)),
        "source_distribution": _as_map(distribution(inventory, "source"), "key"), "depth_distribution": _as_map(distribution(inventory, "depth"), "key"),
        "skipped_by_reason": _as_map(distribution(skipped, "reason"), "key"), **totals.first().asDict(), "seed_toc_level1_rejected_by_reason": _as_map(rejected, "reason"),
    }


def processed_or_skipped(inventory: DataFrame, documents: DataFrame, skipped: DataFrame) -> DataFrame:
    """Each URL once that was both expected and crawled, or was skipped."""
    expected, crawled, left_out = (d.select("canonical_url") for d in (inventory, documents, skipped))
    return expected.intersect(crawled).union(left_out).distinct()
