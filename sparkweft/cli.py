"""Command line: crawl, index, build (both), query and eval over a warehouse folder.

    python -m sparkweft.cli build --root-url https://docs.example.com/manual/ --warehouse /shared/wh [--pages pages.parquet]
    python -m sparkweft.cli query --collection docs-example-com-manual --warehouse /shared/wh --query "install the package"
    python -m sparkweft.cli eval --collection ... --warehouse ... --eval-file questions.json

--pages is a table of url and html (offline); without it pages are fetched over HTTP.
"""

from __future__ import annotations

import argparse
import json
import sys
from urllib.parse import urljoin

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkweft.config import Config, build_config, configure_logging, data_paths
from sparkweft.operators import coverage, discovery, evaluate, fts, graph
from sparkweft.operators.corpus import build, stats
from sparkweft.operators.embed import build_embedder
from sparkweft.operators.retrieve import HybridRetriever
from sparkweft.operators.store import Warehouse
from sparkweft.session import cut_lineage
from sparkweft.sources import files, web

_KNOBS = {"max-pages": int, "max-depth": int, "max-runtime-minutes": int, "max-failures": int, "max-total-bytes": int, "retry-attempts": int, "retry-backoff": float, "toc-fallback-below": int, "chunk-size": int, "chunk-overlap": int, "min-section-length": int, "embedding-provider": str, "embedding-model": str, "embedding-dimension": int, "device": str, "lexical-limit": int, "vector-limit": int, "fused-limit": int, "rrf-k": int}
_LISTS = ("allowed-domains", "allowed-path-prefixes", "sitemap-urls", "toc-selectors", "include-patterns", "exclude-patterns")


def crawl(spark: SparkSession, config: Config, warehouse: Warehouse, pages: str | None) -> tuple[discovery.Discovery, DataFrame]:
    """Discover, keep inventory, skips, nodes and the tree, and give back what was fetched."""
    if pages:
        given = spark.read.parquet(pages)
        source = given.select("url", F.col("url").alias("final_url"), F.lit(200).alias("status"), "html", F.lit(None).cast("string").alias("error"))
        start, blocked = discovery.starting(config, spark)
    else:
        make = lambda: web.UrlFetcher(config.user_agent)
        source = lambda urls: web.fetch_table(urls, make, config.retry_attempts, config.retry_backoff)
        robots = web.fetch(spark.createDataFrame([(urljoin(config.root_url, "/robots.txt"),)], "url string"), make, 1).first()
        rules, readable = web.robots_of(robots)
        named = list(dict.fromkeys([*config.sitemap_urls, *web.parse_robots(rules, config.root_url, readable)[1]]))
        start, blocked = discovery.starting(config, spark, rules, readable, web.fetch(spark.createDataFrame([(u,) for u in named], "url string"), make, 1).filter("html is not null"))
    found = discovery.discover(start, source, None, config)
    found = found._replace(skipped=found.skipped.unionByName(blocked))
    paths = data_paths(warehouse.path, config.collection)
    files.write_jsonl(found.inventory.drop("pos"), paths["inventory"], order=["canonical_url"])
    files.write_jsonl(found.skipped, paths["skipped_urls"])
    nodes = graph.build_nodes(found.inventory)
    warehouse.upsert("discovered_nodes", nodes.withColumn("metadata", F.lit(None).cast("map<string, string>")))
    files.write_report(spark, graph.link_tree(nodes), paths["link_tree"])
    fetched = cut_lineage(source(found.inventory.select("url")) if callable(source) else source)
    return found, fetched


def index(spark: SparkSession, config: Config, warehouse: Warehouse, found: discovery.Discovery, fetched: DataFrame) -> dict:
    made = build(found.inventory, fetched, config)
    warehouse.clear_collection_content(config.collection)
    warehouse.upsert("raw_documents", made.documents.withColumn("metadata", F.lit(None).cast("map<string, string>")))
    urls = made.documents.select("collection", "canonical_url")
    warehouse.replace_sections(urls, made.sections)
    warehouse.replace_chunks(urls, made.chunks)
    warehouse.replace_postings(urls, fts.postings(made.chunks, "chunk_id", keep=("collection", "canonical_url")))
    run = spark.range(1).select(F.sha2(F.current_timestamp().cast("string"), 256).alias("run_id"), F.lit(config.collection).alias("collection"), F.current_timestamp().alias("started_at"), F.lit(found.stopped_reason).alias("status"), F.array(F.lit(config.root_url)).alias("seed_urls"))
    warehouse.upsert("crawl_runs", run)
    report = coverage.coverage_report(found.inventory, warehouse.read("raw_documents", [config.collection]), found.skipped, found.stopped_reason)
    files.write_report(spark, report, data_paths(warehouse.path, config.collection)["coverage"])
    return {**stats(made), "coverage_ratio": report["coverage_ratio"], "stopped_reason": found.stopped_reason}


def retriever(config: Config, warehouse: Warehouse) -> HybridRetriever:
    chunks = warehouse.read("chunks", [config.collection])
    return HybridRetriever(chunks, build_embedder(config), config.lexical_limit, config.vector_limit, config.fused_limit, config.rrf_k, warehouse.index_of(config.collection))


def answer(config: Config, warehouse: Warehouse, queries: dict[int, str], keep_traces: bool = True) -> DataFrame:
    """query, rank, canonical_url, chunk_id, score, text and the topic path of the fused hits; traces are kept."""
    traces = cut_lineage(retriever(config, warehouse).search(config.collection, queries))
    if keep_traces:
        plain = lambda n: F.transform(n, lambda h: h.dropFields("rank"))
        warehouse.append_trace(traces.withColumns({n: plain(n) for n in ("lexical_hits", "vector_hits", "fused_hits")}))
    hits = traces.select("query", F.explode("fused_hits").alias("h")).select("query", "h.*")
    return graph.hierarchy_of(hits, warehouse.read("discovered_nodes", [config.collection]))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="sparkweft", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("command", choices=["init", "crawl", "build", "query", "eval"])
    parser.add_argument("--warehouse", required=True)
    for name in ("root-url", "collection", "pages", "query", "eval-file"):
        parser.add_argument(f"--{name}")
    for name, kind in _KNOBS.items():
        parser.add_argument(f"--{name}", type=kind)
    for name in _LISTS:
        parser.add_argument(f"--{name}", nargs="*")
    parser.add_argument("--index-navigation-pages", action="store_true", default=None)
    parser.add_argument("--log-level", default="INFO")
    args = parser.parse_args(argv)
    configure_logging(args.log_level)
    spark = spark or SparkSession.builder.appName("sparkweft").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    warehouse = Warehouse(spark, args.warehouse)
    warehouse.ensure_layout()
    if args.command == "init":
        return 0
    knobs = {n.replace("-", "_"): getattr(args, n.replace("-", "_")) for n in (*_KNOBS, *_LISTS, "collection", "index-navigation-pages")}
    if args.command in ("crawl", "build"):
        if not args.root_url:
            parser.error("--root-url is needed")
        config = build_config(args.root_url, **knobs)
        found, fetched = crawl(spark, config, warehouse, args.pages)
        out = {"collection": config.collection, "discovered": found.inventory.count(), "skipped": found.skipped.count(), "stopped_reason": found.stopped_reason}
        print(json.dumps(out | (index(spark, config, warehouse, found, fetched) if args.command == "build" else {})))
        return 0
    if not args.collection:
        parser.error("--collection is needed")
    config = build_config("https://unused.invalid/", **knobs)
    if args.command == "query":
        for r in answer(config, warehouse, {1: args.query or ""}).orderBy("rank").collect():
            print(json.dumps({"rank": r.rank, "url": r.canonical_url, "path": " > ".join(r.path), "score": round(r.score, 6), "text": r.text[:200]}, ensure_ascii=False))
        return 0
    expected = files.read_eval(spark, args.eval_file)
    # A file of questions is read by people: its queries fit on the driver.
    found = answer(config, warehouse, dict(enumerate(r.query for r in expected.select("query").distinct().collect())))
    hits = evaluate.query_hits(found.select("query", "canonical_url"), expected)
    for r in hits.collect():
        print(json.dumps(r.asDict(), ensure_ascii=False))
    print(json.dumps(evaluate.hit_rate(hits).first().asDict()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
