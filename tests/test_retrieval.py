"""Search, fusion, graph, coverage, discovery, tables, files and streams."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkweft.config import Config
from sparkweft.functions.vector import cosine_similarity
from sparkweft.operators import coverage, discovery, evaluate, fts, graph, incremental, nearest, retrieve, store
from sparkweft.operators.embed import HashingEmbedder, build_embedder, resolve_device
from sparkweft.operators.stemmer import stem
from sparkweft.sources import files, web
from sparkweft.streaming.ingest import PAGES, ingest, page_stream

M = "https://docs.example.com/manual"


def test_stems():
    words = {"caresses": "caress", "ponies": "poni", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster", "motoring": "motor", "conflated": "conflat", "hopping": "hop", "falling": "fall", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "vietnamization": "vietnam", "formative": "form", "hopeful": "hope", "adoption": "adopt", "probate": "probat", "rate": "rate", "controll": "control"}
    assert {w: stem(w) for w in words} == words


def test_search(spark):
    docs = spark.createDataFrame([(1, "The quick brown fox jumps"), (2, "a brown and quick dog"), (3, "quick quick foxes"), (4, None)], "id int, text string")
    index = fts.postings(docs, "id")
    queries = {1: "quick brown", 2: '"brown fox"', 3: "fox or dog", 4: "quick -brown", 5: "the and", 6: "-quick"}
    found = {}
    for r in fts.search(index, queries, "id", docs).collect():
        found.setdefault(r.query_id, set()).add(r.id)
    assert found == {1: {1, 2}, 2: {1}, 3: {1, 2, 3}, 4: {3}, 6: {4}}


def test_tokens_are_taken_by_the_first_letter_that_stems_keep():
    words = [a + b + c for a in ("", "b", "ay", "ski", "élan", "x9") for b in ("ies", "y", "eed", "ing", "ed", "ss", "iveness", "ational", "1") for c in ("", "s", "ed", "ing", "ment", "ly", "e", "é")]
    assert all(stem(w)[0] == w[0] for w in words)
    text = " ".join(words)
    for plain in (False, True):
        for head in "bisxé1":
            assert fts.analyze(text, plain, frozenset(head)) == [(t, k) for t, k in fts.analyze(text, plain) if t[0] == head] != []
    assert fts._term.cache_info().maxsize <= 1 << 16  # what a worker remembers is bounded


def test_cover_density():
    assert fts.cover_density([[(1, 1), (10, 10)], [(2, 2)]], 16) == 2.0
    assert fts.cover_density([[(1, 1)], [(33, 33)]], 16) == 16 / 33
    assert fts.cover_density([[(1, 1), (5, 5)]], 16) == 2.0


def test_more_queries_than_one_broadcast_holds(spark, monkeypatch):
    rows = spark.createDataFrame([(k, [float(k % 7), float(k % 5), 1.0]) for k in range(60)] + [(60, None)], "vec_id int, embedding array<float>")
    queries = spark.createDataFrame([(k // 2, [1.0, float(k), float(k % 3)]) for k in range(50)], "query_id int, query_vector array<float>")  # two of each id
    found = lambda: sorted(tuple(r) for r in retrieve.vector_topk_batch(rows, queries, 7, "vec_id").collect())
    whole = found()
    cuts = []
    monkeypatch.setattr(retrieve, "cut_lineage", lambda df, cut=getattr(retrieve, "cut_lineage", None): cuts.append(1) or cut(df), raising=False)
    monkeypatch.setattr(retrieve, "BROADCAST_ROWS", 20)
    assert found() == whole and len(whole) == 25 * 7 and len(cuts) == 3
    monkeypatch.setattr(retrieve, "BROADCAST_ROWS", 200_000)
    monkeypatch.setattr(retrieve, "BLOCK_BYTES", 1000, raising=False)
    assert found() == whole and len(cuts) == 3 + 5


def test_batch_search_joins_no_pairs_and_keeps_their_scores(spark):
    nan, inf, same = float("nan"), float("inf"), [0.1, 0.2, 0.3]
    odd = [[0.0] * 3, [nan, 1.0, 2.0], [inf, 1.0, 0.0], [1.0, None, 2.0], [1.0, 2.0], [], None, [1e-30] * 3, [3e38, 1e38, 0.0]]
    vectors = [odd[k % 13] if k % 13 < len(odd) else same if k % 2 else [float(k % 17 - 8), float(k % 5), 0.7] for k in range(300)]
    rows = spark.createDataFrame([(None if k == 5 else f"é{k}", v) for k, v in enumerate(vectors)], "vec_id string, embedding array<float>").repartition(3)
    queries = spark.createDataFrame([(k, v) for k, v in enumerate(vectors[:40])], "query_id int, query_vector array<float>")
    pairs = rows.filter("embedding is not null").crossJoin(queries).select("query_id", "vec_id", cosine_similarity(F.col("embedding"), F.col("query_vector")).alias("score"))
    made = retrieve.vector_topk_batch(rows, queries, 7, "vec_id")
    shown = lambda df: sorted(repr(tuple(r)) for r in df.select("query_id", "rank", "vec_id", "score").collect())
    assert shown(made) == shown(fts.ranked(pairs, 7, "vec_id"))
    assert "NestedLoopJoin" not in made._jdf.queryExecution().executedPlan().toString()
    best = nearest.Best(1, 2)
    for start in range(0, 1000, 100):  # what a task holds follows the queries, not the rows
        best.add(np.zeros(100, int), np.arange(start, start + 100) / 1000, np.zeros(100, bool), pa.array(range(start, start + 100)))
    assert len(best.kept) == 2 and best.bound.tolist() == [0.998] and not best.waiting


def test_rrf(spark):
    hits = spark.createDataFrame([(0, 1, "a", 0.9), (0, 2, "b", 0.8), (1, 1, "b", 0.95), (1, 2, "c", 0.7)], "list_ix int, rank int, chunk_id string, score double")
    got = [(r.chunk_id, round(r.score, 6), r.rank) for r in retrieve.reciprocal_rank_fusion(hits).orderBy("rank").collect()]
    assert got == [("b", 0.032522, 1), ("a", 0.016393, 2), ("c", 0.016129, 3)]
    tied = spark.createDataFrame([(0, 1, "x", 0.1), (1, 1, "w", 0.9)], "list_ix int, rank int, chunk_id string, score double")
    assert [r.chunk_id for r in retrieve.reciprocal_rank_fusion(tied).orderBy("rank").collect()] == ["x", "w"]


def test_hybrid_traces(spark):
    chunks = spark.createDataFrame([(f"c{k}", f"u{k}", "s", t) for k, t in enumerate(["install the package", "configure the server", "package index and server"])], "chunk_id string, canonical_url string, section_id string, text string")
    e = HashingEmbedder(32)
    traces = retrieve.HybridRetriever(retrieve.embed_chunks(chunks, e), e).search("docs", {1: "install package", 2: "the"}).collect()
    by = {t.query: t for t in traces}
    assert [h.chunk_id for h in by["install package"].lexical_hits] == ["c0"] and by["install package"].fused_hits[0].chunk_id == "c0"
    assert by["the"].lexical_hits == [] and len(by["the"].vector_hits) == 3 and by["the"].fused_hits[0].source == "rrf"
    nodes = retrieve.as_nodes(chunks.withColumn("score", F.lit(0.0))).first()
    assert nodes.score == 1.0


def test_embedders():
    assert resolve_device("cpu") == "cpu"
    with pytest.raises(ValueError):
        resolve_device("tpu")
    with pytest.raises(ValueError):
        build_embedder(Config(root_url=M, embedding_provider="none"))
    assert abs(sum(x * x for x in HashingEmbedder(16).embed_query("a b c")) - 1) < 1e-6


def test_a_model_gets_batches(spark):
    class Model:
        dimension = 1

        def embed_texts(self, texts):
            return [[float(len(texts))] for _ in texts]

    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, text string").coalesce(1)
    assert [r.embedding for r in retrieve.embed_chunks(rows, Model()).orderBy("id").collect()] == [[2.0], None, [2.0]]


def test_coverage_report(spark):
    root = "https://docs.example.com/root"
    inv = spark.createDataFrame([(root, "seed", 0, None, None), (f"{root}/topic-a", "toc", 1, root, None), (f"{root}/topic-b", "toc", 1, root, None)], "canonical_url string, source string, depth int, parent_canonical_url string, discovered_from string")
    docs = spark.createDataFrame([(root, "content", True), (f"{root}/topic-a", "navigation", False)], "canonical_url string, doc_type string, indexed_for_retrieval boolean")
    skipped = inv.filter(F.col("canonical_url").endswith("b")).withColumn("reason", F.lit("outside_scope"))
    r = coverage.coverage_report(inv, docs, skipped)
    assert (r["content_url_count"], r["navigation_url_count"], r["indexed_content_url_count"]) == (1, 1, 1)
    assert (r["seed_toc_level1_total"], r["seed_toc_level1_processed"], r["seed_toc_level1_rejected_by_reason"]) == (2, 1, {"outside_scope": 1})
    assert (r["expected_url_count"], r["crawled_url_count"], round(r["coverage_ratio"], 6)) == (3, 2, 0.666667)
    assert r["missing_urls"] == [f"{root}/topic-b"] and r["orphan_urls"] == [] and r["source_distribution"] == {"seed": 1, "toc": 2} and r["depth_distribution"] == {"0": 1, "1": 2}
    assert coverage.coverage_counts(inv.limit(0), docs, skipped.limit(0)).first().coverage_ratio == 0.0


def _site(spark):
    edges = [(f"{M}/", f"{M}/page-a", 0), (f"{M}/", f"{M}/page-b", 1), (f"{M}/page-a", f"{M}/page-c", 0)]
    toc = spark.createDataFrame([(a, b, "t", 1, o) for a, b, o in edges], "parent string, url string, text string, level int, ord int")
    pages = spark.createDataFrame([(f"{M}/", "x" * 10), (f"{M}/page-a", "y" * 10), (f"{M}/page-b", "z"), (f"{M}/page-c", "w")], "url string, html string")
    return spark.createDataFrame([(f"{M}/", "seed", 0)], "url string, source string, ord int"), pages, toc


def _urls(found):
    return [r.canonical_url.removeprefix(M) for r in found.inventory.orderBy("depth", "pos").collect()]


def test_discovery(spark):
    start, pages, toc = _site(spark)
    config = Config(root_url=f"{M}/", collection="m", allowed_domains=("docs.example.com",))
    found = discovery.discover(start, pages, toc, config)
    assert _urls(found) == ["", "/page-a", "/page-b", "/page-c"] and found.stopped_reason == "completed" and found.total_bytes == 22
    assert found.skipped.count() == 0
    cut = discovery.discover(start, pages, toc, Config(**{**config.__dict__, "max_pages": 2}))
    assert _urls(cut) == ["", "/page-a"] and cut.stopped_reason == "guard_rail_max_pages"
    assert {(r.canonical_url.removeprefix(M), r.reason) for r in cut.skipped.collect()} == {("/page-b", "guard_rail_max_pages"), ("/page-c", "guard_rail_max_pages")}
    assert _urls(discovery.discover(start, pages, toc, Config(**{**config.__dict__, "max_depth": 0}))) == [""]
    assert discovery.discovery_metrics(found.inventory, config).first().max_depth_discovered == 2


def test_start_from_sitemaps_and_robots(spark):
    start, pages, toc = _site(spark)
    maps = spark.createDataFrame([("https://docs.example.com/sitemap.xml", f"<urlset><url><loc>{M}/page-b</loc></url><url><loc>{M}/page-c</loc></url></urlset>")], "url string, html string")
    rules = "User-agent: *\nDisallow: /manual/page-c"
    config = Config(root_url=f"{M}/", collection="m", allowed_domains=("docs.example.com",), respect_robots_for_toc=True)
    first, blocked = discovery.starting(config, spark, rules, True, maps)
    assert [(r.url, r.source) for r in first.orderBy("ord").collect()] == [(f"{M}/", "seed"), (f"{M}/page-b", "sitemap")]
    assert [(r.canonical_url, r.reason) for r in blocked.collect()] == [(f"{M}/page-c", "blocked_by_robots")]
    found = discovery.discover(first, pages, toc, config, rules)
    assert _urls(found) == ["", "/page-b", "/page-a"] and {r.reason for r in found.skipped.collect()} == {"duplicate", "blocked_by_robots"}


def test_discovery_skips(spark):
    start, pages, toc = _site(spark)
    more = spark.createDataFrame([(f"{M}/page-b", f"{M}/page-a#x", "t", 1, 0), (f"{M}/page-b", "https://other.org/", "t", 1, 1), (f"{M}/page-b", f"{M}/gone", "t", 1, 2)], toc.schema)
    config = Config(root_url=f"{M}/", collection="m", allowed_domains=("docs.example.com",))
    found = discovery.discover(start, pages, toc.unionByName(more), config)
    assert {(r.canonical_url, r.reason) for r in found.skipped.collect()} == {(f"{M}/page-a", "duplicate"), ("https://other.org/", "outside_domain"), (f"{M}/gone", "fetch_error")}
    assert found.failures == 1
    stopped = discovery.discover(start, pages, toc.unionByName(more), Config(**{**config.__dict__, "max_total_bytes": 15}))
    assert _urls(stopped) == ["", "/page-a"] and stopped.stopped_reason == "guard_rail_total_bytes"


def test_graph(spark):
    rows = [("m", f"{M}/{c}", f"{M}/{c}", "toc", d, None, p, t, 1, o, None) for c, d, p, t, o in (("r", 0, None, "Root", None), ("a", 1, f"{M}/r", "A", 1), ("b", 1, f"{M}/r", "", 0), ("c", 2, f"{M}/a", "C", None), ("x", 1, "https://gone/", "X", None))]
    inv = spark.createDataFrame(rows, "collection string, url string, canonical_url string, source string, depth int, discovered_from string, parent_canonical_url string, link_text string, toc_level int, toc_order int, doc_version string")
    nodes = graph.build_nodes(inv)
    paths = {r.canonical_url.removeprefix(M): r.path for r in graph.hierarchy_of(inv.select("canonical_url"), nodes).collect()}
    assert paths == {"/r": ["Root"], "/a": ["Root", "A"], "/b": ["Root", f"{M}/b"], "/c": ["Root", "A", "C"], "/x": ["X"]}
    tree = graph.link_tree(nodes)
    assert tree["node_count"] == 5 and [n["title"] for n in tree["roots"]] == ["Root", "X"] and [n["title"] for n in tree["roots"][0]["children"]] == [f"{M}/b", "A"]
    assert graph.hierarchy_of(spark.createDataFrame([("nowhere",)], "canonical_url string"), nodes).first().path == []


def test_paths_end_at_cycles_and_reach_far(spark):
    loop = spark.createDataFrame([("a", "b", "A"), ("b", "c", "B"), ("c", "a", "C")], "node_id string, parent_node_id string, title string")
    assert {r.node_id: r.path for r in graph.ancestor_paths(loop).collect()} == {"a": ["C", "B", "A"], "b": ["A", "C", "B"], "c": ["B", "A", "C"]}
    chain = spark.range(41).select(F.col("id").cast("string").alias("node_id"), F.when(F.col("id") > 0, (F.col("id") - 1).cast("string")).alias("parent_node_id"), F.col("id").cast("string").alias("title"))
    assert graph.ancestor_paths(chain).filter("node_id = '40'").first().path == [str(k) for k in range(41)]


def test_paths_of_any_length(spark):
    """A chain of 300 nodes, and one of 150 that runs into a cycle of 100."""
    up = F.when(F.col("id") > 0, F.col("id") - 1)
    chain = spark.range(300).select("id", up.alias("parent"))
    loop = spark.range(1000, 1250).select("id", F.when(F.col("id") > 1000, F.col("id") - 1).otherwise(1099).alias("parent"))
    text = lambda c: F.col(c).cast("string")
    nodes = chain.unionByName(loop).select(text("id").alias("node_id"), text("parent").alias("parent_node_id"), text("id").alias("title"))
    got = {int(r.node_id): r for r in graph.ancestor_paths(nodes).collect()}
    assert all(got[k].path == [str(j) for j in range(k + 1)] and got[k].root_title == "0" and got[k].hops == k + 1 for k in range(300))
    assert got[1249].path == [str(j) for j in range(1000, 1250)]
    assert got[1050].path == [str(j) for j in [*range(1051, 1100), *range(1000, 1051)]] and len(got) == 550


def test_warehouse(spark, tmp_path):
    w = store.Warehouse(spark, f"file://{tmp_path}/wh")
    w.ensure_layout()
    docs = lambda rows: spark.createDataFrame(rows, "collection string, canonical_url string, title string").select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in store.TABLES["raw_documents"].schema if f.name not in ("collection", "canonical_url", "title")))
    w.upsert("raw_documents", docs([("m", "u1", "old"), ("m", "u2", "two"), ("n", "u1", "other")]))
    w.upsert("raw_documents", docs([("m", "u1", "new"), ("m", "u1", "newer")]).coalesce(1))
    assert {(r.collection, r.canonical_url, r.title) for r in w.read("raw_documents").collect()} == {("m", "u1", "newer"), ("m", "u2", "two"), ("n", "u1", "other")}
    full = lambda name, rows, ddl: spark.createDataFrame(rows, ddl).select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in store.TABLES[name].schema if f.name not in ddl))
    section = lambda rows: full("sections", rows, "collection string, section_id string, canonical_url string")
    chunk = lambda rows: full("chunks", rows, "collection string, chunk_id string, section_id string, canonical_url string")
    urls = spark.createDataFrame([("m", "u1"), ("m", "u2")], "collection string, canonical_url string")
    w.replace_sections(urls, section([("m", "s1", "u1"), ("m", "s2", "u2")]))
    w.replace_chunks(urls, chunk([("m", "c1", "s1", "u1"), ("m", "c2", "s2", "u2")]), spark.createDataFrame([("c1", [1.0])], "chunk_id string, embedding array<float>"))
    assert {(r.chunk_id, r.embedding is None) for r in w.read("chunks").collect()} == {("c1", False), ("c2", True)}
    w.replace_sections(urls.filter("canonical_url = 'u1'"), section([("m", "s3", "u1")]))
    assert {r.chunk_id for r in w.read("chunks").collect()} == {"c2"} and not any(w.broken_references().values())
    w.clear_collection("m")
    assert w.read("raw_documents").count() == 1 and w.read("chunks").count() == 0


def test_writes_touch_only_their_collections(spark, tmp_path, monkeypatch):
    w = store.Warehouse(spark, f"file://{tmp_path}/wh")
    w.ensure_layout()
    nodes = lambda rows: spark.createDataFrame(rows, "collection string, node_id string, title string").select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in store.TABLES["discovered_nodes"].schema if f.name not in ("collection", "node_id", "title")))
    files_of = lambda c: sorted(w.read("discovered_nodes", [c]).inputFiles())
    titles = lambda df: sorted((r.collection, r.node_id, r.title) for r in df.collect())
    w.upsert("discovered_nodes", nodes([("a/b", "1", "x"), ("ö", "1", "y")]))
    other, early = files_of("ö"), w.read("discovered_nodes")
    w.upsert("discovered_nodes", nodes([("a/b", "1", "z"), ("a/b", "2", "w")]))
    assert files_of("ö") == other and titles(w.read("discovered_nodes")) == [("a/b", "1", "z"), ("a/b", "2", "w"), ("ö", "1", "y")]
    assert titles(early) == [("a/b", "1", "x"), ("ö", "1", "y")]  # read before, run after
    read = w.read("discovered_nodes", ["ö"])._jdf.queryExecution().executedPlan().toString()
    assert "a/b" not in read and len(files_of("a/b")) > 0
    before = files_of("a/b")
    w.append("discovered_nodes", nodes([("a/b", "3", "v")]))
    assert set(before) < set(files_of("a/b")) and w.read("discovered_nodes", ["a/b"]).count() == 3
    w.clear_collection("a/b")
    assert titles(w.read("discovered_nodes")) == [("ö", "1", "y")] and files_of("ö") == other
    stale = w._pointer("discovered_nodes")
    w.upsert("discovered_nodes", nodes([("ö", "2", "n")]))
    monkeypatch.setattr(w, "_pointer", lambda name, real=w._pointer, first=[stale]: first.pop() if first else real(name))
    with pytest.raises(store.Conflict):
        w.upsert("discovered_nodes", nodes([("ö", "3", "lost")]))
    assert w.read("discovered_nodes").count() == 2
    with pytest.raises(ValueError):
        w.append("discovered_nodes", nodes([(None, "1", "x")]))
    brief = store.Warehouse(spark, f"file://{tmp_path}/wh", retain=0)
    brief.upsert("discovered_nodes", nodes([("ö", "4", "m")]))
    assert brief._pointer("discovered_nodes")["retired"] == [] and brief.read("discovered_nodes").count() == 3


def test_robots_and_sitemaps(spark):
    rules, maps = web.parse_robots("User-agent: *\nDisallow: /private\nSitemap: https://e.com/s.xml", "https://e.com/")
    assert maps == ["https://e.com/s.xml"] and not rules.can_fetch("b", "https://e.com/private/x") and rules.can_fetch("b", "https://e.com/x")
    assert not web.parse_robots("nothing here", "https://e.com/", status_ok=False)[0].can_fetch("b", "https://e.com/x")
    assert web.parse_robots(None, "https://e.com/")[0].can_fetch("b", "https://e.com/x") and len(web.parse_robots(None, "https://e.com/")[1]) == 2
    index = lambda tag, child, locs: f"<{tag} xmlns='x'>" + "".join(f"<{child}><loc>{u}</loc></{child}>" for u in locs) + f"</{tag}>"
    maps = spark.createDataFrame([("i", index("sitemapindex", "sitemap", ["i", "m", "bad"])), ("m", index("urlset", "url", ["u1", "u2", "u1"])), ("bad", "<no")], "url string, html string")
    assert {r.url for r in web.sitemap_urls(spark.createDataFrame([("i",)], "url string"), maps).collect()} == {"u1", "u2"}
    allowed = web.allowed_by_robots(spark.createDataFrame([("https://e.com/private/x",), ("https://e.com/y",)], "url string"), "User-agent: *\nDisallow: /private", "https://e.com/", "b")
    assert [r.allowed for r in allowed.orderBy("url").collect()] == [False, True]


def test_fetching(spark):
    class Flaky:
        def __init__(self):
            self.calls = {}

        def get(self, url):
            self.calls[url] = self.calls.get(url, 0) + 1
            if url == "dead" or self.calls[url] < 2:
                raise OSError("no " + url)
            return url + "/final", 200, "<p>"

        def close(self):
            pass

    rows = {r.url: r for r in web.fetch_table(spark.createDataFrame([("a",), ("a",), ("dead",)], "url string"), Flaky, attempts=3).collect()}
    assert set(rows) == {"a", "a/final", "dead"} and rows["a"].html == "<p>" and rows["dead"].error == "no dead"


def test_an_error_of_the_server_is_an_answer(spark):
    class Refusing:
        def get(self, url):
            if url.endswith("robots.txt"):
                error = OSError("HTTP Error 403: Forbidden")
                error.code = 403
                raise error
            raise OSError("no route")

        def close(self):
            pass

    rows = {r.url: r for r in web.fetch(spark.createDataFrame([("https://e.com/robots.txt",), ("https://f.com/",)], "url string"), Refusing, 1).collect()}
    assert web.robots_of(rows["https://e.com/robots.txt"]) == ("", False) and web.robots_of(rows["https://f.com/"]) == (None, True) and web.robots_of(None) == (None, True)
    rules = web.parse_robots(*(lambda t, ok: (t, "https://e.com/", ok))(*web.robots_of(rows["https://e.com/robots.txt"])))[0]
    assert not rules.can_fetch("b", "https://e.com/x")


def test_links_of_the_whole_page_where_its_contents_are_short(spark):
    page = "<nav><a href=/manual/a>A</a></nav><div><a href=/manual/b>B</a><a href=javascript:x()>no</a><a href=/manual/a>A again</a></div>"
    fetched = spark.createDataFrame([(f"{M}/", f"{M}/", page)], "url string, final_url string, html string")
    found = lambda n: [r.url.removeprefix(M) for r in discovery.links_of(fetched, Config(root_url=f"{M}/", toc_fallback_below=n)).orderBy("ord").collect()]
    assert found(0) == ["/a"] and found(5) == ["/a", "/b"]


def test_defaults_end_a_crawl():
    assert (Config(root_url=M).max_pages, Config(root_url=M).max_depth, Config(root_url=M).retry_backoff) == (300, 2, 2.0)


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([(1, "ä"), (2, None)], "a int, b string")
    files.write_jsonl(rows, f"{tmp_path}/x", order=["a"])
    assert files.read_jsonl(spark, f"{tmp_path}/x", "a int, b string").count() == 2
    assert files.read_jsonl(spark, f"{tmp_path}/none", "a int").count() == 0
    files.write_report(spark, {"ä": 1}, f"file://{tmp_path}/r.json")
    assert json.loads((tmp_path / "r.json").read_text()) == {"ä": 1}
    (tmp_path / "e.json").write_text(json.dumps([{"query": "q", "expected_urls": ["u"]}, {"query": "z", "expected_urls": ["v"]}]))
    found = spark.createDataFrame([("q", "u"), ("q", "w")], "query string, canonical_url string")
    hits = evaluate.query_hits(found, files.read_eval(spark, f"{tmp_path}/e.json"))
    assert evaluate.hit_rate(hits).first().hit_rate == 0.5 and evaluate.hit_rate(hits.limit(0)).first().hit_rate == 0.0


def test_incremental(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "canonical_url string, content_hash string")
    new = spark.createDataFrame([("a", "1"), ("b", "3"), ("d", "4"), ("c", None)], "canonical_url string, content_hash string")
    kinds = incremental.changes(old, new)
    assert {r.canonical_url: r.change_kind for r in kinds.collect()} == {"a": "unchanged", "b": "changed", "c": "unchanged", "d": "new"}
    assert incremental.change_report(kinds).first().asDict() == {"new_urls": 1, "gone_urls": 0, "changed_urls": 1, "unchanged_urls": 2, "all_urls": 4}
    state = spark.sql("select 'a' canonical_url, '1' content_hash, timestamp'2026-01-01' first_seen, timestamp'2026-01-01' last_seen, timestamp'2026-01-01' last_changed, 2 min_depth")
    run = spark.sql("select 'a' canonical_url, '2' content_hash, timestamp'2026-02-01' seen_at, 1 depth union all select 'b', '9', timestamp'2026-02-01', 3")
    after = {r.canonical_url: r for r in incremental.next_state(state, run).collect()}
    assert after["a"].min_depth == 1 and after["a"].first_seen.month == 1 and after["a"].last_changed.month == 2 and after["b"].first_seen.month == 2
    assert [(r.canonical_url, r.why) for r in incremental.to_crawl(incremental.next_state(state, run), 3, 5).collect()] == [("b", "expand")]
    urls = spark.sql("select 'a' canonical_url, 'processing' status, 1 attempts, timestamp'2026-01-01 00:00:00' leased_at union all select 'b', 'processing', 3, timestamp'2026-01-01 00:00:00' union all select 'c', 'done', 1, null")
    after = incremental.requeued(urls, F.lit("2026-01-01 01:00:00").cast("timestamp"), 60, 3)
    assert {r.canonical_url: r.status for r in after.collect()} == {"a": "pending", "b": "failed", "c": "done"}
    assert incremental.recovery_report(after).first().pending == 1
    kinds = spark.createDataFrame([("Next page",), ("»",), ("Materials",)], "t string").select(incremental.edge_kind(F.col("t")))
    assert [r[0] for r in kinds.collect()] == ["navigation_aux", "noise", "topic"]


def test_stream(spark, tmp_path):
    body = "<main><h1>T</h1><h2>P</h2><p>" + "A sentence of words that is long enough. " * 6 + "</p><p>x</p><p>y</p></main>"
    spark.createDataFrame([("m", "u1", "u1", body, 200, None), ("m", "u2", "u2", None, None, "gone")], PAGES).write.parquet(f"{tmp_path}/in")
    w = store.Warehouse(spark, f"file://{tmp_path}/wh")
    config = Config(root_url=M, embedding_dimension=16)
    for _ in range(2):
        ingest(page_stream(spark, f"{tmp_path}/in"), w, config, f"{tmp_path}/cp").awaitTermination()
    assert w.read("raw_documents").count() == 1 and w.read("chunks").count() >= 1 and not any(w.broken_references().values())


def test_command_line(spark, tmp_path, capsys):
    from sparkweft import cli

    body = lambda t: f"<nav><a href='{M}/b'>Second</a></nav><main><h2>{t}</h2><p>" + f"How to {t} the package on a server. " * 6 + "</p><p>x</p><p>y</p></main>"
    spark.createDataFrame([(f"{M}/", body("install")), (f"{M}/b", body("remove"))], "url string, html string").write.parquet(f"{tmp_path}/pages")
    wh = ["--warehouse", f"file://{tmp_path}/wh", "--embedding-dimension", "32"]
    assert cli.main(["build", "--root-url", M, "--collection", "m", "--pages", f"{tmp_path}/pages", *wh], spark) == 0
    made = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (made["discovered"], made["documents"], made["coverage_ratio"], made["stopped_reason"]) == (2, 2, 1.0, "completed") and made["chunks"] >= 2
    assert cli.main(["query", "--collection", "m", "--query", "remove package", *wh], spark) == 0
    first = json.loads(capsys.readouterr().out.strip().splitlines()[0])
    assert first["url"] == f"{M}/b" and first["path"].endswith("Second")
    (tmp_path / "e.json").write_text(json.dumps([{"query": "install", "expected_urls": [M]}]))
    assert cli.main(["eval", "--collection", "m", "--eval-file", f"{tmp_path}/e.json", *wh], spark) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["hit_rate"] == 1.0
    assert cli.Warehouse(spark, f"file://{tmp_path}/wh").read("retrieval_traces").count() == 2


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["rank", "doc_id", "score", "lang", "source"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
