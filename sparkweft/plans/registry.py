"""Registered queries of the retrieval engine and the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkweft.config import TOC_SELECTORS, Config
from sparkweft.functions import text as T
from sparkweft.functions import url as U
from sparkweft.operators import coverage, discovery, evaluate, fts, graph, incremental, retrieve, store
from sparkweft.operators.chunks import chunk_sections
from sparkweft.operators.classify import classify, doc_type, navigation_score, term_hits
from sparkweft.operators.corpus import build
from sparkweft.operators.embed import HashingEmbedder
from sparkweft.operators.html import dom_counts, extract_page, toc_entries
from sparkweft.operators.sections import sectionize
from sparkweft.session import dealt, read, spread
from sparkweft.streaming.ingest import event_counts

QUERIES, ORACLES = {}, {}
TERMS = ["ther", "reti"]
PHRASES = {1: '"th ther"', 2: "reti or edti", 3: "ther -reti"}
#: Rules of the scope queries.
DOMAINS, PREFIXES, INCLUDES, EXCLUDES = ["example.com", "example.net"], ["/en", "/fr"], ["/"], ["utm_", "/search"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- vectors and fusion

_SIM = "list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = {q}))"


def _vector(spark: SparkSession, sf_dir: str, vec_id: int) -> list[float]:
    return read(spark, sf_dir, "embeddings").filter(F.col("vec_id") == vec_id).select("embedding").first()[0]


@query(f"SELECT vec_id, round({_SIM.format(q=0)}, 6) AS score FROM embeddings WHERE embedding IS NOT NULL ORDER BY {_SIM.format(q=0)} DESC, vec_id LIMIT 20")
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = retrieve.vector_topk(read(spark, sf_dir, "embeddings"), _vector(spark, sf_dir, 0), 20, "vec_id")
    return found.select("vec_id", F.round("score", 6).alias("score"))


@query(
    """SELECT query_id, vec_id, score, rank FROM (
         SELECT q.vec_id::INT AS query_id, e.vec_id, round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS score,
                row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) DESC, e.vec_id)::INT AS rank
         FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0) WHERE rank <= 20"""
)
def vector_topk_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: every row whose id is divisible by 50; they are searched among all rows."""
    e = read(spark, sf_dir, "embeddings")
    queries = e.filter("vec_id % 50 = 0").select(F.col("vec_id").cast("int").alias("query_id"), F.col("embedding").alias("query_vector"))
    return retrieve.vector_topk_batch(dealt(e), queries, 20, "vec_id").select("query_id", "vec_id", F.round("score", 6).alias("score"), "rank")


_TF = "len(list_filter(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+'), lambda w: w = '{t}'))"
_MATCH = f"SELECT doc_id, ({' + '.join(_TF.format(t=t) for t in TERMS)})::DOUBLE AS score FROM documents WHERE {' AND '.join(_TF.format(t=t) + ' > 0' for t in TERMS)}"


@query(_MATCH)
def lexical_and_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fts.and_match(spread(read(spark, sf_dir, "documents")), TERMS, "doc_id")


@query(f"SELECT * FROM ({_MATCH}) ORDER BY score DESC, doc_id LIMIT 20")
def lexical_tf_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fts.and_match(spread(read(spark, sf_dir, "documents")), TERMS, "doc_id").orderBy(F.col("score").desc(), "doc_id").limit(20)


_RANKED = f"""lex AS (SELECT doc_id, score, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 0 AS l FROM ({_MATCH}) QUALIFY rank <= 20),
  vec AS (SELECT vec_id AS doc_id, {_SIM.format(q=0)} AS score, row_number() OVER (ORDER BY {_SIM.format(q=0)} DESC, vec_id) AS rank, 1 AS l FROM embeddings QUALIFY rank <= 20),
  hits AS (SELECT * FROM lex UNION ALL SELECT * FROM vec),
  fused AS (SELECT doc_id, sum(1.0::DOUBLE / (60 + rank)) AS score, min(struct_pack(l := l, r := rank)) AS seen FROM hits GROUP BY doc_id),
  ordered AS (SELECT doc_id, score, row_number() OVER (ORDER BY score DESC, seen) AS rank FROM fused)"""


def _branches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [lexical_tf_topk(spark, sf_dir), retrieve.vector_topk(read(spark, sf_dir, "embeddings"), _vector(spark, sf_dir, 0), 20, "vec_id").withColumnRenamed("vec_id", "doc_id")]


@query(f"WITH {_RANKED} SELECT doc_id, round(score, 6) AS score, rank::INT AS rank FROM ordered")
def rrf_fuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = retrieve.hits_of(_branches(spark, sf_dir), "doc_id")
    return retrieve.reciprocal_rank_fusion(hits, 60, None, "doc_id").select("doc_id", F.round("score", 6).alias("score"), "rank")


@query(f"WITH {_RANKED} SELECT rank::INT AS rank, doc_id, round(score, 6) AS score, lang, source FROM ordered JOIN documents USING (doc_id) WHERE rank <= 8")
def hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    fused = retrieve.reciprocal_rank_fusion(retrieve.hits_of(_branches(spark, sf_dir), "doc_id"), 60, 8, "doc_id")
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return docs.join(F.broadcast(fused), "doc_id").select("rank", "doc_id", F.round("score", 6).alias("score"), "lang", "source")


@query(
    f"""WITH {_RANKED} SELECT 'ther reti' AS query, (SELECT string_agg(doc_id, ',' ORDER BY rank) FROM lex) AS lexical_hits, (SELECT string_agg(doc_id, ',' ORDER BY rank) FROM vec) AS vector_hits,
        (SELECT string_agg(doc_id, ',' ORDER BY rank) FROM ordered WHERE rank <= 8) AS fused_hits"""
)
def retrieval_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = retrieve.hits_of(_branches(spark, sf_dir), "doc_id")
    fused = retrieve.reciprocal_rank_fusion(hits, 60, 8, "doc_id").select(F.lit(2).alias("list_ix"), "rank", "doc_id", "score")
    pick = lambda k: F.max(F.when(F.col("list_ix") == k, F.col("ids")))
    return retrieve.listed(hits.unionByName(fused), "doc_id").agg(F.lit(" ".join(TERMS)).alias("query"), pick(0).alias("lexical_hits"), pick(1).alias("vector_hits"), pick(2).alias("fused_hits"))


@query()
def hybrid_retriever(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = spread(read(spark, sf_dir, "documents")).select(F.col("doc_id").cast("string").alias("chunk_id"), F.col("source").alias("canonical_url"), F.col("lang").alias("section_id"), "text")
    embedder = HashingEmbedder(64)
    found = retrieve.HybridRetriever(retrieve.embed_chunks(chunks, embedder), embedder).branches({1: "ther reti", 2: '"the of" or thing -ther'})[2]
    return found.select("query_id", "rank", "chunk_id", F.round("score", 6).alias("score"))


# --- full text


@query()
def lexical_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fts.search_texts(spread(read(spark, sf_dir, "documents")), PHRASES, "doc_id")
    return found.select("query_id", "doc_id")


@query()
def lexical_cover_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fts.search_texts(spread(read(spark, sf_dir, "documents")), {1: "ther reti", 2: "thing ther edti"}, "doc_id")
    return fts.ranked(found, 20, "doc_id").select("query_id", "rank", "doc_id", F.round("score", 6).alias("score"))


#: Tokens with their places, for the same searches by the plain analysis (no stop words, no stems).
_TOKENS = "tok AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS p FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w FROM documents))"
_HAS = "SELECT doc_id FROM tok WHERE t = '{t}'"


@query(
    f"""WITH {_TOKENS} SELECT DISTINCT 1 AS query_id, a.doc_id FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.p = a.p + 1 WHERE a.t = 'th' AND b.t = 'ther'
        UNION ALL SELECT DISTINCT 2, doc_id FROM tok WHERE t IN ('reti', 'edti')
        UNION ALL SELECT DISTINCT 3, doc_id FROM ({_HAS.format(t="ther")}) WHERE doc_id NOT IN ({_HAS.format(t="reti")})"""
)
def lexical_phrase_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fts.search_texts(spread(read(spark, sf_dir, "documents")), PHRASES, "doc_id", plain=True)
    return found.select("query_id", "doc_id")


_COVERS = """SELECT {q} AS query_id, doc_id, sum(CASE WHEN p - q + 1 <= 16 THEN 1.0::DOUBLE ELSE 16.0::DOUBLE / (p - q + 1) END) AS score FROM (
  SELECT doc_id, t, p, lag(t) OVER w AS u, lag(p) OVER w AS q FROM tok WHERE t IN ('{a}', '{b}') WINDOW w AS (PARTITION BY doc_id ORDER BY p)) WHERE u <> t GROUP BY doc_id"""


@query(
    f"""WITH {_TOKENS} SELECT query_id, rank::INT AS rank, doc_id, round(score, 6) AS score FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM ({_COVERS.format(q=1, a="ther", b="reti")} UNION ALL {_COVERS.format(q=2, a="thing", b="ther")})) WHERE rank <= 20"""
)
def cover_density_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two words the minimal covers are the neighbours that differ."""
    found = fts.search_texts(spread(read(spark, sf_dir, "documents")), {1: "ther reti", 2: "thing ther"}, "doc_id", plain=True)
    return fts.ranked(found, 20, "doc_id").select("query_id", "rank", "doc_id", F.round("score", 6).alias("score"))


# --- URLs and text

_BASE = "regexp_extract(url, '^([^?#]*)', 1)"
_SLASHED = f"CASE WHEN regexp_matches({_BASE}, '^[a-zA-Z]+://[^/]*$') THEN {_BASE} || '/' ELSE {_BASE} END"
_CUT = f"CASE WHEN regexp_matches({_SLASHED}, '://[^/]*/.+/$') THEN regexp_replace({_SLASHED}, '/$', '') ELSE {_SLASHED} END"
_PAIRS = "array_to_string(list_transform(list_sort(list_transform(list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'), lambda x: x <> ''), lambda x: struct_pack(k := regexp_extract(x, '^([^=]*)', 1), v := regexp_extract(x, '=(.*)$', 1)))), lambda s: s.k || '=' || s.v), '&')"
_CANONICAL = f"CASE WHEN {_PAIRS} = '' THEN {_CUT} ELSE {_CUT} || '?' || {_PAIRS} END"
_HOST = "lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1))"
_PATH = "coalesce(nullif(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), ''), '/')"


@query(f"SELECT page_id, {_CANONICAL} AS canonical_url FROM pages")
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", U.canonical_native(F.col("url")).alias("canonical_url"))


@query(f"SELECT page_id, {_CANONICAL} AS canonical_url FROM pages")
def url_canonical_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", U.canonicalize_url("url").alias("canonical_url"))


_IN_DOMAIN = "(" + " OR ".join(f"{_HOST} = '{d}' OR ends_with({_HOST}, '.{d}')" for d in DOMAINS) + ")"
_IN_PREFIX = "(" + " OR ".join(f"rtrim({_PATH}, '/') = '{p}' OR starts_with({_PATH}, '{p}/')" for p in PREFIXES) + ")"


@query(
    f"""SELECT page_id, CASE WHEN NOT regexp_matches(url, '^https?:') THEN 'invalid_scheme' WHEN NOT {_IN_DOMAIN} THEN 'outside_domain' WHEN NOT {_IN_PREFIX} THEN 'outside_scope'
        WHEN NOT contains(url, '/') THEN 'not_matching_include_pattern' WHEN {' OR '.join(f"contains(url, '{x}')" for x in EXCLUDES)} THEN 'excluded_pattern' ELSE 'allowed' END AS reason FROM pages"""
)
def url_scope_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", U.scope_reason(F.col("url"), DOMAINS, PREFIXES, INCLUDES, EXCLUDES).alias("reason"))


@query(f"SELECT page_id, {_IN_DOMAIN} AS inside FROM pages")
def url_host_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", U.same_domain(F.col("url"), DOMAINS).alias("inside"))


@query(f"SELECT page_id, list_filter(string_split({_PATH.replace('url', 'u')}, '/'), lambda s: starts_with(lower(s), 'v') AND regexp_matches(s, '[0-9]'))[1] AS doc_version FROM (SELECT page_id, regexp_extract(url, '^([^?#]*)', 1) || '/v' || (page_id % 3) || '/x' AS u FROM pages)")
def url_doc_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.concat(F.regexp_extract("url", "^([^?#]*)", 1), F.lit("/v"), (F.col("page_id") % 3).cast("string"), F.lit("/x"))
    return read(spark, sf_dir, "pages").select("page_id", U.doc_version(u).alias("doc_version"))


@query(f"SELECT page_id, {_PATH} AS path FROM pages UNION ALL SELECT page_id, '/w/' || page_id AS path FROM pages")
def effective_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages")
    wrapped = p.select("page_id", U.effective_path(F.concat(F.lit("https://example.com/s?returnurl=%2Fw%2F"), F.col("page_id").cast("string"))).alias("path"))
    return p.select("page_id", U.effective_path(F.col("url")).alias("path")).unionByName(wrapped)


@query(f"SELECT page_id, coalesce(nullif(trim(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1) || '-' || regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1)), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'default-collection') AS slug FROM pages")
def collection_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", U.collection_slug(F.col("url")).alias("slug"))


@query(r"SELECT doc_id, trim(regexp_replace(text, '[ \t\r\n]+', ' ', 'g')) AS text FROM documents")
def normalize_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", T.normalize_whitespace(F.col("text")).alias("text"))


@query("SELECT doc_id, greatest(1, length(text) // 4)::INT AS token_estimate FROM documents")
def token_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", T.estimate_tokens(F.col("text")).alias("token_estimate"))


@query("SELECT doc_id, sha256(text) AS content_hash FROM documents")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", T.content_hash(F.lit(""), F.col("text")).alias("content_hash"))


@query("SELECT page_id, sha256('docs::' || url) AS node_id, sha256(url || '::root') AS section_id, sha256(sha256(url || '::root') || '::0') AS chunk_id FROM pages")
def node_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = T.root_section_id(F.col("url"))
    return read(spark, sf_dir, "pages").select("page_id", T.node_id(F.lit("docs"), F.col("url")).alias("node_id"), root.alias("section_id"), T.chunk_id(root, F.lit(0)).alias("chunk_id"))


@query("SELECT item_id, coalesce(nullif(trim(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'section') AS slug FROM benchmark")
def slugify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "benchmark").select("item_id", T.slugify(F.col("text")).alias("slug"))


# --- pages

_COUNT = "len(regexp_extract_all(html, '{r}'))::INT"
_COUNTS = {"anchors": '<a href="', "paragraphs": "<p>", "headings": "<h[1-6]>", "list_items": "<li>"}
_HITS = "len(regexp_extract_all(left(regexp_replace(html, '<[^>]*>', ' ', 'g'), 12000), '(?i)\\b(?:collapse\\s+all|table\\s+of\\s+contents|toc|navigation|index|next|previous)\\b'))::INT"
_ANCHOR_CHARS = "coalesce(list_sum(list_transform(regexp_extract_all(html, '<a href=\"[^\"]*\">([^<]*)</a>', 1), lambda x: length(x))), 0)"


@query(f"SELECT page_id, {', '.join(_COUNT.format(r=r) + ' AS ' + n for n, r in _COUNTS.items())} FROM pages")
def html_feature_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spread(read(spark, sf_dir, "pages")).select("page_id", dom_counts("html").alias("d"))
    return p.select("page_id", *(F.col(f"d.{n}").alias(n) for n in _COUNTS))


@query(f"SELECT page_id, {_HITS} AS hits FROM pages")
def nav_term_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", term_hits(F.regexp_replace("html", "<[^>]*>", " ")).cast("int").alias("hits"))


_SCORE = f"""SELECT page_id, CASE WHEN density >= 0.6 THEN 0.5 WHEN density >= 0.4 THEN 0.3 ELSE 0 END + CASE WHEN p <= 2 THEN 0.2 WHEN p <= 5 THEN 0.1 ELSE 0 END + CASE WHEN h <= 1 THEN 0.1 ELSE 0 END
       + CASE WHEN hits > 0 THEN 0.3 ELSE 0 END + CASE WHEN li > greatest(5, 3 * p) THEN 0.15 ELSE 0 END AS score
  FROM (SELECT page_id, {_ANCHOR_CHARS}::DOUBLE / greatest(1, length(regexp_replace(html, '<[^>]*>', ' ', 'g'))) AS density, {_COUNT.format(r='<p>')} AS p, {_COUNT.format(r='<h[1-6]>')} AS h, {_COUNT.format(r='<li>')} AS li, {_HITS} AS hits FROM pages)"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores from what the page reader counts; the text is what is left without tags."""
    plain = F.regexp_replace("html", "<[^>]*>", " ")
    p = spread(read(spark, sf_dir, "pages")).select("page_id", "html", dom_counts("html").alias("d"))
    score = navigation_score(F.col("d.anchor_chars") / F.greatest(F.lit(1), F.length(plain)), F.col("d.paragraphs"), F.col("d.headings"), F.col("d.list_items"), term_hits(plain))
    return p.select("page_id", score.alias("score"))


@query(f"SELECT page_id, round(score::DOUBLE, 4) AS score, CASE WHEN score >= 0.55 THEN 'navigation' ELSE 'content' END AS doc_type FROM ({_SCORE})")
def nav_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("page_id", F.round("score", 4).alias("score"), doc_type(F.col("score")).alias("doc_type"))


@query(f"SELECT page_id FROM ({_SCORE}) WHERE score < 0.55")
def nav_filtered_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).filter(doc_type(F.col("score")) == "content").select("page_id")


@query()
def html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read(spark, sf_dir, "pages")).select("page_id", extract_page("html").alias("x")).select("page_id", "x.title", "x.text", "x.markdown")


@query()
def classified_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spread(read(spark, sf_dir, "pages")).select("page_id", "html", extract_page("html").alias("x")).select("page_id", "html", F.col("x.text").alias("text"))
    return classify(p).select("page_id", "doc_type", "quality_score", "navigation_score", "classification_signals.link_density", "classification_signals.paragraph_count")


def _toc(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spread(read(spark, sf_dir, "pages")).select("page_id", "url", F.explode(toc_entries(F.col("html"), F.col("url"), TOC_SELECTORS)).alias("e"))
    return p.select("page_id", F.col("url").alias("parent"), "e.*")


@query()
def toc_entries_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _toc(spark, sf_dir).select("page_id", "url", "text", "level", "ord")


@query(
    """SELECT page_id, href, (row_number() OVER (PARTITION BY page_id ORDER BY first_at) - 1)::INT AS ord FROM (
         SELECT page_id, href, min(k) AS first_at FROM (SELECT page_id, unnest(l) AS href, generate_subscripts(l, 1) AS k FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages)) GROUP BY page_id, href)"""
)
def toc_links_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every link of the page, by the reader of tables of contents; the addresses of these pages are absolute paths.
    entries = toc_entries(F.col("html"), F.lit("https://example.com/"), ("html",))
    p = spread(read(spark, sf_dir, "pages")).select("page_id", F.explode(entries).alias("e"))
    return p.select("page_id", F.col("e.ord").alias("ord"), F.regexp_replace("e.url", "^https://example.com(?=/)", "").alias("href"))


# --- sections and chunks


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read(spark, sf_dir, "documents")).select("doc_id", F.lit("docs").alias("collection"), F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("canonical_url"), F.col("text").alias("markdown_content"))


@query("""SELECT 'doc://' || doc_id AS canonical_url, sha256('doc://' || doc_id || '::root') AS section_id, 'Document' AS heading, length(trim(text, ' ' || chr(9) || chr(10) || chr(13)))::INT AS n FROM documents
          WHERE length(trim(text, ' ' || chr(9) || chr(10) || chr(13))) >= 80""")
def root_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sectionize(_docs(spark, sf_dir)).select("canonical_url", "section_id", "heading", F.length("text").alias("n"))


_HEADS = """lines AS (SELECT url, unnest(m) AS line, generate_subscripts(m, 1) AS ln FROM (
    SELECT 'doc://' || doc_id AS url, flatten(list_transform(range(1, len(l) + 1), lambda i: [repeat('#', (1 + (i - 1) % 3)::INT) || ' Part ' || (i - 1), l[i]])) AS m FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))),
  marked AS (SELECT *, regexp_matches(line, '^#{1,6}\\s+.*\\S') AS is_head FROM lines),
  numbered AS (SELECT *, sum(is_head::INT) OVER (PARTITION BY url ORDER BY ln) - 1 AS k FROM marked),
  bodies AS (SELECT url, k, length(trim(string_agg(line, chr(10) || chr(10) ORDER BY ln), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS n FROM numbered WHERE NOT is_head GROUP BY ALL),
  heads AS (SELECT url, k, length(regexp_extract(line, '^(#{1,6})', 1))::INT AS level, trim(regexp_extract(line, '^#{1,6}\\s+(.*)$', 1)) AS heading, coalesce(n, 0) >= 80 AS emitted FROM numbered LEFT JOIN bodies USING (url, k) WHERE is_head),
  named AS (SELECT *, sha256(url || '::' || coalesce(nullif(trim(regexp_replace(lower(heading), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'section') || '::' || k) AS id FROM heads),
  above AS (SELECT h.url, h.k, max(j.k) AS up FROM named h LEFT JOIN named j ON j.url = h.url AND j.k < h.k AND j.level < h.level GROUP BY ALL),
  climb AS (SELECT n.url, n.k, n.heading AS path, up, NULL::VARCHAR AS parent FROM named n JOIN above USING (url, k) WHERE emitted
            UNION ALL SELECT c.url, c.k, n.heading || ' > ' || c.path, a.up, coalesce(c.parent, CASE WHEN n.emitted THEN n.id END) FROM climb c JOIN named n ON n.url = c.url AND n.k = c.up JOIN above a ON a.url = c.url AND a.k = c.up)"""


@query(
    f"""WITH RECURSIVE {_HEADS} SELECT n.url AS canonical_url, n.id AS section_id, c.parent AS parent_section_id, n.level, n.k::INT AS order_in_page, c.path FROM climb c JOIN named n USING (url, k) WHERE c.up IS NULL"""
)
def sections_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with headings put at their lines: levels 1 to 3 in turn."""
    level = F.expr("transform(split(markdown_content, '\\n'), (x, i) -> concat(repeat('#', 1 + i % 3), ' Part ', i, '\\n\\n', x))")
    d = _docs(spark, sf_dir).withColumn("markdown_content", F.array_join(level, "\n\n"))
    return sectionize(d).select("canonical_url", "section_id", "parent_section_id", "level", "order_in_page", F.array_join("section_path", " > ").alias("path"))


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_sections(sectionize(_docs(spark, sf_dir)))


_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_PIECES = """SELECT url, i, p, g, sum(length(p) + length(g)) OVER (PARTITION BY url ORDER BY i) - length(p) - length(g) AS a
    FROM (SELECT url, unnest(string_split_regex(t, '{r}')) AS p, unnest(list_concat(regexp_extract_all(t, '{r}'), [''])) AS g, generate_subscripts(string_split_regex(t, '{r}'), 1) AS i FROM s)"""
#: Units with their bounds, and the walk over them, window by window.
_CHUNKS = f"""s AS (SELECT 'doc://' || doc_id AS url, trim(text, {_WS}) AS t FROM documents WHERE length(trim(text, {_WS})) >= 80),
  para AS ({_PIECES.format(r="[\\n]\\s*[\\n]+")}), sent AS ({_PIECES.format(r="[.!?]\\s+")}),
  both_ AS (SELECT url, 1 AS way, a + length(p) - length(ltrim(p, {_WS})) AS a, a + length(rtrim(p, {_WS})) AS b FROM para WHERE trim(p, {_WS}) <> ''
            UNION ALL SELECT url, 2, a, a + length(p) + least(length(g), 1) FROM sent WHERE p <> '' OR g <> '' UNION ALL SELECT url, 3, 0, length(t) FROM s),
  ways AS (SELECT url, way, list(a ORDER BY a) AS starts, list(b ORDER BY b) AS ends FROM both_ GROUP BY ALL),
  units AS (SELECT url, arg_min(starts, way) AS starts, arg_min(ends, way) AS ends FROM ways WHERE way = 3 OR len(starts) > 1 GROUP BY url),
  walk AS (
    SELECT url, 0 AS ord, 0::BIGINT AS a, (SELECT list_max(list_filter(u.ends, lambda x: x <= 1200))) AS e FROM units u
    UNION ALL
    SELECT url, ord + 1, nxt, (SELECT list_max(list_filter(ends, lambda x: x <= nxt + 1200))) FROM (
      SELECT url, ord, ends, coalesce(list_min(list_filter(starts, lambda x: x >= greatest(a + 1, stop - 150))), greatest(a + 1, stop - 150)) AS nxt
      FROM (SELECT w.url, w.ord, w.a, u.starts, u.ends, length(s.t) AS n, CASE WHEN w.e > w.a THEN w.e ELSE least(length(s.t), w.a + 1200) END AS stop FROM walk w JOIN units u USING (url) JOIN s USING (url)) WHERE stop < n) WHERE true),
  cuts AS (SELECT url, ord, a, CASE WHEN e > a THEN e ELSE least(length(t), a + 1200) END AS b, CASE WHEN e > a THEN 'semantic_boundary' ELSE 'char_window_fallback' END AS chunk_strategy, t FROM walk JOIN s USING (url)),
  made AS (SELECT *, t[a + 1:b] AS c FROM cuts WHERE trim(t[a + 1:b], {_WS}) <> ''),
  chunk AS (SELECT url AS canonical_url, sha256(sha256(url || '::root') || '::' || ord) AS chunk_id, ord::INT AS order_in_section, (a + length(c) - length(ltrim(c, {_WS})))::INT AS start_char,
            (a + length(rtrim(c, {_WS})))::INT AS end_char, chunk_strategy, greatest(1, length(trim(c, {_WS})) // 4)::INT AS token_estimate FROM made)"""


@query(f"WITH RECURSIVE {_CHUNKS} SELECT * FROM chunk")
def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunks(spark, sf_dir).select("canonical_url", "chunk_id", "order_in_section", "start_char", "end_char", "chunk_strategy", "token_estimate")


@query(f"WITH RECURSIVE {_CHUNKS} SELECT chunk_strategy, count(*) AS n, count(DISTINCT canonical_url) AS documents FROM chunk GROUP BY chunk_strategy")
def chunks_fallback_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunks(spark, sf_dir).groupBy("chunk_strategy").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("canonical_url").alias("documents"))


@query()
def corpus_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spread(read(spark, sf_dir, "pages")).select(F.lit("docs").alias("collection"), U.canonicalize_url("url").alias("canonical_url"), "url", "html", F.lit(200).alias("status"), F.lit(None).cast("string").alias("error"))
    made = build(p, p.select("url", "html", "status", "error"), Config(root_url="https://example.com/", embedding_dimension=64))
    return made.documents.groupBy("doc_type", "indexed_for_retrieval").agg(F.count(F.lit(1)).alias("documents")).join(made.chunks.groupBy("doc_type").agg(F.count(F.lit(1)).alias("chunks")), "doc_type", "left")


# --- coverage: all pages are the inventory; what became of each follows from its address

_ROOT = "(SELECT min(url) FROM pages)"
_INV = f"""inventory AS (SELECT url AS canonical_url, CASE WHEN url = {_ROOT} THEN 'seed' WHEN starts_with(url, 'https') THEN 'toc' ELSE 'sitemap' END AS source, (len(string_split(url, '/')) - 4)::INT AS depth, {_ROOT} AS parent FROM pages),
  crawled AS (SELECT CASE WHEN ends_with(url, '/') THEN url || 'moved' ELSE url END AS canonical_url, CASE WHEN contains(url, '?') THEN 'navigation' ELSE 'content' END AS doc_type, contains(url, '/en/') AS indexed FROM pages WHERE NOT contains(url, 'utm_') AND NOT contains(url, '#')),
  skipped AS (SELECT url AS canonical_url, CASE WHEN contains(url, '#') THEN 'duplicate' ELSE 'excluded_pattern' END AS reason, 'toc' AS source, 1 AS depth, {_ROOT} AS parent FROM pages WHERE contains(url, 'utm_') OR contains(url, '#') OR contains(url, 'blog.'))"""


def _crawl(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    p = read(spark, sf_dir, "pages").select("url")
    p = p.crossJoin(F.broadcast(p.agg(F.min("url").alias("parent_canonical_url")))).withColumn("discovered_from", F.lit(None).cast("string"))  # one row
    has = lambda x: F.contains(F.col("url"), F.lit(x))
    kind = F.when(F.col("url") == F.col("parent_canonical_url"), "seed").when(F.col("url").startswith("https"), "toc").otherwise("sitemap")
    inventory = p.select(F.col("url").alias("canonical_url"), kind.alias("source"), (F.size(F.split("url", "/")) - 4).alias("depth"), "parent_canonical_url", "discovered_from")
    moved = F.when(F.col("url").endswith("/"), F.concat("url", F.lit("moved"))).otherwise(F.col("url"))
    documents = p.filter(~has("utm_") & ~has("#")).select(moved.alias("canonical_url"), F.when(has("?"), "navigation").otherwise("content").alias("doc_type"), has("/en/").alias("indexed_for_retrieval"))
    skipped = p.filter(has("utm_") | has("#") | has("blog.")).select(F.col("url").alias("canonical_url"), F.when(has("#"), "duplicate").otherwise("excluded_pattern").alias("reason"), F.lit("toc").alias("source"), F.lit(1).alias("depth"), "parent_canonical_url", "discovered_from")
    return inventory, documents, skipped


@query(
    f"""WITH {_INV} SELECT (SELECT count(DISTINCT canonical_url) FROM inventory) AS expected_url_count, (SELECT count(DISTINCT canonical_url) FROM crawled) AS crawled_url_count,
        round((SELECT count(DISTINCT canonical_url) FROM inventory WHERE canonical_url IN (SELECT canonical_url FROM crawled))::DOUBLE / (SELECT count(DISTINCT canonical_url) FROM inventory), 6) AS coverage_ratio,
        (SELECT count(*) FROM inventory) AS discovered_url_count, (SELECT count(*) FROM crawled WHERE doc_type = 'content') AS content_url_count, (SELECT count(*) FROM crawled WHERE doc_type = 'content' AND indexed) AS indexed_content_url_count,
        (SELECT count(*) FROM crawled WHERE doc_type = 'navigation') AS navigation_url_count, (SELECT count(*) FROM skipped) AS skipped_url_count"""
)
def coverage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.coverage_counts(*_crawl(spark, sf_dir)).withColumn("coverage_ratio", F.round("coverage_ratio", 6))


@query(f"WITH {_INV} SELECT source, count(*) AS n FROM inventory GROUP BY source")
def source_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.distribution(_crawl(spark, sf_dir)[0], "source", "source")


@query(f"WITH {_INV} SELECT depth::VARCHAR AS depth, count(*) AS n FROM inventory GROUP BY ALL ORDER BY 1")
def depth_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.distribution(_crawl(spark, sf_dir)[0], "depth", "depth").orderBy("depth")


@query(f"WITH {_INV} SELECT reason, count(*) AS n FROM skipped GROUP BY reason")
def skipped_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.distribution(_crawl(spark, sf_dir)[2], "reason", "reason")


@query(f"WITH {_INV} SELECT DISTINCT canonical_url FROM inventory WHERE canonical_url NOT IN (SELECT canonical_url FROM crawled)")
def missing_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.missing_urls(*_crawl(spark, sf_dir)[:2])


@query(f"WITH {_INV} SELECT DISTINCT canonical_url FROM crawled WHERE canonical_url NOT IN (SELECT canonical_url FROM inventory)")
def orphan_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.orphan_urls(*_crawl(spark, sf_dir)[:2])


_LEVEL1 = "SELECT canonical_url FROM inventory WHERE source = 'toc' AND depth = 1 AND parent IN (SELECT canonical_url FROM inventory WHERE source = 'seed') UNION SELECT canonical_url FROM skipped WHERE parent IN (SELECT canonical_url FROM inventory WHERE source = 'seed')"


@query(f"WITH {_INV}, l AS ({_LEVEL1}) SELECT (SELECT count(*) FROM l) AS seed_toc_level1_total, (SELECT count(*) FROM l WHERE canonical_url IN (SELECT canonical_url FROM crawled)) AS seed_toc_level1_processed")
def level1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.level1_report(*_crawl(spark, sf_dir))[0]


@query(f"WITH {_INV} SELECT reason, count(*) AS n FROM skipped WHERE parent IN (SELECT canonical_url FROM inventory WHERE source = 'seed') AND canonical_url NOT IN (SELECT canonical_url FROM crawled) GROUP BY reason")
def level1_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.level1_report(*_crawl(spark, sf_dir))[1]


@query(f"WITH {_INV} SELECT canonical_url FROM inventory INTERSECT SELECT canonical_url FROM crawled UNION SELECT canonical_url FROM skipped")
def url_set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.processed_or_skipped(*_crawl(spark, sf_dir))


# --- discovery


def _frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the pages as one wave, in queue order; a page's own address is what its links are resolved from."""
    p = read(spark, sf_dir, "pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("ord", "href"))
    return p.select((F.col("page_id") * 1000000 + F.col("ord")).alias("pos"), F.concat(F.lit("https://example.com"), F.col("href")).alias("url"))


_WAVE = """wave AS (SELECT page_id * 1000000 + k - 1 AS pos, 'https://example.com' || href AS url FROM (SELECT page_id, unnest(l) AS href, generate_subscripts(l, 1) AS k FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages)))"""


@query(f"WITH {_WAVE} SELECT min(pos) AS pos, url FROM wave GROUP BY url")
def frontier_wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.first_places(_frontier(spark, sf_dir), "url")


@query(f"WITH {_WAVE} SELECT pos, url FROM (SELECT pos, url, row_number() OVER (PARTITION BY url ORDER BY pos) AS rn FROM wave) WHERE rn > 1")
def duplicate_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _frontier(spark, sf_dir).select("pos", "url", F.lit("toc").alias("source"), F.col("url").alias("canonical_url"))
    pages = w.select("url", F.lit("").alias("html")).distinct()
    found = discovery.judged(w, pages, None, Config(root_url="https://example.com/", allowed_domains=("example.com",), exclude_patterns=()))
    return found.filter("outcome = 'duplicate'").select("pos", "url")


@query(f"WITH {_WAVE} SELECT pos, url FROM (SELECT pos, url, coalesce(sum(length(url)) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM wave) WHERE before < 5000")
def guard_rail_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.running(_frontier(spark, sf_dir), {"before": F.length("url").cast("long")}, bits=26).filter("before < 5000").select("pos", "url")


@query(
    """WITH RECURSIVE reached AS (SELECT '0' AS id, 0 AS depth UNION ALL SELECT (r.id::BIGINT * 3 + k)::VARCHAR, r.depth + 1 FROM reached r, (VALUES (1), (2), (3)) AS x(k) WHERE r.depth < 3)
       SELECT 'https://example.com/n/' || id AS canonical_url, depth::INT AS depth FROM reached"""
)
def bfs_discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ternary tree of 40 pages; each page also links back to the root, which is a duplicate."""
    name = lambda c: F.concat(F.lit("https://example.com/n/"), c.cast("string"))
    nodes = spark.range(121)
    pages = nodes.select(name(F.col("id")).alias("url"), F.lit("<p>x</p>").alias("html"))
    down = nodes.select("id", F.explode(F.array(*(F.col("id") * 3 + k for k in (1, 2, 3)))).alias("c"), (F.col("c") - 3 * F.col("id") - 1).cast("int").alias("ord")).select(name(F.col("id")).alias("parent"), name(F.col("c")).alias("url"), "ord")
    back = nodes.select(name(F.col("id")).alias("parent"), name(F.lit(0)).alias("url"), F.lit(3).alias("ord"))
    toc = down.unionByName(back).withColumns({"text": F.lit("x"), "level": F.lit(1)})
    start = pages.filter("url = 'https://example.com/n/0'").select("url", F.lit("seed").alias("source"), F.lit(0).alias("ord"))
    found = discovery.discover(start, pages, toc, Config(root_url="https://example.com/", collection="tree", allowed_domains=("example.com",), max_depth=3))
    return found.inventory.select("canonical_url", "depth")


# --- the tree: region, nation, customer

_TREE = """tree AS (SELECT 'r' || r_regionkey AS id, NULL::VARCHAR AS parent, r_name AS title, r_regionkey::INT AS toc_order FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name, NULL FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_name, (c_custkey % 100)::INT FROM customer)"""


def _tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    r = read(spark, sf_dir, "region").select(key("r", "r_regionkey").alias("node_id"), F.lit(None).cast("string").alias("parent_node_id"), F.col("r_name").alias("title"), F.col("r_regionkey").cast("int").alias("toc_order"))
    n = read(spark, sf_dir, "nation").select(key("n", "n_nationkey"), key("r", "n_regionkey"), "n_name", F.lit(None).cast("int"))
    c = read(spark, sf_dir, "customer").select(key("c", "c_custkey"), key("n", "c_nationkey"), "c_name", (F.col("c_custkey") % 100).cast("int"))
    return r.union(n).union(c)


@query(f"WITH {_TREE} SELECT parent AS parent_node_id, row_number() OVER (PARTITION BY parent ORDER BY toc_order NULLS LAST, CASE WHEN toc_order IS NULL THEN title END, id)::INT AS position, id AS node_id, title FROM tree")
def link_tree_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.ordered_children(_tree(spark, sf_dir))


@query(
    f"""WITH RECURSIVE {_TREE}, up AS (SELECT id, parent, title AS path, title AS root_title, 1 AS hops FROM tree UNION ALL SELECT u.id, t.parent, t.title || ' > ' || u.path, t.title, u.hops + 1 FROM up u JOIN tree t ON t.id = u.parent)
       SELECT id AS node_id, path, root_title, hops::INT AS hops FROM up WHERE parent IS NULL"""
)
def ancestor_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.ancestor_paths(_tree(spark, sf_dir)).withColumn("path", F.array_join("path", " > "))


@query(
    f"""SELECT sha256('docs::' || url) AS node_id, url AS canonical_url, CASE WHEN contains(url, '?') THEN url ELSE 'page ' || page_id END AS title,
         CASE WHEN NOT contains(url, '#') THEN sha256('docs::' || {_ROOT}) END AS parent_node_id FROM pages"""
)
def discovered_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages").select("page_id", "url")
    parent = F.when(F.contains("url", F.lit("#")), F.lit("https://elsewhere.example/")).otherwise(F.col("root"))
    inv = p.crossJoin(F.broadcast(p.agg(F.min("url").alias("root")))).select(  # one row
        F.lit("docs").alias("collection"), "url", F.col("url").alias("canonical_url"), F.lit("toc").alias("source"), F.lit(1).alias("depth"), F.lit(None).cast("string").alias("discovered_from"), parent.alias("parent_canonical_url"),
        F.when(F.contains("url", F.lit("?")), "").otherwise(F.concat(F.lit("page "), F.col("page_id").cast("string"))).alias("link_text"), F.lit(1).alias("toc_level"), F.col("page_id").cast("int").alias("toc_order"), F.lit(None).cast("string").alias("doc_version"))
    return graph.build_nodes(inv).select("node_id", "canonical_url", "title", "parent_node_id")


# --- tables


def _batch(spark: SparkSession, sf_dir: str, name: str, without: str) -> DataFrame:
    return read(spark, sf_dir, "documents").filter(F.col("lang") != without).select("doc_id", F.concat(F.lit(f"{name}-"), F.col("source")).alias("source"))


@query(
    """WITH old AS (SELECT doc_id, 'old-' || source AS source FROM documents WHERE lang <> 'fr'), new AS (SELECT doc_id, 'new-' || source AS source FROM documents WHERE lang <> 'en')
       SELECT * FROM new UNION ALL SELECT * FROM old WHERE doc_id NOT IN (SELECT doc_id FROM new)"""
)
def upsert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything but French is stored; everything but English comes, each row twice, of which the last counts."""
    new = _batch(spark, sf_dir, "new", "en")
    twice = new.withColumn("n", F.lit(2)).unionByName(new.select("doc_id", F.lit("first").alias("source"), F.lit(1).alias("n")))
    return store.upserted(_batch(spark, sf_dir, "old", "fr"), twice, ["doc_id"], "n")


@query(
    """SELECT doc_id, k::INT AS k, 'new' AS v FROM documents, (VALUES (0), (1)) AS x(k) WHERE lang = 'en' UNION ALL SELECT doc_id, k::INT, 'old' FROM documents, (VALUES (0), (1), (2)) AS x(k) WHERE lang <> 'en'"""
)
def replace_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", "lang")
    old = d.select("doc_id", F.explode(F.array(*map(F.lit, (0, 1, 2)))).alias("k"), F.lit("old").alias("v"))
    new = d.filter("lang = 'en'").select("doc_id", F.explode(F.array(*map(F.lit, (0, 1)))).alias("k"), F.lit("new").alias("v"))
    return store.replaced(old, new, ["doc_id"])


@query("SELECT doc_id, lang FROM documents WHERE lang <> 'en'")
def clear_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.without(read(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "en")


@query("SELECT doc_id, quality FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.orphans(read(spark, sf_dir, "labels").select("doc_id", "quality"), read(spark, sf_dir, "documents").filter("lang = 'en'"), ["doc_id"])


@query("SELECT d.doc_id, d.lang, l.quality FROM documents d JOIN labels l USING (doc_id)")
def docs_with_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.with_children(read(spark, sf_dir, "documents").select("doc_id", "lang"), read(spark, sf_dir, "labels").select("doc_id", "quality"), ["doc_id"])


@query("SELECT event_id, user_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 20")
def recent_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.newest(read(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "ts", "event_id", 20)


@query("SELECT source, lang, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY source, lang")
def grouped_by_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.grouped(read(spark, sf_dir, "documents"), ["source", "lang"], "doc_id")


# --- evaluation

_SHINGLES = "SELECT DISTINCT {i} AS i, array_to_string(w[k:k + 7], ' ') AS s FROM (SELECT {i}, w, unnest(range(1, len(w) - 6)) AS k FROM (SELECT {i}, string_split(text, ' ') AS w FROM {t}))"
_EVAL = f"""hits AS (SELECT item_id, item_id IN (SELECT b.i FROM ({_SHINGLES.format(i='item_id', t='benchmark')}) b JOIN ({_SHINGLES.format(i='doc_id', t='documents')}) d USING (s)) AS hit FROM benchmark)"""


@query(f"WITH {_EVAL} SELECT count(*) AS queries, round(coalesce(avg(hit::INT::DOUBLE), 0), 6) AS hit_rate, round(coalesce(avg(hit::INT::DOUBLE), 0), 6) AS recall_at_k FROM hits")
def eval_hit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as queries; documents that share eight consecutive words with an item are expected, and those
    found by the words' hashes are retrieved."""
    window = "transform(sequence(1, greatest(size(w) - 7, 0)), k -> concat_ws(' ', slice(w, k, 8)))"

    def shingles(table: str, ident: str) -> DataFrame:
        d = spread(read(spark, sf_dir, table)).select(F.col(ident).cast("string").alias(ident), F.split("text", " ").alias("w")).filter("size(w) >= 8")
        return d.select(ident, F.explode(F.array_distinct(F.expr(window))).alias("s"))

    items = shingles("benchmark", "item_id")
    found = shingles("documents", "doc_id").join(items, "s").select(F.col("item_id").alias("query"), F.col("doc_id").alias("canonical_url")).distinct()
    expected = read(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("query")).join(found.groupBy("query").agg(F.collect_set("canonical_url").alias("expected_urls")), "query", "left")
    out = evaluate.hit_rate(evaluate.query_hits(found, expected))
    return out.select("queries", F.round("hit_rate", 6).alias("hit_rate"), F.round("recall_at_k", 6).alias("recall_at_k"))


# --- crawls that go on

_VERSIONS = """old AS (SELECT doc_id, sha256(text) AS h FROM documents WHERE lang <> 'es'), new AS (SELECT doc_id, CASE WHEN source = 'src1' THEN sha256(text || '!') ELSE sha256(text) END AS h FROM documents WHERE lang <> 'de'),
  kinds AS (SELECT coalesce(n.doc_id, o.doc_id) AS doc_id, CASE WHEN o.doc_id IS NULL THEN 'new' WHEN n.doc_id IS NULL THEN 'gone' WHEN o.h = n.h THEN 'unchanged' ELSE 'changed' END AS change_kind FROM old o FULL JOIN new n ON o.doc_id = n.doc_id)"""


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = read(spark, sf_dir, "documents")
    changed = F.when(F.col("source") == "src1", F.sha2(F.concat("text", F.lit("!")), 256)).otherwise(F.sha2("text", 256))
    return d.filter("lang <> 'es'").select("doc_id", F.sha2("text", 256).alias("h")), d.filter("lang <> 'de'").select("doc_id", changed.alias("h"))


@query(f"WITH {_VERSIONS} SELECT * FROM kinds")
def incremental_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.changes(*_versions(spark, sf_dir), "doc_id", "h")


@query(f"WITH {_VERSIONS} SELECT {', '.join(f'''count(*) FILTER (change_kind = '{k}') AS {k}_urls''' for k in ('new', 'gone', 'changed', 'unchanged'))}, count(*) AS all_urls FROM kinds")
def incremental_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.change_report(incremental_changes(spark, sf_dir))


@query("SELECT event_id, coalesce(CASE WHEN event_id % 2 = 0 THEN 'kept' END, json_extract_string(props, '$.k')) AS k FROM events")
def metadata_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, "kept").alias("k"), "props")
    return incremental.backfilled(e, {"k": "string"}, "props").drop("props")


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = event_counts(read(spark, sf_dir, "events"))
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))
