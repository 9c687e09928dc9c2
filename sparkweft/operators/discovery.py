"""Discovery of a site, wave by wave: a wave is all URLs found by the pages of the one before.

Within a wave URLs have the order in which a queue would give them (parent's place, then place in its table of
contents), and rules that depend on that order are windows over it: of a canonical URL the first fetchable row is the
record, earlier ones are fetch errors, later ones duplicates; guard rails cut where running sums reach a limit (sums
within blocks of the order, plus the blocks' offsets). Every wave is checkpointed.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkweft.config import Config
from sparkweft.functions.url import canonicalize_url, doc_version, percent_decode, scope_reason
from sparkweft.operators.html import toc_entries
from sparkweft.session import cut_lineage
from sparkweft.sources.web import allowed_by_robots, parse_robots, sitemap_urls

QUEUE = "pos long, url string, canonical_url string, source string, depth int, discovered_from string, parent_canonical_url string, link_text string, toc_level int, toc_order int"
_CARRIED = ["url", "canonical_url", "source", "depth", "discovered_from", "parent_canonical_url", "link_text", "toc_level", "toc_order"]


class Discovery(NamedTuple):
    inventory: DataFrame
    skipped: DataFrame
    stopped_reason: str
    total_bytes: int
    failures: int


def starting(config: Config, spark: SparkSession, robots: str | None = None, robots_ok: bool = True, sitemaps: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(url, source, ord of the root and of the pages its sitemaps name, in order; those that robots rules block, as skips).

    robots: the text of robots.txt, None if it could not be had. sitemaps: url, html of sitemaps that can be fetched.
    """
    root = spark.createDataFrame([(config.root_url, "seed", -1)], "url string, source string, ord long")
    none = spark.createDataFrame([], QUEUE.partition(", ")[2] + ", reason string")
    if sitemaps is None:
        return root, none
    named = list(dict.fromkeys([*config.sitemap_urls, *parse_robots(robots, config.root_url, robots_ok)[1]]))
    found = sitemap_urls(spark.createDataFrame([(u,) for u in named], "url string"), sitemaps)
    judged_ = cut_lineage(placed(allowed_by_robots(found, robots, config.root_url, config.user_agent, robots_ok), "url").withColumnRenamed("pos", "ord"))
    start = root.unionByName(judged_.filter("allowed").select("url", F.lit("sitemap").alias("source"), "ord"))
    blocked = judged_.filter("not allowed").select("url", canonicalize_url("url").alias("canonical_url"), F.lit("sitemap").alias("source"), F.lit(0).alias("depth"), F.lit("blocked_by_robots").alias("reason"))
    return start, none.unionByName(blocked, allowMissingColumns=True)


def placed(rows: DataFrame, *order) -> DataFrame:
    """rows with pos, a number that rises with the order (not gapless); block: its upper bits."""
    return rows.orderBy(*order).withColumn("pos", F.monotonically_increasing_id())


def running(rows: DataFrame, sums: dict[str, Column], bits: int = 33) -> DataFrame:
    """rows with the sums over all rows before each (by pos). Blocks' totals (one row a sorted partition) meet on the driver."""
    d = rows.withColumn("_block", F.shiftright("pos", bits))
    totals = d.groupBy("_block").agg(*(F.sum(c).alias(n) for n, c in sums.items())).orderBy("_block").collect()
    before, offsets = dict.fromkeys(sums, 0), []
    for r in totals:
        offsets.append((r["_block"], *(before[n] for n in sums)))
        before = {n: before[n] + (r[n] or 0) for n in sums}
    table = rows.sparkSession.createDataFrame(offsets or [(0, *(0 for _ in sums))], "_block long, " + ", ".join(f"_o{n} long" for n in sums))
    w = Window.partitionBy("_block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    d = d.join(F.broadcast(table), "_block")
    return d.withColumns({n: F.coalesce(F.sum(c).over(w), F.lit(0)) + F.col(f"_o{n}") for n, c in sums.items()}).drop("_block", *(f"_o{n}" for n in sums))


def _reason(config: Config) -> Column:
    return scope_reason(percent_decode("canonical_url"), list(config.allowed_domains), list(config.allowed_path_prefixes), list(config.include_patterns), list(config.exclude_patterns))


def links_of(fetched: DataFrame, config: Config) -> DataFrame:
    """parent, url, text, level, ord of the tables of contents of fetched pages (url, final_url, html)."""
    entries = toc_entries(F.col("html"), F.coalesce("final_url", "url"), config.toc_selectors, config.toc_fallback_below)
    return fetched.filter("html is not null").select(F.col("url").alias("parent"), F.explode(entries).alias("e")).select("parent", "e.*")


def first_places(wave: DataFrame, key: str = "canonical_url", good: Column | None = None) -> DataFrame:
    """key, pos: the first place in the wave of each key (among good rows). Tasks combine first, so a link of all pages is no hot key."""
    return wave.groupBy(key).agg(F.min("pos" if good is None else F.when(good, F.col("pos"))).alias("pos"))


def judged(wave: DataFrame, pages: DataFrame, seen: DataFrame | None, config: Config, robots: str | None = None) -> DataFrame:
    """wave with fetched (its bytes, null if it cannot be) and outcome: record, duplicate, fetch_error or a scope rule."""
    reason = _reason(config)
    sizes = pages.filter("html is not null").select(F.col("url").alias("_url"), F.octet_length(F.coalesce("html", F.lit(""))).cast("long").alias("_bytes")).dropDuplicates(["_url"])
    if config.respect_robots_for_toc and robots is not None:
        wave = allowed_by_robots(wave, robots, config.root_url, config.user_agent)
        reason = F.when((reason == "allowed") & ~F.col("allowed"), "blocked_by_robots").otherwise(reason)
    d = wave.withColumn("_reason", F.when(F.col("source") == "seed", "allowed").otherwise(reason)).drop("allowed").join(sizes, F.col("url") == F.col("_url"), "left").drop("_url")
    if seen is None:
        d = d.withColumn("_seen", F.lit(False))
    else:
        known = seen.select(F.col("canonical_url").alias("_k")).distinct()
        d = d.join(known, F.col("canonical_url") == F.col("_k"), "left").withColumn("_seen", F.col("_k").isNotNull()).drop("_k")
    good = (F.col("_reason") == "allowed") & F.col("_bytes").isNotNull()
    first = first_places(d, good=good).select(F.col("canonical_url").alias("_k"), F.col("pos").alias("_first"))
    d = d.join(first, F.col("canonical_url").eqNullSafe(F.col("_k")), "left").drop("_k")
    outcome = F.when(F.col("_seen") | (F.col("pos") > F.col("_first")), "duplicate").when(F.col("_reason") != "allowed", F.col("_reason")).when(F.col("_bytes").isNull(), "fetch_error").otherwise("record")
    return d.withColumn("outcome", outcome).drop("_reason", "_seen", "_first").withColumnRenamed("_bytes", "fetched")


def discover(start: DataFrame, pages: DataFrame | Callable[[DataFrame], DataFrame], toc: DataFrame | None, config: Config, robots: str | None = None) -> Discovery:
    """start: url, source (seed or sitemap, in order by `ord`). pages: url, html of what can be fetched, or a function that
    fetches a frame of urls (see sources.web.fetch_table), once a wave, what is new and in scope. toc: parent (url),
    url, text, level, ord of the entries of pages (None: read from the pages). robots: rules for all links if the settings want them there."""
    began = time.monotonic()
    wave = placed(start.select(F.col("url"), canonicalize_url("url").alias("canonical_url"), "source", F.lit(0).alias("depth"), *(F.lit(None).cast(t).alias(n) for n, t in (("discovered_from", "string"), ("parent_canonical_url", "string"), ("link_text", "string"), ("toc_level", "int"), ("toc_order", "int"))), "ord"), "ord").drop("ord")
    records, skips, seen, reason = [], [], None, "completed"
    n_records = n_failures = n_bytes = depth = 0
    while True:
        wave = cut_lineage(wave)
        if not wave.limit(1).count():
            break
        if callable(pages):
            new = wave if seen is None else wave.join(seen, "canonical_url", "left_anti")
            here = cut_lineage(pages(new.withColumn("_reason", _reason(config)).filter("source = 'seed' or _reason = 'allowed'").select("url").distinct()))
        else:
            here = pages if "final_url" in pages.columns else pages.withColumn("final_url", F.col("url"))
        links = links_of(here, config) if toc is None or callable(pages) else toc
        entries = links.select(F.col("parent").alias("_parent"), F.col("url").alias("_child"), F.col("text").alias("_text"), F.col("level").alias("_level"), F.col("ord").alias("_ord"))
        d = judged(wave, here, seen, config, robots)
        stop = None
        if config.max_runtime_minutes > 0 and time.monotonic() - began >= 60 * config.max_runtime_minutes:
            stop, cut = "guard_rail_runtime", -1
        elif config.max_pages > 0 or config.max_failures > 0 or config.max_total_bytes > 0:
            is_record = F.col("outcome") == "record"
            sums = running(d, {"_r": is_record.cast("long"), "_f": (F.col("outcome") == "fetch_error").cast("long"), "_b": F.when(is_record, F.col("fetched")).otherwise(F.lit(0))})
            hit = F.lit(None).cast("string")
            for limit, name, total, so_far in ((config.max_failures, "guard_rail_failures", "_f", n_failures), (config.max_total_bytes, "guard_rail_total_bytes", "_b", n_bytes), (config.max_pages, "guard_rail_max_pages", "_r", n_records)):
                if limit > 0:
                    hit = F.coalesce(hit, F.when(F.col(total) + so_far >= limit, name))
            found = sums.select("pos", hit.alias("hit")).filter("hit is not null").orderBy("pos").limit(1).collect()
            if found:
                stop, cut = found[0]["hit"], found[0]["pos"]
        d = cut_lineage(d if stop is None else d.withColumn("outcome", F.when(F.col("pos") >= cut, "_left").otherwise(F.col("outcome"))))
        new = d.filter("outcome = 'record'")
        counted = d.agg(F.count_if(F.col("outcome") == "record"), F.sum(F.when(F.col("outcome") == "record", F.col("fetched"))), F.count_if(F.col("outcome") == "fetch_error")).first()
        n_records, n_bytes, n_failures = n_records + counted[0], n_bytes + (counted[1] or 0), n_failures + counted[2]
        records.append(new)
        skips.append(d.filter("outcome not in ('record', '_left')").select(*_CARRIED, F.col("outcome").alias("reason")))
        seen = new.select("canonical_url") if seen is None else cut_lineage(seen.unionByName(new.select("canonical_url")))
        below = new if config.max_depth < 0 else new.filter(F.col("depth") < config.max_depth)
        grown = below.select(F.col("pos").alias("_pos"), F.col("url").alias("_at"), F.col("canonical_url").alias("_from"), F.col("depth").alias("_depth")).join(entries, F.col("_at") == F.col("_parent"))
        following = placed(grown, "_pos", "_ord").select(
            "pos", F.col("_child").alias("url"), canonicalize_url("_child").alias("canonical_url"), F.lit("toc").alias("source"), (F.col("_depth") + 1).alias("depth"), F.col("_from").alias("discovered_from"),
            F.col("_from").alias("parent_canonical_url"), F.col("_text").alias("link_text"), F.col("_level").alias("toc_level"), F.col("_ord").alias("toc_order"))
        if stop is not None:
            # What is left in the queue: the rest of this wave, then what its pages had already added; each canonical URL once.
            rest = d.filter("outcome = '_left'").select("pos", *_CARRIED).withColumn("_wave", F.lit(0)).unionByName(following.withColumn("_wave", F.lit(1)))
            w = Window.partitionBy("canonical_url").orderBy("_wave", "pos")
            skips.append(rest.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select(*_CARRIED, F.lit(stop).alias("reason")))
            reason = stop
            break
        wave, depth = following, depth + 1
    together = lambda parts, schema: _union(parts, start.sparkSession, schema)
    inventory = together(records, QUEUE).select(F.lit(config.collection).alias("collection"), *_CARRIED, doc_version(F.col("canonical_url")).alias("doc_version"), "pos")
    return Discovery(inventory, together(skips, QUEUE.partition(", ")[2] + ", reason string"), reason, n_bytes, n_failures)


def _union(parts: list[DataFrame], spark, schema: str) -> DataFrame:
    out = spark.createDataFrame([], schema)
    for p in parts:
        out = out.unionByName(p.select(*out.columns))
    return out


def discovery_metrics(inventory: DataFrame, config: Config) -> DataFrame:
    """max_depth_discovered, frontier_exhausted (nothing lies at the depth limit), pages."""
    deepest = F.coalesce(F.max("depth"), F.lit(0))
    return inventory.agg(deepest.alias("max_depth_discovered"), (F.lit(config.max_depth < 0) | (deepest < config.max_depth)).alias("frontier_exhausted"), F.count(F.lit(1)).alias("pages"))
