"""Crawls that go on from an earlier one: what changed, the state kept for each URL, and what its counters are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def changes(old: DataFrame, new: DataFrame, key: str = "canonical_url", value: str = "content_hash") -> DataFrame:
    """key, change_kind: new, gone, changed or unchanged."""
    o, n = old.select(F.col(key).alias("_o"), F.col(value).alias("_ov")), new.select(F.col(key).alias("_n"), F.col(value).alias("_nv"))
    kind = F.when(F.col("_o").isNull(), "new").when(F.col("_n").isNull(), "gone").when(F.col("_ov").eqNullSafe(F.col("_nv")), "unchanged").otherwise("changed")
    return o.join(n, F.col("_o") == F.col("_n"), "full_outer").select(F.coalesce("_n", "_o").alias(key), kind.alias("change_kind"))


def change_report(kinds: DataFrame) -> DataFrame:
    return kinds.agg(*(F.count_if(F.col("change_kind") == k).alias(f"{k}_urls") for k in ("new", "gone", "changed", "unchanged")), F.count(F.lit(1)).alias("all_urls"))


def next_state(state: DataFrame, run: DataFrame) -> DataFrame:
    """State by URL after a run. state: canonical_url, content_hash, first_seen, last_seen, last_changed, min_depth;
    run: canonical_url, content_hash, seen_at, depth."""
    s, r = state.alias("s"), run.alias("r")
    changed = F.col("r.canonical_url").isNotNull() & ~F.col("r.content_hash").eqNullSafe(F.col("s.content_hash"))
    return s.join(r, F.col("s.canonical_url") == F.col("r.canonical_url"), "full_outer").select(
        F.coalesce("r.canonical_url", "s.canonical_url").alias("canonical_url"), F.coalesce("r.content_hash", "s.content_hash").alias("content_hash"), F.coalesce("s.first_seen", "r.seen_at").alias("first_seen"),
        F.coalesce("r.seen_at", "s.last_seen").alias("last_seen"), F.when(changed, F.col("r.seen_at")).otherwise(F.col("s.last_changed")).alias("last_changed"), F.least("s.min_depth", "r.depth").alias("min_depth"),
    )


def to_crawl(state: DataFrame, max_depth: int, target_depth: int, recrawl_all: bool = False, recrawl_pattern: str | None = None) -> DataFrame:
    """URLs to fetch in the next run with why: everything, those of a pattern, or the rim that a deeper target opens."""
    why = F.when(F.lit(recrawl_all), "recrawl_all")
    if recrawl_pattern:
        why = why.when(F.contains(F.col("canonical_url"), F.lit(recrawl_pattern)), "recrawl_pattern")
    why = why.when((F.col("min_depth") >= max_depth) & (F.col("min_depth") < target_depth), "expand")
    return state.withColumn("why", why).filter("why is not null").select("canonical_url", "why")


def requeued(urls: DataFrame, now: Column, lease_seconds: int, most_attempts: int) -> DataFrame:
    """urls (canonical_url, status, attempts, leased_at) with leases that ran out put back to pending, or to failed after the last attempt."""
    out = (F.col("status") == "processing") & (F.col("leased_at") + F.make_dt_interval(secs=F.lit(float(lease_seconds))) < now)
    return urls.withColumn("status", F.when(out & (F.col("attempts") >= most_attempts), "failed").when(out, "pending").otherwise(F.col("status")))


def recovery_report(urls: DataFrame) -> DataFrame:
    return urls.agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("pending", "processing", "done", "failed", "skipped")))


def backfilled(rows: DataFrame, columns: dict[str, str], json_col: str) -> DataFrame:
    """rows with each column (name: type) filled from the JSON text's field of that name where it is null."""
    have = rows.columns
    return rows.withColumns({n: F.coalesce(*([F.col(n)] if n in have else []), F.get_json_object(json_col, f"$.{n}").cast(t)) for n, t in columns.items()})


def edge_kind(link_text: Column) -> Column:
    """topic, navigation_aux or noise, by a link's text."""
    t = F.lower(F.trim(F.coalesce(link_text, F.lit(""))))
    return F.when(t.rlike(r"^[\W_]*$"), "noise").when(t.rlike(r"^(next|previous|prev|up|home|index|top|back|contents|search)\b"), "navigation_aux").otherwise("topic")


def toc_fingerprint(links: Column) -> Column:
    """Equal tables of contents have equal fingerprints."""
    return F.sha2(F.array_join(links, "\n"), 256)
