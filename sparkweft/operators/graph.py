"""The tree of discovered pages: nodes, ordered children, paths to the root."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkweft.functions.text import first_filled, node_id
from sparkweft.session import cut_lineage


def build_nodes(inventory: DataFrame) -> DataFrame:
    """Nodes from inventory rows; a parent outside the inventory leaves parent_node_id null (the node is a root)."""
    parent = first_filled(F.col("parent_canonical_url"), F.col("discovered_from"))
    rows = inventory.withColumns({"node_id": node_id(F.col("collection"), F.col("canonical_url")), "parent_canonical_url": parent, "title": first_filled(F.col("link_text"), F.col("canonical_url"))})
    known = inventory.select(F.col("collection").alias("_c"), F.col("canonical_url").alias("_u")).distinct()
    joined = rows.join(known, (F.col("collection") == F.col("_c")) & (F.col("parent_canonical_url") == F.col("_u")), "left")
    return joined.select("collection", "node_id", "canonical_url", "url", "title", "source", "depth", F.when(F.col("_u").isNotNull(), node_id(F.col("collection"), F.col("parent_canonical_url"))).alias("parent_node_id"), "parent_canonical_url", "toc_level", "toc_order", "doc_version")


def ordered_children(nodes: DataFrame, parent: str = "parent_node_id", ident: str = "node_id", order: str = "toc_order", title: str = "title") -> DataFrame:
    """parent, position (from 1), id: children by order (nulls last), then title, then id. Roots have a null parent.

    The window partitions by parent, so a page with very many children is one task's sort on disk, never a list in memory.
    """
    w = Window.partitionBy(parent).orderBy(F.col(order).asc_nulls_last(), F.when(F.col(order).isNull(), F.col(title)), ident)
    return nodes.select(parent, F.row_number().over(w).alias("position"), ident, title)


def link_tree(nodes: DataFrame) -> dict:
    """The nested tree for a report on the driver; its size is that of the crawl's inventory."""
    rows = {r["node_id"]: {**r.asDict(), "children": []} for r in nodes.dropDuplicates(["node_id"]).toLocalIterator()}
    roots = []
    key = lambda n: (n["toc_order"] is None, n["toc_order"] or 0, n["title"] if n["toc_order"] is None else "", n["node_id"])
    for n in sorted(rows.values(), key=key):
        (rows[n["parent_node_id"]]["children"] if n["parent_node_id"] in rows else roots).append(n)
    return {"node_count": len(rows), "roots": roots}


def ancestor_paths(nodes: DataFrame, ident: str = "node_id", parent: str = "parent_node_id", title: str = "title") -> DataFrame:
    """id, path (titles from the root down, empty ones left out), root_title, hops.

    Each round doubles the distance that is known (pointer jumping), so a chain of n hops takes log n joins. A cycle
    ends where it would meet a node again; nothing else bounds the length of a path.
    """
    step = nodes.select(F.col(ident).alias("id"), F.col(parent).alias("up"), F.array(F.col(title)).alias("titles"), F.array(F.col(ident)).alias("seen"))
    known = step.select(F.col("id").alias("_id"))
    state = step.join(known, F.col("up") == F.col("_id"), "left").withColumn("up", F.when(F.col("_id").isNotNull(), F.col("up"))).drop("_id")
    while True:
        state = cut_lineage(state)
        if not state.filter("up is not null").limit(1).count():
            break
        other = state.select(F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("titles").alias("_titles"), F.col("seen").alias("_seen"))
        joined = state.join(other, F.col("up") == F.col("_id"), "left")
        met = F.filter(F.sequence(F.lit(1), F.greatest(F.size("_seen"), F.lit(1))), lambda k: F.array_contains("seen", F.get(F.col("_seen"), k - 1)))
        # The places are looked for only where the parts meet: pairwise, that costs the square of a long path.
        fresh = F.coalesce(F.when(F.arrays_overlap("seen", "_seen"), F.array_min(met) - 1), F.size("_seen"))  # nodes of the other part before the first known one
        closed = F.col("_id").isNotNull() & (fresh < F.size("_seen"))
        state = joined.select(
            "id",
            F.when(~closed, F.col("_up")).alias("up"),
            F.when(F.col("_id").isNull(), F.col("titles")).otherwise(F.concat("titles", F.slice("_titles", F.lit(1), fresh))).alias("titles"),
            F.when(F.col("_id").isNull(), F.col("seen")).otherwise(F.concat("seen", F.slice("_seen", F.lit(1), fresh))).alias("seen"),
        )
    path = F.filter(F.reverse("titles"), lambda t: t.isNotNull() & (t != ""))
    return state.select(F.col("id").alias(ident), path.alias("path"), F.element_at("titles", -1).alias("root_title"), F.size("titles").alias("hops"))


def hierarchy_of(hits: DataFrame, nodes: DataFrame) -> DataFrame:
    """hits with node_id, parent_node_id, toc_level, toc_order, root_title and path; an unknown URL has an empty path."""
    info = nodes.join(ancestor_paths(nodes), "node_id").select("canonical_url", "node_id", "parent_node_id", "toc_level", "toc_order", "root_title", "path")
    return hits.join(info, "canonical_url", "left").withColumn("path", F.coalesce("path", F.array().cast("array<string>")))
