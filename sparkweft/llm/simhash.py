"""SimHash near-duplicates: pivot distance tables find the candidates, components join the links.

Fingerprints (mapInArrow, one text at a time): bit b is 1 if set in over half of the 64-bit XXH64
values (seed 42) of the text's 3-word shingles.

Links join fingerprints that differ in at most `reach` bits. Equal fingerprints are one node from the
start, so copies add nothing. For the others, distances to reference fingerprints (pivots) are laid down in tables:

1. Tables to meet in. Pivots are zero and one for each pair of neighbouring bits; the distance to zero and
   to a pair's pivot give the number of ones in the pair. Two fingerprints within `reach` bits differ in at most
   `reach` of these 32 coordinates. The coordinates are dealt into `groups`; a pair within reach agrees wholly on
   at least groups - reach of them, so each choice of that many is a key, and a pair in reach shares one. There are
   as many groups as it takes for keys to outnumber the fingerprints (`groups_for`), so cells stay small.
2. A table to discard by. Members of shared cells are stored with their distances to 16 further pivots, computed
   once. Of a cell's pairs, those with a coordinate that differs by more than `reach` are discarded (the triangle
   inequality: the largest difference bounds the distance from below); survivors are verified by their bits.

A key shared by over `most` fingerprints is not paired, since pairs grow with the square. Its
members go another exact way: each is sent to all fingerprints within reach / 2 of it (itself and its
64 neighbours at reach 2); two fingerprints within reach meet at one between them, all that meet there
are within reach of each other, and so a link to the smallest of them keeps every connection. Its rows are
65 times the members, linear whatever the shape of the group.

Components: links are rewired to smaller nodes in rounds (each node's larger neighbours, then its
smaller ones, are tied to its smallest neighbour) until nothing changes; each round is a few
aggregations, written to the shared folder. Rows get their component by their fingerprint; the fingerprints that hold a
thousandth of all rows or more (so a thousand at the most) are broadcast, the others joined by a shuffle.

Defined results: null text is empty; a text without words has fingerprint zero; a null id never is a
component's name unless all its ids are null; repeated rows come back repeated; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkweft.llm.common import join_weighted, materialise, row_key
from sparkweft.llm.words import lower_az, split_words

REACH = 2
MOST = 32
#: Numbers of groups to choose from: more groups have longer keys in more tables.
GROUPS = (5, 6, 8, 10, 12, 16)
_STEP = 1 << 15


def fingerprint(text: str | None) -> int:
    """SimHash of a text's 3-word shingles, repeats included."""
    words = split_words(lower_az(text or ""))
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < 3:
        return digest(" ".join(words), 42)
    n = len(words) - 2
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _STEP):
        part = words[at : at + _STEP + 2]
        h = np.array([digest(f"{a} {b} {c}", 42) for a, b, c in zip(part, part[1:], part[2:], strict=False)], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, key_text (see common.row_key) and fp, the fingerprint as a signed long."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), row_key(id_col, text_col)[1], F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(x.as_py()) for x in b["text"]], np.uint64).view(np.int64)
            yield pa.record_batch({"id": b["id"], "key_text": b["key_text"], "fp": pa.array(fps, pa.int64())})

    return rows.mapInArrow(run, "id long, key_text long, fp long")


def groups_for(n: int, reach: int = REACH) -> int:
    """The fewest groups whose keys outnumber n fingerprints fourfold: a coordinate carries one and a half bits."""
    return next((g for g in GROUPS if 2 ** (48 * (g - reach) / g) >= 4 * n), GROUPS[-1])


def _pivots(n: int = 16, seed: int = 7) -> list[int]:
    """Further reference fingerprints, fixed for all runs."""
    return [int(x) for x in np.random.default_rng(seed).integers(-(1 << 63), (1 << 63) - 1, n)]


def distances(fp: str = "fp") -> Column:
    """The row of the pivot distance table that belongs to a fingerprint."""
    return F.expr("array(" + ", ".join(f"cast(bit_count({fp} ^ ({p}L)) as tinyint)" for p in _pivots()) + ")")


def _coordinate(fp: str, pair: int) -> str:
    """Ones of fp in a pair of bits, from its distances to zero and to the pair's pivot."""
    mask = 3 << (2 * pair)
    mask -= (1 << 64) if mask >> 63 else 0
    return f"((bit_count({fp}) - bit_count({fp} ^ ({mask}L)) + 2) div 2)"


def cells(fps: DataFrame, reach: int, groups: int) -> DataFrame:
    """fp, key: the cells of the pivot tables that each fingerprint lies in."""
    def packed(pairs: list[int]) -> str:
        return " + ".join(f"{_coordinate('fp', p)} * {3 ** i}L" for i, p in enumerate(pairs))

    tables = fps.select("fp", *(F.expr(packed(list(range(g, 32, groups)))).alias(f"_g{g}") for g in range(groups)))
    keys = [F.struct(F.lit(k).alias("t"), *(F.col(f"_g{g}").alias(f"c{i}") for i, g in enumerate(chosen))) for k, chosen in enumerate(combinations(range(groups), groups - reach))]
    return tables.select("fp", F.explode(F.array(*keys)).alias("key"))


def shared_cells(fps: DataFrame, reach: int, groups: int) -> DataFrame:
    """key, fp, n (members of the cell) and d (distances to the further pivots) of the cells with two or more members; written once."""
    placed = cells(fps, reach, groups)
    sizes = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return materialise(placed.join(sizes, "key").withColumn("d", distances()), "cells")


_FAR = "exists(zip_with(x.d, y.d, (a, b) -> abs(a - b) > {reach}), z -> z)"


def surviving_pairs(shared: DataFrame, reach: int, most: int) -> DataFrame:
    """a, b: pairs of a cell's members (cells of at most `most`) that no pivot tells apart, not yet verified."""
    lists = shared.filter(F.col("n") <= most).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("fp", "d"))).alias("m"))
    pairs = f"""flatten(transform(m, (x, i) -> transform(
        filter(slice(m, i + 2, size(m)), y -> not {_FAR.format(reach=reach)}), y -> named_struct('a', x.fp, 'b', y.fp))))"""
    return lists.select(F.explode(F.expr(pairs)).alias("p")).select("p.a", "p.b")


def pivot_report(fps: DataFrame, reach: int = REACH, groups: int | None = None, most: int = MOST) -> dict[str, int]:
    """How many pairs share a cell, how many of them the further pivots leave, and how many are links."""
    shared = shared_cells(fps, reach, groups or groups_for(fps.count(), reach))
    in_cells = shared.filter(F.col("n") <= most).groupBy("key").agg(F.first("n").alias("n")).agg(F.sum(F.expr("n * (n - 1) div 2"))).first()[0]
    left, found = surviving_pairs(shared, reach, most).agg(F.count(F.lit(1)), F.count_if(F.expr(f"bit_count(a ^ b) <= {reach}"))).first()
    return {"pairs": in_cells or 0, "left": left, "links": found}


def links(fps: DataFrame, reach: int = REACH, groups: int | None = None, most: int = MOST) -> DataFrame:
    """a, b: links that connect exactly what all links between the distinct fingerprints in fps connect."""
    if reach != 2:
        raise ValueError("the way between fingerprints is written for a reach of two bits")
    shared = shared_cells(fps, reach, groups or groups_for(fps.count(), reach))
    pairs = surviving_pairs(shared, reach, most).filter(f"bit_count(a ^ b) <= {reach}")
    crowded = shared.filter(F.col("n") > most).select("fp").distinct()
    meeting = crowded.select("fp", F.explode(F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")).alias("at"))
    # Links of the crowded with each other; a crowded one's links with others are pairs of other, smaller cells or of this one.
    stars = meeting.groupBy("at").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("m")).filter("size(m) > 1").select("a", F.explode("m").alias("b")).filter("a < b")
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root: the smallest node that each node of the links (a, b) reaches."""
    now = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.filter("u <> m").select("u", F.col("m").alias("v"))).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select("v", "m").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v"))).distinct()
        after = materialise(small, "links")
        if after.count() == now.count() and not after.exceptAll(now).limit(1).count():
            return now.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
        now = after
    raise RuntimeError("links did not settle")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH, groups: int | None = None, most: int = MOST) -> DataFrame:
    """id, fingerprint (16 hex digits), component_id (smallest id reachable), root (the component's smallest fingerprint), fp and key_text for each row of docs."""
    rows = materialise(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = materialise(rows.groupBy("fp").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("rows")), "nodes")
    roots = components(links(nodes.select("fp"), reach, groups, most))
    named = materialise(nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "low", "rows", F.coalesce("root", "fp").alias("root")), "roots")
    smallest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    joined = join_weighted(rows, materialise(named.join(smallest, "root"), "components").drop("low"), "fp", "rows", F.col("key_text"))
    return joined.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root", "fp", "key_text")
