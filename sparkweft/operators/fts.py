"""Full-text search over an inverted index.

Index: postings (term, id, positions), from lower-case runs of letters and digits, English stop words left out (their
positions stay empty), stemmed; or, plain, from all of them as they are. Queries are compiled on the driver: words are all
wanted, "..." is a phrase, `or` separates alternatives, a leading - excludes; stop words drop out, and a query of nothing
else has no result. Postings come from a stored table (filtered by the terms of the queries, which reaches the scan), or
from texts (`search_texts`), whose terms that no query has never leave the analysis. They are grouped by
query and id, and scored: for each alternative that holds, the sum over its minimal covers of 1 if a cover is at
most `near` positions long, else near / length (cover density; near is our own choice of 16).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from sparkweft.functions.rows import row_udf
from sparkweft.operators.stemmer import stem
from sparkweft.session import BROADCAST_ROWS

_TOKEN = regex.compile(r"[\p{L}\p{N}]+")
NEAR = 16
#: So many terms are put into the scan's filter; beyond that the join alone finds them.
PUSHED_TERMS = 1000
#: English stop words.
STOP = frozenset(
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them their theirs themselves what which who whom this that these those am is are was were be been being "
    "have has had having do does did doing a an the and but if or because as until while of at by for with about against between into through during before after above below to from up down in out on off over under again further then once "
    "here there when where why how all any both each few more most other some such no nor not only own same so than too very s t can will just don should now".split()
)


@lru_cache(maxsize=1 << 16)
def _term(word: str, plain: bool) -> str | None:
    """The term of a word, None for a stop word."""
    return word if plain else None if word in STOP else stem(word)


def analyze(text: str, plain: bool = False, heads: frozenset[str] | None = None) -> list[tuple[str, int]]:
    """(term, position from 1) of the tokens that are no stop words; positions count all tokens. plain: every token as it is.
    heads: first letters (which a stem keeps) of the tokens to take, if not all."""
    return [(t, k) for k, w in enumerate(_TOKEN.findall(text.lower()), 1) if (heads is None or w[0] in heads) and (t := _term(w, plain)) is not None]


def postings(rows: DataFrame, id_col: str, text_col: str = "text", keep: tuple[str, ...] = (), plain: bool = False, wanted: frozenset[str] | None = None) -> DataFrame:
    """term, positions, id and the columns in keep; of the terms in wanted only, if given."""
    heads = None if wanted is None else frozenset(t[0] for t in wanted)

    @row_udf(ArrayType(StructType([StructField("term", StringType()), StructField("positions", ArrayType(IntegerType()))])))
    def indexed(text: str | None) -> list[tuple[str, list[int]]]:
        found: dict[str, list[int]] = {}
        for term, k in analyze(text or "", plain, heads):
            if wanted is None or term in wanted:
                found.setdefault(term, []).append(k)
        return list(found.items())

    return rows.select(id_col, *keep, F.explode(indexed(F.col(text_col))).alias("p")).select(F.col("p.term").alias("term"), id_col, *keep, F.col("p.positions").alias("positions"))


@dataclass(frozen=True)
class Item:
    """Terms at offsets from the first; one term is a word."""

    terms: tuple[tuple[str, int], ...]
    excluded: bool = False


def compile_query(query: str, plain: bool = False) -> list[list[Item]]:
    """Alternatives, each a list of items that all hold."""
    out: list[list[Item]] = [[]]
    for token in re.findall(r'-?"[^"]*"|\S+', query):
        if token.lower() == "or":
            out.append([])
            continue
        found = analyze(token.lstrip("-"), plain)
        if found:
            out[-1].append(Item(tuple((t, k - found[0][1]) for t, k in found), token.startswith("-")))
    return [x for x in out if x]


def occurrences(item: Item, places: dict[str, list[int]]) -> list[tuple[int, int]]:
    """(start, end) of the item among the positions of a text's terms."""
    first, *rest = item.terms
    sets = [(set(places.get(t, ())), k) for t, k in rest]
    return [(p, p + item.terms[-1][1]) for p in places.get(first[0], ()) if all(p + k in s for s, k in sets)]


def cover_density(lists: list[list[tuple[int, int]]], near: int = NEAR) -> float:
    """Sum over the minimal stretches that hold an occurrence of every list."""
    last: dict[int, int] = {}
    total, before = 0.0, -1
    for end, start, k in sorted((b, a, k) for k, one in enumerate(lists) for a, b in one):
        last[k] = max(last.get(k, start), start)
        if len(last) == len(lists):
            begin = min(last.values())
            if begin > before:
                before, length = begin, end - begin + 1
                total += 1.0 if length <= near else near / length
    return total


def score_text(alternatives: list[list[Item]], places: dict[str, list[int]], near: int = NEAR) -> float | None:
    """None if no alternative holds."""
    total, holds = 0.0, False
    for items in alternatives:
        wanted = [occurrences(i, places) for i in items if not i.excluded]
        if all(wanted) and not any(occurrences(i, places) for i in items if i.excluded):
            holds = True
            total += cover_density(wanted, near) if wanted else 0.0
    return total if holds else None


def wanted_terms(queries: dict[int, str], plain: bool = False) -> frozenset[str]:
    return frozenset(t for text in queries.values() for items in compile_query(text, plain) for i in items for t, _ in i.terms)


def search_texts(rows: DataFrame, queries: dict[int, str], id_col: str, text_col: str = "text", near: int = NEAR, plain: bool = False) -> DataFrame:
    """search() over texts that have no stored index: postings are made of the queries' terms alone."""
    index = postings(rows, id_col, text_col, plain=plain, wanted=wanted_terms(queries, plain))
    return search(index, queries, id_col, rows.select(id_col), near, plain)


def search(index: DataFrame, queries: dict[int, str], id_col: str, ids: DataFrame | None = None, near: int = NEAR, plain: bool = False) -> DataFrame:
    """query_id, id, score of the rows that match. ids (all ids) is needed only for alternatives that merely exclude. plain: as the index was made."""
    spark = index.sparkSession
    compiled = {q: c for q, text in queries.items() if (c := compile_query(text, plain))}
    empty = spark.createDataFrame([], f"query_id int, {id_col} {index.schema[id_col].dataType.simpleString()}, score double")
    if not compiled:
        return empty
    terms = sorted({(q, t) for q, alternatives in compiled.items() for items in alternatives for i in items for t, _ in i.terms})
    wanted = spark.createDataFrame(terms, "query_id int, term string")
    names = sorted({t for _, t in terms})
    index = index.filter(F.col("term").isin(names)) if len(names) <= PUSHED_TERMS else index
    hits = index.join(F.broadcast(wanted) if len(terms) <= BROADCAST_ROWS else wanted, "term")
    grouped = hits.groupBy("query_id", id_col).agg(F.collect_list(F.struct("term", "positions")).alias("found"))
    open_ones = [q for q, alternatives in compiled.items() if any(all(i.excluded for i in items) for items in alternatives)]
    if open_ones:
        if ids is None:
            raise ValueError("a query that only excludes needs the ids of all rows")
        none = F.array().cast("array<struct<term: string, positions: array<int>>>")
        for q in open_ones:
            grouped = grouped.unionByName(ids.select(F.lit(q).alias("query_id"), id_col, none.alias("found")).join(grouped.filter(F.col("query_id") == q), id_col, "left_anti"))

    @row_udf("double")
    def score(query_id: int, found: list) -> float | None:
        return score_text(compiled[query_id], {term: sorted(positions) for term, positions in found}, near)

    # Not deterministic for the optimiser, which would score once for the filter and once more for the column.
    return grouped.select("query_id", id_col, score.asNondeterministic()("query_id", "found").alias("score")).filter(F.col("score").isNotNull())


# The part that plain SQL can express: lower-case words, all of them wanted, frequencies summed.


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def and_match(rows: DataFrame, terms: list[str], id_col: str, text_col: str = "text") -> DataFrame:
    """id and score (the summed frequency of the terms) of rows that have every term."""
    split = rows.select(id_col, words(F.col(text_col)).alias("_w"))
    times = lambda t: F.size(F.filter("_w", lambda w: w == t))
    counted = split.select(id_col, *(times(t).alias(f"_{k}") for k, t in enumerate(terms)))
    every = [F.col(f"_{k}") for k in range(len(terms))]
    return counted.filter(" and ".join(f"_{k} > 0" for k in range(len(terms)))).select(id_col, sum(every[1:], every[0]).cast("double").alias("score"))


def ranked(hits: DataFrame, limit: int, id_col: str, by: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """The best `limit` hits of each query with their rank from 1: score falling, then id."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col(id_col))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
