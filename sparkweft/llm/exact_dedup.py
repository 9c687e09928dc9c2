"""Exact duplicates without a hot key: local combining, salted merging, global merging.

Rows are the same when their texts are identical after lower-casing A-Z. Every stage groups by the
digest and by the whole normalised text, so a digest shared by different texts never joins them:

1. each map task combines its own copies (Spark's partial aggregation by digest, salt and text; the
   salt is the task's number, so a task sends one row for a text however many copies it holds);
2. the salted groups are merged after the shuffle, at most `salts` rows of a text being left;
3. the winners of the salts are merged by digest and text.

Only ids, counts and digests leave the third stage. Columns other than id and text are not read. Rows get their
group by the digest; digests that hold a thousandth of all rows or more are broadcast, so no task gets all rows of one.

Defined results: a null text is the empty text; among equal texts the row with the largest id stays, a null id
losing to any other; rows that repeat the largest id count in the group's size each time, and just one of them is
marked as kept (which one is the order of reading); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkweft.llm.common import join_weighted, lower_az, materialise, row_key, text_of


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256, salts: int = 64) -> DataFrame:
    """One row per different text: _digest, _norm, keep_id, group_size."""
    norm = lower_az(text_of(text_col))
    rows = docs.select(F.col(id_col).alias("_id"), norm.alias("_norm"), digest(norm).alias("_digest"), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("_salt"))
    salted = rows.groupBy("_digest", "_salt", "_norm").agg(F.max("_id").alias("_id"), F.count(F.lit(1)).alias("_n"))
    return salted.groupBy("_digest", "_norm").agg(F.max("_id").alias("keep_id"), F.sum("_n").alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256, salts: int = 64) -> DataFrame:
    """A row for every row of docs: id, keep_id, group_size, kept, text_sha256, key_text (see common.row_key).

    A digest that stands for one text only (all of them, with SHA-256) is joined by the digest; if a
    digest stands for several, its rows are joined by digest and text.
    """
    found = classes(docs, id_col, text_col, digest, salts)
    by_digest = materialise(
        found.groupBy("_digest").agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.count(F.lit(1)).alias("_texts")),
        "exact",
    )
    norm = lower_az(text_of(text_col))
    names = [F.col(id_col).alias("id"), digest(norm).alias("_digest"), F.sha2(norm, 256).alias("text_sha256"), row_key(id_col, text_col)[1]]
    joined = join_weighted(docs.select(*names), by_digest.filter("_texts = 1"), "_digest", "group_size", F.xxhash64("id", F.spark_partition_id()))
    if by_digest.filter("_texts > 1").limit(1).count():
        shared = by_digest.filter("_texts > 1").select("_digest")
        whole = docs.select(*names, norm.alias("_norm"))
        joined = joined.drop("_texts").unionByName(whole.join(found.join(shared, "_digest", "left_semi"), ["_digest", "_norm"]).drop("_norm"))
    rows = joined.select("id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "key_text")
    return _one_kept(rows, docs.select(F.col(id_col).alias("id"))).withColumnRenamed("id", id_col)


def _one_kept(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """rows with just one kept of those that repeat a group's largest id. Ids alone tell whether there are any; usually there are none."""
    if ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        return rows
    # Written once with a number for each row, so that all that follows sees the same numbers.
    placed = materialise(rows.withColumn("_at", F.monotonically_increasing_id()), "placed")
    first = placed.filter("kept").groupBy("text_sha256", "group_size", "keep_id").agg(F.min("_at").alias("_at")).select("_at", F.lit(True).alias("_first"))
    return placed.join(first, "_at", "left").withColumn("kept", F.coalesce("_first", F.lit(False))).select(*rows.columns)
