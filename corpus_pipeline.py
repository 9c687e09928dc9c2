"""The corpus pipeline: quality rules, exact dedup, SimHash near-dedup, secret scan, best-fit packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. The first four
return docs' columns: rows that fail the quality rules go; of equal texts the one with the largest id stays; of
each group of near copies the one with the smallest id stays; secrets are replaced by a mark, and no row goes for
them. The last one returns the packed pieces.

Defined results: null text is empty, and fails the quality rules; rows with a null id take part like any other; of
rows that repeat id and text the dedup stages leave one (of near copies with the smallest id, or all without one, the one
with the smallest hash of its text); empty tables give empty results; further columns, of any names, are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkweft.llm.common import drop_rows, join_weighted, materialise, one_of_each, read, text_of
from sparkweft.llm.exact_dedup import exact_dedup
from sparkweft.llm.packing import pack_documents
from sparkweft.llm.quality_rules import quality_rules
from sparkweft.llm.secrets import redact
from sparkweft.llm.simhash import simhash_components
from sparkweft.session import spread


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = [c for c in ("lang", "source") if c in docs.columns]
    rows = docs.select("doc_id", "text", *groups, F.xxhash64(text_of()).alias("key_text"))
    judged = quality_rules(rows, ("doc_id", "key_text"))
    return drop_rows(docs, judged.filter(~F.col("kept")).select(F.col("doc_id").alias("key_id"), "key_text"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = materialise(exact_dedup(docs).select(F.col("doc_id").alias("key_id"), "key_text", "kept"), "copies")
    # A row that repeats the id and the text of the one that stays has its key: one_of_each leaves one of them.
    staying = found.filter("kept").select(F.col("key_id").alias("_id"), F.col("key_text").alias("_text"))
    dropped = found.filter("not kept").join(staying, F.col("key_id").eqNullSafe(F.col("_id")) & (F.col("key_text") == F.col("_text")), "left_anti")
    return one_of_each(drop_rows(docs, dropped))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = materialise(simhash_components(docs).select(F.col("doc_id").alias("key_id"), "key_text", "root"), "near")
    place = F.struct(F.col("key_id").isNull().alias("unknown"), "key_id", "key_text")
    best = materialise(found.groupBy("root").agg(F.min(place).alias("best"), F.count(F.lit(1)).alias("n")), "best")
    others = join_weighted(found, best, "root", "n", F.col("key_text")).filter(~place.eqNullSafe(F.col("best")))
    return one_of_each(drop_rows(docs, others.select("key_id", "key_text")))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", keep_good),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack),
]
#: SimHash components, the network's findings and the bins cannot be put into SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read(spark, sf_dir, "documents"))
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {}
