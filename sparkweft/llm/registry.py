"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkweft.llm.bpe import encode_digests
from sparkweft.llm.common import read
from sparkweft.llm.exact_dedup import exact_dedup
from sparkweft.llm.html_extract import extract
from sparkweft.llm.kneser_ney import lm_scores
from sparkweft.llm.packing import pack_documents
from sparkweft.llm.quality_classifier import quality_scores
from sparkweft.llm.quality_rules import QUALITY_SQL, quality_rules
from sparkweft.llm.secrets import scan
from sparkweft.llm.simhash import simhash_components
from sparkweft.llm.substring_dedup import substring_dedup
from sparkweft.session import spread


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spread(read(spark, sf_dir, "pages")))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spread(read(spark, sf_dir, "documents"))).drop("key_text")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality_rules(spread(read(spark, sf_dir, "documents"))).select(*names)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(spread(read(spark, sf_dir, "documents"))).select("doc_id", "fingerprint", "component_id")


def fold(n: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo n; a null id is the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(spread(read(spark, sf_dir, "documents")), fold(7) != 2)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(spread(read(spark, sf_dir, "documents")), read(spark, sf_dir, "labels"), fold(3) != 1)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(spread(read(spark, sf_dir, "documents")))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spread(read(spark, sf_dir, "documents")))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(spread(read(spark, sf_dir, "documents")), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spread(read(spark, sf_dir, "documents")), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_kneser_ney": op3_kneser_ney,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_quality_rules": op8_quality_rules,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
}

_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op2_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_NORM} AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm)""",
    "op8_quality_rules": QUALITY_SQL,
}
