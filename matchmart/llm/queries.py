"""One query per operator over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from matchmart.llm.class_model import language_digest
from matchmart.llm.common import table, workspace
from matchmart.llm.fingerprints import fingerprint_digest
from matchmart.llm.line_dedup import LINE_DEDUP_SQL, line_dedup_digest
from matchmart.llm.merkle import manifest_digest
from matchmart.llm.mixing import mixing_digest
from matchmart.llm.near_dedup import near_digest
from matchmart.llm.packing import pack_documents
from matchmart.llm.quality import quality_digest
from matchmart.llm.suffix_dedup import REPEATS_SQL, repeats_digest
from matchmart.llm.token_files import token_digest
from matchmart.llm.toxicity import toxicity_digest
from matchmart.llm.vector_search import search_digest
from matchmart.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


VOCABULARY = "word_bpe_49k.json"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), workspace(spark))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(table(spark, sf_dir, "documents"), workspace(spark), public_tokenizers.path(VOCABULARY))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), workspace(spark))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_digest(table(spark, sf_dir, "documents"), workspace(spark))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_digest(table(spark, sf_dir, "documents"), workspace(spark))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_digest(table(spark, sf_dir, "documents"), workspace(spark))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_digest(table(spark, sf_dir, "documents"), workspace(spark))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), workspace(spark))


def op9_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_digest(table(spark, sf_dir, "embeddings"), workspace(spark))


def op10_class_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_digest(table(spark, sf_dir, "documents"), workspace(spark))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_digest(table(spark, sf_dir, "documents"), workspace(spark))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_digest(table(spark, sf_dir, "documents"), workspace(spark))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), workspace(spark))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_token_files": op2_token_files,
    "op3_toxicity": op3_toxicity,
    "op4_line_dedup": op4_line_dedup,
    "op5_mixing": op5_mixing,
    "op6_near_dedup": op6_near_dedup,
    "op7_fingerprints": op7_fingerprints,
    "op8_packing": op8_packing,
    "op9_vector_search": op9_vector_search,
    "op10_class_model": op10_class_model,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_manifest": op12_manifest,
    "op13_whitening": op13_whitening,
}

ORACLES: dict[str, str] = {"op4_line_dedup": LINE_DEDUP_SQL, "op11_suffix_dedup": REPEATS_SQL}
