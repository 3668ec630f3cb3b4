"""The corpus pipeline: toxicity, line dedup, near-duplicates, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.llm.common import table, workspace
from matchmart.llm.line_dedup import dedup_lines
from matchmart.llm.mixing import mix_sources
from matchmart.llm.near_dedup import keep_one
from matchmart.llm.packing import pack_documents
from matchmart.llm.toxicity import fit_lexicon, score_toxicity

TOXIC = 0.5
#: texts of this similarity (in hundredths) are near-duplicates
NEAR = 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below ``TOXIC``; the lexicon is learned from the labels of the training rows."""
    lexicon = fit_lexicon(docs, table(spark, sf_dir, "labels"), workspace(spark))
    return score_toxicity(docs, lexicon).where(F.col("__score") < TOXIC).drop("__score")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that larger ids repeat; a document may lose all its text."""
    rows = dedup_lines(docs, workspace(spark))
    changed = F.col("__n_dropped") > 0
    return rows.withColumns({
        "text": F.when(changed, F.col("__kept")).otherwise(F.col("text")),
        "n_chars": F.when(changed, F.length("__kept").cast("long")).otherwise(F.col("n_chars")),
    }).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates, the one of the smallest id."""
    return keep_one(docs, workspace(spark), NEAR)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    mixed = mix_sources(docs, workspace(spark))
    return mixed.withColumn("__copies", F.explode(F.array_repeat(F.lit(1), F.col("__copies").cast("int")))).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their bins."""
    return pack_documents(docs, workspace(spark))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: the stages learn a lexicon, draw by hash and pack; SQL cannot express them
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    space = workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = space.freeze(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
