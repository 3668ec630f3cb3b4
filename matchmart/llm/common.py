"""What the operators of this folder share: reading tables, words, row identity and deterministic draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.workspace import Workspace

#: the white space that separates words: space and the five ASCII controls from tab to carriage return
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: stands for a null id where an id is compared
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workspace(spark: SparkSession) -> Workspace:
    return Workspace(spark)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    ``lower`` folds all of Unicode, but does so much faster than ``translate``
    works, and gives the same for text without other upper-case characters.
    """
    folds_alike = (F.octet_length(text) == F.length(text)) | ~text.rlike(r"[\p{Lu}\p{Lt}\p{Nl}\p{So}&&[^\p{ASCII}]]")
    return F.when(folds_alike, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def word_count(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column, parts: int, which: int) -> Column:
    """Whether crc32 of the id's text falls into one residue class; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == which, F.lit(False))


def unit_draw(*of: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the arguments alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *of), 11)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, bound: int, space: Workspace) -> DataFrame:
    """At most about ``bound`` training rows ``(doc_id, text, label)``, drawn by hash of the id.

    Training rows are those whose crc32 of the id's text is not a multiple of 5.
    Rows that share an id with contradicting labels and rows without label are left out.
    """
    known = (
        labels.where(F.col(column).isin(0, 1) & ~held_out(F.col("doc_id"), 5, 0) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(column).alias("label"), F.max(column).alias("__most"))
        .where(F.col("label") == F.col("__most"))
        .drop("__most")
    )
    known = space.freeze(known, "labels")
    share = min(1.0, bound / max(1, known.count()))
    drawn = known.where(unit_draw(F.col("doc_id"), seed=5) <= share)
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    return space.freeze(texts.join(drawn, "doc_id"), "sample")
