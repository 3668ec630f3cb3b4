"""Content checksums and change detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.functions.uris import normalize_uri
from matchmart.operators.latest import keep_first

NEW, CHANGED, UNCHANGED = "new", "changed", "unchanged"


def _contents(spark: SparkSession, path: str | list[str], pattern: str, modified_after: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.load(path)


def _found() -> list[Column]:
    return [
        normalize_uri("path").alias("uri"),
        F.col("length").alias("size_bytes"),
        F.sha2("content", 256).alias("stg_file_hashkey"),
    ]


def scan_files(
    spark: SparkSession, path: str | list[str], pattern: str = "*.json", modified_after: str | None = None
) -> DataFrame:
    """uri, size_bytes and SHA-256 of every file; hashing runs in the tasks that read the files."""
    return _contents(spark, path, pattern, modified_after).select(*_found())


def scan_texts(
    spark: SparkSession, path: str | list[str], pattern: str = "*.json", modified_after: str | None = None
) -> DataFrame:
    """Like ``scan_files``, and the text: one read gives both, so a checksum is always that of the text beside it."""
    return _contents(spark, path, pattern, modified_after).select(*_found(), F.decode("content", "UTF-8").alias("value"))


def with_checksum(frame: DataFrame, text: str | Column, name: str = "stg_file_hashkey") -> DataFrame:
    """SHA-256 hex of a whole text column."""
    return frame.withColumn(name, F.sha2(text, 256))


def detect_changes(scan: DataFrame, landed: DataFrame, key: str, digest: str) -> DataFrame:
    """Every scanned row with ``status`` new, changed or unchanged against the landed state.

    ``landed`` holds one row per key.
    """
    known = landed.select(F.col(key), F.col(digest).alias("__landed"), F.lit(True).alias("__seen"))
    status = (
        F.when(F.col("__seen").isNull(), F.lit(NEW))
        .when(F.col("__landed").eqNullSafe(F.col(digest)), F.lit(UNCHANGED))
        .otherwise(F.lit(CHANGED))
    )
    return scan.join(known, key, "left").withColumn("status", status).drop("__landed", "__seen")


def work_list(scan: DataFrame, landed: DataFrame, key: str, digest: str) -> DataFrame:
    """Scanned rows that have to be loaded: no landed row has the same key and content."""
    return scan.join(landed.select(key, digest), [key, digest], "left_anti")


def first_per_content(scan: DataFrame, key: str, digest: str) -> DataFrame:
    """One row per distinct content, the one with the smallest key."""
    return keep_first(scan, [digest], [F.col(key).asc()])
