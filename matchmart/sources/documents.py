"""Scorecard documents: reading, lineage, rejects.

Two physical forms are read. *Files*: one JSON object per file. *Bundles*: a
Parquet table of raw JSON texts that already carry their manifest record, so a
run over very many documents neither lists tiny files nor shuffles raw text to
find its lineage.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.contracts import CORRUPT_COLUMN, DOCUMENT_DDL
from matchmart.functions.uris import basename, normalize_uri
from matchmart.operators.layout import by_folder
from matchmart.sources.manifests import NoNewInput
from matchmart.workspace import Workspace

_RECORD = ("stg_file_name", "stg_file_hashkey", "ingested_at", "run_id")
_BUNDLE_DDL = (
    "_source STRING, stg_file_name STRING, stg_file_hashkey STRING, ingested_at STRING, value STRING, run_id STRING"
)


class MissingTexts(RuntimeError):
    """Manifest entries whose text is not in the bundle store."""


class UnmatchedDocuments(RuntimeError):
    """Documents without a manifest record."""


def _texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Whole file texts, of subfolders too, with their normalised path."""
    return (
        spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).text(paths)
        .select(normalize_uri(F.col("_metadata.file_path")).alias("_source"), "value")
    )


def read_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per JSON file: parsed fields, malformed text, and ``_source``."""
    return parse(_texts(spark, paths))


def only_listed(documents: DataFrame, names: DataFrame, entries: DataFrame, space: Workspace) -> DataFrame:
    """The documents whose path the entries list.

    Raw texts must not be shuffled to be filtered. The paths alone (``names``,
    a narrow read of the same documents) are compared with the entries, and the
    usually few that are *not* listed are written and dropped by an anti join:
    their file size tells Spark whether to broadcast them.
    """
    keys = [c for c in ("_source", "run_id") if c in names.columns and c in entries.columns]
    unlisted = names.select(*keys).join(entries.select(*keys), keys, "left_anti")
    return documents.join(space.freeze(unlisted.distinct(), "unlisted"), keys, "left_anti")


def listed_keys(entries: DataFrame) -> DataFrame:
    """Normalised path and run of manifest entries."""
    return entries.select(normalize_uri("uri").alias("_source"), "run_id")


def selected_texts(spark: SparkSession, store: str, entries: DataFrame, space: Workspace) -> DataFrame:
    """The stored texts of manifest entries, each with its entry's record.

    An uploaded file's text is in the folder of its run, and other folders are
    not opened. What an entry lists without storing it (a skipped file) is the
    text of the same file and content in an earlier run. Selection compares
    paths, checksums and runs only. An entry without a text is an error.
    """
    keys = ["_source", "stg_file_hashkey", "run_id"]
    records = space.freeze(entries.select(normalize_uri("uri").alias("_source"), *_RECORD), "wanted")
    if records.isEmpty():
        return spark.createDataFrame([], _BUNDLE_DDL)
    stored = read_bundles(spark, store)
    own = stored.join(space.freeze(records.select("run_id").distinct(), "runs"), "run_id", "left_semi")
    held = own.select(*keys)
    rest = space.freeze(records.join(held, keys, "left_anti"), "rest")
    found = only_listed(own, held, records.select(*keys), space)
    if rest.isEmpty():
        return found.select(*stored.columns)
    asked = rest.select("_source", "stg_file_hashkey", F.col("run_id").alias("__asked"))
    earlier = stored.select(*keys).join(asked, ["_source", "stg_file_hashkey"]).where(F.col("run_id") <= F.col("__asked"))
    earlier = space.freeze(earlier.groupBy("_source", "stg_file_hashkey").agg(F.max("run_id").alias("run_id")), "earlier")
    missing = rest.join(earlier, ["_source", "stg_file_hashkey"], "left_anti")
    example = missing.first()
    if example is not None:
        raise MissingTexts(f"{missing.count()} listed files have no stored text, for example {example['_source']} of run {example['run_id']}")
    texts = stored.join(earlier, keys, "left_semi").select("_source", "value")
    return found.select(*stored.columns).unionByName(texts.join(rest, "_source"))


def read_selected(
    spark: SparkSession, store: str, entries: DataFrame, space: Workspace, fail_when_empty: bool = False
) -> DataFrame:
    """The documents of manifest entries, parsed, with their records."""
    if fail_when_empty and entries.isEmpty():
        raise NoNewInput("the selected run lists no file")
    return parse(selected_texts(spark, store, entries, space))


def write_bundles(raw: DataFrame, store: str) -> None:
    """Write raw texts with their records, a folder per run; a run's folder is replaced when it is written again."""
    rows = raw.select("_source", "stg_file_name", "stg_file_hashkey", "ingested_at", "value", "run_id")
    by_folder(rows, "run_id").parquet(store)


def read_bundles(spark: SparkSession, store: str) -> DataFrame:
    """The raw texts with their records; paths normalised."""
    return spark.read.schema(_BUNDLE_DDL).parquet(store).withColumn("_source", normalize_uri("_source"))


def parse(raw: DataFrame, text: str = "value") -> DataFrame:
    """Replace the raw text by its parsed fields.

    Malformed text is kept in the corrupt-record column; blank text counts as
    malformed.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    parsed = raw.withColumn("__doc", F.from_json(text, DOCUMENT_DDL, options))
    kept = [c for c in raw.columns if c != text]
    blank = F.when(F.col("__doc").isNull(), F.ifnull(text, F.lit("")))
    corrupt = F.coalesce(F.col(f"__doc.{CORRUPT_COLUMN}"), blank).alias(CORRUPT_COLUMN)
    return parsed.select(*kept, "__doc.info", "__doc.innings", corrupt)


def attach_manifest(documents: DataFrame, entries: DataFrame) -> DataFrame:
    """Left join on the path, normalised on both sides; documents without a record keep NULLs.

    No broadcast hint: whether the entries are small enough is left to Spark's
    size check at run time.
    """
    records = entries.select(
        normalize_uri("uri").alias("_source"), "stg_file_name", "stg_file_hashkey", "ingested_at", "run_id"
    )
    return documents.withColumn("_source", normalize_uri("_source")).join(records, "_source", "left")


def with_lineage(documents: DataFrame, loaded_at: datetime | Column | str) -> DataFrame:
    """File name (record's, else from the path), row number, load time and ingest date.

    ``loaded_at`` is one value for the whole run, so every table of the run
    carries the same stamp.
    """
    stamp = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at).cast("timestamp")
    return (
        documents.withColumn("stg_file_name", F.ifnull("stg_file_name", basename("_source")))
        .withColumn("stg_file_row_number", F.lit(1))
        .withColumn("stg_modified_ts", stamp)
        .withColumn("ingest_date", F.to_date(F.substring("ingested_at", 1, 10)))
        .drop("ingested_at")
    )


def unmatched(documents: DataFrame) -> DataFrame:
    """Documents no manifest record was found for."""
    return documents.where(F.col("stg_file_hashkey").isNull())


def require_matched(documents: DataFrame) -> DataFrame:
    """The documents, or an error as soon as one has no manifest record."""
    if not unmatched(documents).isEmpty():
        raise UnmatchedDocuments("there are documents that no manifest lists")
    return documents


def well_formed(documents: DataFrame) -> DataFrame:
    return documents.where(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)


def rejects(documents: DataFrame) -> DataFrame:
    """Malformed documents with their raw text."""
    return documents.where(F.col(CORRUPT_COLUMN).isNotNull()).select("_source", CORRUPT_COLUMN)
