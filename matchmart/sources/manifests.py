"""Run manifests: what every run saw and did, one JSON line per file.

Layout: ``<base>/ingest_date=<date>/run_id=<run>/*.json``. Every run writes a
header record, so a run that found nothing still is the newest run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.contracts import MANIFEST_COLUMNS, MANIFEST_DDL
from matchmart.functions.uris import normalize_uri
from matchmart.operators.latest import keep_first
from matchmart.operators.layout import MAX_RECORDS_PER_FILE, clustered
from matchmart.workspace import subdirectories

FILE_RECORD, RUN_RECORD = "file", "run"
UPLOADED, SKIPPED, ANY = "uploaded", "skipped", "any"


class NoNewInput(RuntimeError):
    """The selected run lists no file to load."""


def run_headers(runs: DataFrame) -> DataFrame:
    """Header records for a frame of (ingest_date, run_id)."""
    blank = [F.lit(None).cast("bigint" if c == "size_bytes" else "string").alias(c) for c in MANIFEST_COLUMNS[1:]]
    return runs.select(F.lit(RUN_RECORD).alias("record_type"), *blank, "ingest_date", "run_id")


def write_manifest(entries: DataFrame, base: str, run_id: str | None = None, ingest_date: str | None = None) -> None:
    """Write the entries as JSON lines, then a header for each run.

    Give ``run_id`` and ``ingest_date`` for a single run; otherwise the entries
    carry both columns. Rewriting a run replaces it. The header comes last: a
    run that has one is complete.
    """
    spark = entries.sparkSession
    if run_id is not None:
        stamp = [F.lit(ingest_date).cast("date").alias("ingest_date"), F.lit(run_id).alias("run_id")]
        runs = spark.range(1).select(*stamp)
        entries = entries.drop("ingest_date", "run_id").select("*", *stamp)
    else:
        runs = entries.select("ingest_date", "run_id").distinct()
    files = entries.withColumn("record_type", F.lit(FILE_RECORD)).select(*MANIFEST_COLUMNS, "ingest_date", "run_id")
    # replacing a run that had no files leaves its folder alone, so then the header replaces it
    headers = "overwrite" if run_id is not None and entries.isEmpty() else "append"
    for rows, mode in ((clustered(files, ["ingest_date", "run_id"]), "overwrite"), (run_headers(runs), headers)):
        (
            rows.write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
            .partitionBy("ingest_date", "run_id")
            .json(base)
        )


def read_manifests(spark: SparkSession, base: str, uri_field: str = "uri") -> DataFrame:
    """All manifest records with the path they came from.

    ``uri_field`` names the line's URI field where manifests were written by
    another tool; lines without a record type count as file records.
    """
    ddl = MANIFEST_DDL if uri_field == "uri" else MANIFEST_DDL.replace(", uri STRING", f", {uri_field} STRING")
    lines = spark.read.schema(ddl).json(base)
    if uri_field != "uri":
        lines = lines.withColumnRenamed(uri_field, "uri")
    return lines.withColumn("record_type", F.ifnull("record_type", F.lit(FILE_RECORD))).withColumn(
        "manifest_path", F.col("_metadata.file_path")
    )


def read_newest_run(spark: SparkSession, base: str) -> DataFrame:
    """The newest run's records, found by folder names alone: older manifests are not opened.

    A run's folder lies under the date of the run, so the greatest run id is
    under the greatest date.
    """
    dates = [d for d in subdirectories(spark, base) if d.startswith("ingest_date=")]
    runs = [r for r in subdirectories(spark, f"{base}/{dates[-1]}") if r.startswith("run_id=")] if dates else []
    if not runs:
        raise NoNewInput("no run has been recorded")
    day, run = dates[-1].partition("=")[2], runs[-1].partition("=")[2]
    picked = (F.col("ingest_date") == F.lit(day).cast("date")) & (F.col("run_id") == run)
    return read_manifests(spark, base).where(picked)


def newest_run(manifest: DataFrame, run: str = "run_id") -> DataFrame:
    """Records of the run with the greatest id (ids sort by time).

    The maximum is a one-row relation, so broadcasting it is bounded by
    definition; on a partitioned manifest it prunes folders at run time.
    """
    newest = manifest.agg(F.max(run).alias(run))
    return manifest.join(F.broadcast(newest), run, "left_semi")


def run_for_date(manifest: DataFrame, date: str, column: str = "ingest_date") -> DataFrame:
    return manifest.where(F.col(column) == F.lit(date).cast("date"))


def with_action(manifest: DataFrame, action: str = ANY) -> DataFrame:
    """Records of one action; anything but the two known actions keeps all."""
    if action not in (UPLOADED, SKIPPED):
        return manifest
    return manifest.where(F.col("action") == action)


def latest_per_uri(manifest: DataFrame, tie_break: tuple[str, ...] = ("stg_file_hashkey",)) -> DataFrame:
    """The most recently ingested record of every URI; spellings that normalise alike are one URI."""
    order = [F.col("ingested_at").desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tie_break]]
    return keep_first(manifest.withColumn("__file", normalize_uri("uri")), ["__file"], order).drop("__file")


def select_entries(
    manifest: DataFrame, mode: str = "latest", action: str = UPLOADED, date: str | None = None
) -> DataFrame:
    """File records to load: newest run, one date, or all runs; one record per URI.

    The action filter comes before picking the latest record of a URI: a later
    *skipped* record must not hide the upload it refers to.
    """
    if mode == "latest":
        chosen = newest_run(manifest)
    elif mode == "date":
        chosen = run_for_date(manifest, date)
    elif mode == "all":
        chosen = manifest
    else:
        raise ValueError(f"mode must be latest, date or all, not {mode!r}")
    return latest_per_uri(with_action(chosen.where(F.col("record_type") == FILE_RECORD), action))


def complete_runs(manifest: DataFrame) -> DataFrame:
    """The file records of runs that have their header; a run that died while writing has none."""
    done = manifest.where(F.col("record_type") == RUN_RECORD).select("ingest_date", "run_id").distinct()
    return manifest.where(F.col("record_type") == FILE_RECORD).join(done, ["ingest_date", "run_id"], "left_semi")


def landed_state(manifest: DataFrame, except_run: str | None = None) -> DataFrame:
    """uri and checksum of what complete runs loaded; ``except_run`` is left out, as if it had not run yet.

    A file of a run that died before its manifest was whole counts as new.
    """
    uploads = with_action(complete_runs(manifest), UPLOADED)
    if except_run is not None:
        uploads = uploads.where(F.col("run_id") != except_run)
    return latest_per_uri(uploads).select("uri", "stg_file_hashkey")


def run_audit(manifest: DataFrame, run: str = "run_id") -> DataFrame:
    """Files and bytes per run and action."""
    return manifest.groupBy(run, "action").agg(
        F.count("*").alias("files"), F.sum("size_bytes").alias("bytes")
    )
