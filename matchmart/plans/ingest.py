"""An ingest run over landed files: checksum, compare, record, compact."""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.functions.uris import basename
from matchmart.sources import checksums, documents, manifests
from matchmart.sources.landed import LandedRuns
from matchmart.workspace import Workspace, subdirectories


@dataclass(frozen=True)
class IngestOutcome:
    run_id: str
    uploaded: int
    skipped: int
    elapsed_seconds: float


def landed(spark: SparkSession, base: str, except_run: str | None = None) -> DataFrame:
    """What other complete runs loaded, read from all manifests; nothing before the first run."""
    if not subdirectories(spark, base):
        return spark.createDataFrame([], "uri STRING, stg_file_hashkey STRING")
    return manifests.landed_state(manifests.read_manifests(spark, base), except_run)


def ingest(
    spark: SparkSession,
    files: str,
    base: str,
    store: str,
    space: Workspace,
    run_at: datetime,
    source: str = "",
    modified_after: str | None = None,
) -> IngestOutcome:
    """Hash every file, mark new and changed ones ``uploaded`` and the others ``skipped``.

    Files are read once, for checksum and text together. The uploaded ones'
    texts go to the bundle store before the manifest is written: a run that
    dies in between is simply run again, and running a run again repeats it.
    ``modified_after`` leaves older files unopened and unrecorded. What earlier
    runs landed is kept beside the manifests, in ``<base>_landed``; only manifests
    of runs it does not have yet are opened.
    """
    started = time.monotonic()
    known = LandedRuns(spark, f"{base}_landed")
    known.catch_up(base)
    run_id, date = run_at.strftime("%Y%m%d_%H%M%S"), run_at.strftime("%Y-%m-%d")
    kept = space.fresh("scanned")
    scanned = space.freeze(checksums.scan_texts(spark, files, modified_after=modified_after), path=kept)
    found = scanned.drop("value")
    changes = checksums.detect_changes(found, known.of(found, except_run=run_id), "uri", "stg_file_hashkey")
    action = F.when(F.col("status") == checksums.UNCHANGED, F.lit(manifests.SKIPPED)).otherwise(
        F.lit(manifests.UPLOADED)
    )
    entries = space.freeze(
        changes.select(
            F.regexp_replace("uri", r"^[a-z0-9]+:/*", "").alias("object_key"),
            "uri",
            basename("uri").alias("stg_file_name"),
            "stg_file_hashkey",
            F.lit(run_at.strftime("%Y-%m-%dT%H:%M:%SZ")).alias("ingested_at"),
            "size_bytes",
            F.lit(source).alias("source_url"),
            action.alias("action"),
            F.lit(run_id).alias("run_id"),
        ),
        "entries",
    )
    counts = {r["action"]: r["files"] for r in manifests.run_audit(entries).collect()}
    if counts.get(manifests.UPLOADED):
        unchanged = space.freeze(manifests.with_action(entries, manifests.SKIPPED).select("uri"), "unchanged")
        stamp = entries.select("ingested_at").first()["ingested_at"]
        documents.write_bundles(
            scanned.join(unchanged, "uri", "left_anti").select(
                F.col("uri").alias("_source"), basename("uri").alias("stg_file_name"), "stg_file_hashkey",
                F.lit(stamp).alias("ingested_at"), "value", F.lit(run_id).alias("run_id"),
            ).hint("rebalance", "run_id"), store,
        )
    # the next run takes this one over, from its finished manifest
    known.forget(run_id)
    manifests.write_manifest(entries, base, run_id, date)
    space.release(kept)
    return IngestOutcome(
        run_id, counts.get(manifests.UPLOADED, 0), counts.get(manifests.SKIPPED, 0),
        round(time.monotonic() - started, 2),
    )
