"""The flatten job over document files: select by manifest, check, flatten, write."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.contracts import conform
from matchmart.plans.warehouse import STAGING
from matchmart.sources import documents, manifests, sinks
from matchmart.workspace import Workspace, together


@dataclass(frozen=True)
class Curated:
    """Where the job wrote; ``run_id`` is None when there was nothing to do."""

    run_id: str | None
    history: dict[str, str]
    latest: dict[str, str]
    rejected: DataFrame | None


def curate(
    spark: SparkSession,
    store: str,
    manifest_base: str,
    output: str,
    mode: str = "latest",
    action: str = manifests.UPLOADED,
    date: str | None = None,
    fail_on_unmatched: bool = True,
    fail_when_empty: bool = False,
    output_files: int = 0,
    csv: bool = False,
    loaded_at: datetime | None = None,
    files: str | None = None,
) -> Curated:
    """Flatten the selected documents into match, player and delivery tables.

    ``latest``, ``date`` and ``all`` load the texts their manifests list from the
    bundle store; a listed file without a text is an error. ``files`` loads every
    file below the folder ``files`` and, unless told otherwise, fails when one
    has no manifest record. Each table gets its history partitions and, beside them, a fixed
    folder with the newest run's rows (and a CSV copy on request). Documents
    are parsed once; nothing is appended twice when the job runs again.
    """
    space = Workspace(spark)
    recorded = manifests.read_newest_run(spark, manifest_base) if mode == "latest" else manifests.read_manifests(
        spark, manifest_base)
    picked = manifests.select_entries(recorded, "all" if mode == "files" else mode, action, date)
    entries = space.freeze(picked, "entries")
    if mode == "files":
        found = documents.attach_manifest(documents.read_files(spark, files), entries)
    else:
        found = documents.read_selected(spark, store, entries, space, fail_when_empty)
    parsed = space.freeze(documents.with_lineage(found, loaded_at or datetime.now(timezone.utc)), "parsed")
    if mode == "files" and fail_on_unmatched:
        documents.require_matched(parsed)
    run_id = parsed.agg(F.max("run_id")).first()[0]
    history = {name: f"{output.rstrip('/')}/{contract.name}/history" for name, (contract, _) in STAGING.items()}
    latest = {name: f"{output.rstrip('/')}/{contract.name}/latest" for name, (contract, _) in STAGING.items()}
    if parsed.isEmpty():
        return Curated(None, history, latest, None)

    def write(name: str) -> None:
        contract, build = STAGING[name]
        rows = conform(build(documents.well_formed(parsed)), contract)
        sinks.write_history(rows, history[name], files=output_files)
        written = sinks.read_history(spark, history[name], contract)
        if run_id is not None:
            sinks.write_latest(written, latest[name], run_id, output_files)
            if csv:
                sinks.write_csv(
                    spark.read.schema(contract.read_schema).parquet(latest[name]),
                    f"{output.rstrip('/')}/{contract.name}/csv", output_files,
                )

    together(*[lambda name=name: write(name) for name in STAGING])
    return Curated(run_id, history, latest, documents.rejects(parsed))
