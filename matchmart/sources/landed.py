"""The landed state as sorted runs: what complete ingest runs loaded last of every file.

Each addition is one table of (file, uri, checksum, time, run), bucketed and
sorted by file. When a level has ``FANOUT`` of them they become one of the next
level, the latest record of a file winning, so there are as many tables as the
logarithm of the runs. A scan is brought into the same buckets once; the tables
are merge-joined with it where they lie. No manifest that was taken over is
opened again.

A run counts as taken over when its name stands below ``_added``. A crash before
that repeats the addition, one during a compaction leaves tables that say the
same twice; both are harmless, as the latest record wins.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.functions.uris import normalize_uri
from matchmart.operators.latest import keep_first
from matchmart.sources.manifests import UPLOADED, complete_runs, read_manifests, with_action
from matchmart.workspace import exists, remove, subdirectories, touch

FANOUT = 4
_DDL = "file STRING, uri STRING, stg_file_hashkey STRING, ingested_at STRING, run_id STRING"
_ORDER = ("ingested_at", "stg_file_hashkey")


def _latest(rows: DataFrame) -> DataFrame:
    return keep_first(rows, ["file"], [F.col(c).desc_nulls_last() for c in _ORDER])


class LandedRuns:
    """``buckets`` is fixed for the life of the state."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = 16):
        self.spark, self.base, self.buckets = spark, base, buckets

    # --- tables ------------------------------------------------------------

    def tables(self) -> list[str]:
        """Folders of finished tables, as ``<level>-<name>``."""
        return [t for t in subdirectories(self.spark, self.base) if t[0].isdigit() and exists(self.spark, f"{self.base}/{t}/_SUCCESS")]

    def _name(self, folder: str) -> str:
        """The folder under a catalog name, so that its buckets are known; a new session registers it again."""
        name = "landed_" + uuid.uuid5(uuid.NAMESPACE_URL, f"{self.base}/{folder}").hex
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_DDL}) USING parquet CLUSTERED BY (file) SORTED BY (file)"
            f" INTO {self.buckets} BUCKETS LOCATION '{self.base}/{folder}'"
        )
        return name

    def _store(self, rows: DataFrame, level: int) -> None:
        folder = f"{level}-{uuid.uuid4().hex}"
        name = "landed_" + uuid.uuid5(uuid.NAMESPACE_URL, f"{self.base}/{folder}").hex
        (
            rows.select(*[c.split()[0] for c in _DDL.split(", ")]).repartition(self.buckets, "file").write
            .bucketBy(self.buckets, "file").sortBy("file").option("path", f"{self.base}/{folder}").saveAsTable(name)
        )

    def _plain(self, folders: Sequence[str]) -> DataFrame:
        """Rows of several tables read as plain files: a union of bucketed tables does not keep their buckets."""
        return self.spark.read.schema(_DDL).parquet(*[f"{self.base}/{f}" for f in folders])

    # --- additions ---------------------------------------------------------

    def add(self, records: DataFrame, runs: Sequence[str]) -> None:
        """Take over the file records of complete runs."""
        rows = with_action(records, UPLOADED).withColumn("file", normalize_uri("uri"))
        self._store(_latest(rows), 0)
        touch(self.spark, *[f"{self.base}/_added/run_id={r}" for r in runs])
        self._compact(0)

    def forget(self, run: str) -> None:
        """Have a run that is written anew taken over again."""
        remove(self.spark, f"{self.base}/_added/run_id={run}")

    def _compact(self, level: int) -> None:
        folders = [t for t in self.tables() if t.startswith(f"{level}-")]
        if len(folders) < FANOUT:
            return
        self._store(_latest(self._plain(folders)), level + 1)
        for folder in folders:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(folder)}")
        remove(self.spark, *[f"{self.base}/{f}" for f in folders])
        self._compact(level + 1)

    def catch_up(self, manifests: str) -> list[str]:
        """Take over complete runs that are not there yet: names are listed, and only those runs' manifests opened."""
        there = {r.partition("=")[2] for r in subdirectories(self.spark, f"{self.base}/_added")}
        missing = [
            (day.partition("=")[2], run.partition("=")[2])
            for day in subdirectories(self.spark, manifests) if day.startswith("ingest_date=")
            for run in subdirectories(self.spark, f"{manifests}/{day}") if run.startswith("run_id=") and run.partition("=")[2] not in there
        ]
        if not missing:
            return []
        days, runs = sorted({d for d, _ in missing}), [r for _, r in missing]
        wanted = F.col("ingest_date").isin([F.lit(d).cast("date") for d in days]) & F.col("run_id").isin(runs)
        records = read_manifests(self.spark, manifests).where(wanted)
        done = sorted(r["run_id"] for r in records.where("record_type = 'run'").select("run_id").distinct().collect())
        if done:
            self.add(complete_runs(records), done)
        return done

    # --- lookups -----------------------------------------------------------

    def state(self, except_run: str | None = None) -> DataFrame:
        """uri and checksum of the latest record of every file."""
        folders = self.tables()
        rows = self._plain(folders) if folders else self.spark.createDataFrame([], _DDL)
        if except_run is not None:
            rows = rows.where(F.col("run_id") != except_run)
        return _latest(rows).select("uri", "stg_file_hashkey")

    def of(self, scan: DataFrame, except_run: str | None = None) -> DataFrame:
        """The landed uri and checksum of the scanned files (column ``uri``) that have one.

        Only the scan moves. Records of ``except_run`` do not count.
        """
        found = scan.select(normalize_uri("uri").alias("file")).repartition(self.buckets, "file").distinct()
        known = []
        for i, folder in enumerate(self.tables()):
            rows = self.spark.table(self._name(folder))
            if except_run is not None:
                rows = rows.where(F.col("run_id") != except_run)
            found = found.join(rows.select("file", F.struct(*_ORDER, "uri").alias(f"__of_{i}")), "file", "left")
            known.append(F.col(f"__of_{i}"))
        if not known:
            return self.spark.createDataFrame([], "uri STRING, stg_file_hashkey STRING")
        # the greatest record is the latest; greatest skips nulls
        best = known[0] if len(known) == 1 else F.greatest(*known)
        return found.select(best.alias("best")).where("best IS NOT NULL").select("best.uri", "best.stg_file_hashkey")
