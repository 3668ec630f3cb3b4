"""Table sinks: history, latest slice, CSV, staging, versioned snapshots, bucketed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.contracts import Contract, conform
from matchmart.operators.layout import CODEC, MAX_RECORDS_PER_FILE, OPEN_FOLDERS, by_folder, clustered, file_count
from matchmart.operators.lookups import BROADCAST_ROWS
from matchmart.operators.upsert import newer_rows, reject_repeated_keys, upsert
from matchmart.workspace import Workspace, exists, remove, subdirectories

HISTORY_PARTITIONS = ("ingest_date", "run_id")


def write_history(frame: DataFrame, base: str, gather: bool = False, files: int = 0) -> None:
    """Replace the run's partitions under (ingest_date, run_id); other runs stay.

    Rows without an ingest date go to the default partition. A run usually has
    one or two dates, so its rows are written where they are, without a
    shuffle; ``gather`` brings the rows of a partition together first, for a
    backfill of many dates.
    """
    laid_out = clustered(frame, HISTORY_PARTITIONS) if gather else file_count(frame, files)
    by_folder(laid_out, *HISTORY_PARTITIONS).parquet(base)


def read_history(spark: SparkSession, base: str, contract: Contract) -> DataFrame:
    """The history with its declared types (partition values are not guessed)."""
    return conform(spark.read.schema(contract.read_schema).parquet(base), contract)


def write_latest(history: DataFrame, path: str, run_id: str, files: int = 0) -> None:
    """Overwrite the fixed location with one run's rows, read from the history.

    The location is a sibling of the history: inside it, readers of the history
    would see conflicting partition folders.
    """
    file_count(history.where(F.col("run_id") == run_id), files).write.mode("overwrite").parquet(path)


def write_csv(frame: DataFrame, path: str, files: int = 0) -> None:
    file_count(frame, files).write.mode("overwrite").option("header", True).csv(path)


def load_staging(spark: SparkSession, path: str, contract: Contract, target: str | None = None) -> DataFrame:
    """Read curated Parquet as the contract's types; with ``target`` replace its runs there, so a rerun adds nothing."""
    rows = conform(spark.read.parquet(path), contract)
    if target is None:
        return rows
    write_history(rows, target)
    return read_history(spark, target, contract)


class Snapshots:
    """Small tables that are rewritten whole: one folder per version, newest finished one wins."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def _finished(self) -> list[str]:
        return [
            v for v in subdirectories(self.spark, self.base)
            if v.startswith("v") and exists(self.spark, f"{self.base}/{v}/_SUCCESS")
        ]

    def location(self) -> str | None:
        """Folder of the current version."""
        done = self._finished()
        return f"{self.base}/{done[-1]}" if done else None

    def current(self) -> DataFrame | None:
        path = self.location()
        return self.spark.read.parquet(path) if path else None

    def replace(self, frame: DataFrame) -> DataFrame:
        """Write the next version; readers keep seeing the old one until it is complete."""
        used = [int(v[1:]) for v in subdirectories(self.spark, self.base) if v.startswith("v")]
        path = f"{self.base}/v{max(used, default=0) + 1:08d}"
        frame.write.parquet(path)
        return self.spark.read.parquet(path)


class BucketedTable:
    """A large keyed table in hash-bucket folders; an upsert rewrites touched buckets only, once.

    Rows lie in ``rows/version=<n>/bucket=<b>``. Which version of a bucket counts is
    said by ``record``, a small table of its own that is replaced after the new
    buckets are complete: until then readers see the table as it was, and a job
    that dies before leaves nothing but folders that ``clean`` removes.

    The first rows are written from where they are, a file per task and bucket,
    as long as a task can hold all buckets open; later versions of a bucket are
    brought together. ``buckets`` is None where the buckets grow with the table.
    A batch of very many rows meets the stored ones where both are brought
    together, once, by bucket and first key column, and is written from there.
    """

    def __init__(self, space: Workspace, path: str, contract: Contract, bucket, buckets: int | None = 64):
        self.space, self.path, self.contract = space, path, contract
        self.bucket, self.buckets = bucket, buckets
        self.spark = space.spark
        self.rows, self.record = f"{path}/rows", Snapshots(space.spark, f"{path}/record")

    def placed(self) -> dict[str, int]:
        """The version that counts of every bucket folder; at most as many as there are buckets."""
        record = self.record.current()
        return {} if record is None else {r["folder"]: r["version"] for r in record.collect()}

    def exists(self) -> bool:
        return bool(self.placed())

    def _with_bucket(self, frame: DataFrame) -> DataFrame:
        return frame.withColumn("bucket", self.bucket(self.buckets))

    def _stored(self, placed: dict[str, int]) -> DataFrame:
        """Rows of the given folders with their bucket; no other folder is listed."""
        schema = self.contract.read_schema.add("bucket", "integer")
        if not placed:
            # no rows by its plan, so a join with it is none
            return self.spark.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
        folders = [f"{self.rows}/version={v}/{f}" for f, v in placed.items()]
        rows = self.spark.read.schema(schema.add("version", "integer")).option("basePath", self.rows).parquet(*folders)
        return rows.drop("version")

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets."""
        placed = self.placed()
        if buckets is not None:
            asked = {_folder(b) for b in buckets}
            placed = {f: v for f, v in placed.items() if f in asked}
        rows = self._stored(placed)
        if buckets is not None and placed:
            known = F.col("bucket").isin([b for b in buckets if b is not None])
            rows = rows.where(known | F.col("bucket").isNull() if None in buckets else known)
        return rows.drop("bucket")

    def _write(self, frame: DataFrame, path: str) -> None:
        (
            clustered(frame, ["bucket"], self.contract.sort)
            .write.mode("overwrite").option("compression", CODEC)
            .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
            .partitionBy("bucket")
            .parquet(path)
        )

    def _write_in_place(self, frame: DataFrame, path: str) -> None:
        if self.buckets is None or self.buckets > OPEN_FOLDERS:
            self._write(frame, path)
        else:
            by_folder(frame, "bucket").option("partitionOverwriteMode", "static").parquet(path)

    def _publish(self, placed: dict[str, int]) -> None:
        """Have the given versions count from now on."""
        lines = [(f, v, None if f == _folder(None) else int(f.partition("=")[2])) for f, v in sorted(placed.items())]
        self.record.replace(self.spark.createDataFrame(lines, "folder string, version int, bucket int").coalesce(1))

    def clean(self) -> None:
        """Remove folders that do not count, superseded or left by a job that died; nobody may be reading or writing them."""
        placed = self.placed()
        for version in subdirectories(self.spark, self.rows):
            folders = subdirectories(self.spark, f"{self.rows}/{version}")
            stale = [f for f in folders if f"version={placed.get(f)}" != version]
            remove(self.spark, *([f"{self.rows}/{version}"] if len(stale) == len(folders) else [f"{self.rows}/{version}/{f}" for f in stale]))

    def merge(self, source: DataFrame, unique_source: bool = False, version: tuple[str, ...] = (), written: bool = False) -> None:
        """Upsert whole rows by the contract's key.

        With ``version`` columns a source row whose version is below that of the
        stored row is left out; equal versions take the source's row. A source
        that is read from files already (``written``) is not written again first.
        """
        key = list(self.contract.key)
        rest = [c for c in self.contract.columns if c not in key]

        def merged(stored: DataFrame, incoming: DataFrame) -> DataFrame:
            if version:
                held = stored.select(*key, F.struct(*version).alias("__held"))
                stale = held.join(incoming.select(*key, F.struct(*version).alias("__new")), key).where("__held > __new")
                incoming = incoming.join(stale.select(*key), key, "left_anti").select(*incoming.columns)
            return upsert(stored, incoming, key, [*rest, "bucket"], unique_source=unique_source)

        def met(stored: DataFrame, incoming: DataFrame) -> DataFrame:
            return newer_rows(stored, incoming, key, version, ["bucket", key[0]])

        if not unique_source and not self.exists():
            source = reject_repeated_keys(conform(source, self.contract), key)
        self._rewrite(source, merged, written=written, many=met if unique_source else None)

    def replace_groups(self, source: DataFrame, group: str, groups: DataFrame) -> None:
        """Drop every row of the given groups and put the source rows in their place.

        The bucket has to depend on the group column alone.
        """
        def merged(stored: DataFrame, incoming: DataFrame) -> DataFrame:
            return stored.join(groups, group, "left_anti").select(*stored.columns).unionByName(incoming)

        self._rewrite(source, merged, groups)

    def _rewrite(self, source: DataFrame, merged, groups: DataFrame | None = None, written: bool = False, many=None) -> None:
        """Write the buckets the source (or the groups) touch as a new version, then have it count.

        ``many`` takes the place of ``merged`` for a source too large to be broadcast.
        """
        source = self._with_bucket(conform(source, self.contract))
        placed = self.placed()
        used = [int(v.partition("=")[2]) for v in subdirectories(self.spark, self.rows)]
        version = max(used, default=0) + 1
        target = f"{self.rows}/version={version}"
        if not placed:
            self._write_in_place(source, target)
            self._publish({f: version for f in subdirectories(self.spark, target)})
            return
        batch = self.space.fresh("incoming")
        incoming = source if written else self.space.freeze(source, path=batch)
        # at most ``buckets`` numbers
        hit = incoming if groups is None else self._with_bucket(groups)
        touched = {_folder(r["bucket"]) for r in hit.select("bucket").distinct().collect()}
        if touched:
            stored = self._stored({f: v for f, v in placed.items() if f in touched})
            if many is not None and incoming.count() > BROADCAST_ROWS:
                self._write_in_place(many(stored, incoming), target)
            else:
                self._write(merged(stored, incoming), target)
            kept = {f: v for f, v in placed.items() if f not in touched}
            # a folder nothing was written for is gone: its rows are
            self._publish(kept | {f: version for f in subdirectories(self.spark, target)})
        self.space.release(batch)


def _folder(bucket: int | None) -> str:
    return f"bucket={'__HIVE_DEFAULT_PARTITION__' if bucket is None else bucket}"
