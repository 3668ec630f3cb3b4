"""What has been done for which batch: one small row per finished step.

A batch is named by its content, so the same runs with the same files are the
same batch, whenever they come again. A batch that was interrupted goes on with
the first step that has no row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from hashlib import sha256

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmart.workspace import Workspace, exists, subdirectories

_DDL = "runs ARRAY<STRING>, finished_at TIMESTAMP, batch STRING, step STRING"


def batch_key(entries: DataFrame, *settings: object) -> str:
    """A name for the content of a batch: per run its files and checksums in any order, and how they are loaded."""
    content = F.sum(F.xxhash64("uri", "stg_file_hashkey", "ingested_at").cast("decimal(38,0)"))
    # one row per run
    rows = entries.groupBy("run_id").agg(F.count("*").alias("files"), content.alias("content")).collect()
    return sha256(repr((sorted((r.run_id, r.files, str(r.content)) for r in rows), settings)).encode()).hexdigest()


class Ledger:
    """A folder per batch and step, so steps that finish at the same time do not meet."""

    def __init__(self, space: Workspace, path: str):
        self.spark, self.path = space.spark, path

    def rows(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], _DDL)
        return self.spark.read.schema(_DDL).parquet(self.path)

    def steps(self, batch: str) -> set[str]:
        """Finished steps of a batch."""
        folder = f"{self.path}/batch={batch}"
        found = subdirectories(self.spark, folder)
        return {f.partition("=")[2] for f in found if exists(self.spark, f"{folder}/{f}/_SUCCESS")}

    def once(self, batch: str | None, runs: Sequence[str], step: str, work: Callable[[], object]) -> None:
        """Do a step that the batch has not finished, then record it; without a batch it is always done."""
        if batch is not None and step in self.steps(batch):
            return
        work()
        if batch is not None:
            row = self.spark.range(1).select(F.array(*[F.lit(r) for r in runs]).cast("array<string>").alias("runs"), F.current_timestamp().alias("finished_at"))
            row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch}/step={step}")
