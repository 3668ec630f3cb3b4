"""Where intermediate tables live, and reading and writing them.

Everything is written under the shared folder named by ``spark.checkpoint.dir``.
Tables are written, then read back: lineage ends at files that survive the loss
of an executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a scratch folder only for an unconfigured local master."""
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"{_SETTING} must name a folder that every executor can reach")
    return _local_roots.setdefault(context.applicationId, tempfile.mkdtemp(prefix="matchmart-"))


class Workspace:
    """A folder of Parquet tables, each written once under a name."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_root(spark)}/matchmart-{uuid.uuid4().hex}"
        self._written: set[str] = set()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def fresh(self, name: str) -> str:
        """A path nobody has used yet."""
        return self.path(f"{name}-{uuid.uuid4().hex}")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def freeze(self, frame: DataFrame, name: str = "frozen", path: str | None = None) -> DataFrame:
        """Write the frame and continue from the files, so that later reads see the same rows."""
        path = path or self.fresh(name)
        schema = frame.schema
        frame.write.parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def release(self, *paths: str) -> None:
        """Remove intermediate tables of this workspace that are no longer needed."""
        for path in paths:
            if not path.startswith(f"{self.root}/"):
                raise ValueError(f"{path} is not in this workspace")
        remove(self.spark, *paths)

    def once(self, name: str, write: Callable[[str], None]) -> str:
        """Run ``write(path)`` the first time ``name`` is asked for; return the path."""
        if name not in self._written:
            write(self.path(name))
            self._written.add(name)
        return self.path(name)


def _hadoop(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The path and its file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _hadoop(spark, path)
    return bool(fs.exists(target))


def remove(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        target, fs = _hadoop(spark, path)
        fs.delete(target, True)


def touch(spark: SparkSession, *paths: str) -> None:
    """Make empty folders, as marks."""
    for path in paths:
        target, fs = _hadoop(spark, path)
        fs.mkdirs(target)


def subdirectories(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under a path, sorted; empty when there is none."""
    target, fs = _hadoop(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def together(*jobs: Callable[[], Any]) -> list[Any]:
    """Run independent Spark jobs at the same time, so that one fills the cores another leaves idle."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]
