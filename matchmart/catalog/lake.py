"""The test tables taken through the pipeline, layer by layer, on demand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.catalog import fixtures
from matchmart.plans import marts
from matchmart.plans.warehouse import STAGING, Warehouse
from matchmart.sources.documents import read_bundles, write_bundles
from matchmart.sources.manifests import read_manifests, write_manifest
from matchmart.workspace import Workspace, together

_lakes: dict[tuple[str, str], "Lake"] = {}


class Lake:
    """Each layer is written the first time something above it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self.space = Workspace(spark)
        self.warehouse = Warehouse(self.space)

    def table(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    def raw(self) -> DataFrame:
        path = self.space.once("raw", lambda p: write_bundles(fixtures.documents(self.spark, self.sf_dir), p))
        return read_bundles(self.spark, path)

    def documents(self) -> DataFrame:
        self.space.once("documents", lambda _: self.warehouse.land(self.raw(), fixtures.load_stamp()))
        return self.warehouse.documents()

    def staged(self, name: str) -> DataFrame:
        def write(_: str) -> None:
            self.documents()
            self.warehouse.stage(name)

        self.space.once(f"staged-{name}", write)
        return self.warehouse.staged(name)

    def dim(self, name: str) -> DataFrame:
        def write(_: str) -> None:
            self.staged("match"), self.staged("player")
            self.warehouse.refresh_dimensions(created_at=F.lit("2024-01-06 00:00:00").cast("timestamp"))

        self.space.once("dimensions", write)
        return self.warehouse.dim(name)

    def fact(self) -> DataFrame:
        def write(_: str) -> None:
            self.dim("match"), self.staged("delivery")
            self.warehouse.merge_fact()

        self.space.once("fact", write)
        return self.warehouse.fact()

    def summary(self) -> DataFrame:
        def write(path: str) -> None:
            marts.batsman_summary(self.fact(), self.dim("player"), self.dim("team"), self.dim("match")).write.parquet(path)

        return self.spark.read.parquet(self.space.once("batsman_summary", write))

    def event_manifest(self) -> DataFrame:
        def write(path: str) -> None:
            write_manifest(fixtures.event_manifest(self.spark, self.sf_dir), path)

        return read_manifests(self.spark, self.space.once("event_manifest", write))

    def load_everything(self) -> None:
        self.documents()
        together(*[lambda name=name: self.staged(name) for name in STAGING])
        self.fact()
        self.summary()


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _lakes:
        _lakes[key] = Lake(spark, sf_dir)
    return _lakes[key]
