"""Named queries: a Spark builder with the SQL that computes the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchmart.catalog.lake import Lake, lake


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Lake], DataFrame]
    sql: str

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(self.build(lake(spark, sf_dir)))


QUERIES: dict[str, Query] = {}


def query(sql: str) -> Callable[[Callable[[Lake], DataFrame]], Callable[[Lake], DataFrame]]:
    """Register the decorated builder under its own name."""
    def register(build: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
        QUERIES[build.__name__] = Query(build.__name__, build, sql)
        return build

    return register


def comparable(frame: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text and small integers as int, so both engines print values alike."""
    def one(f: T.StructField):
        if isinstance(f.dataType, T.DateType):
            return F.col(f.name).cast("string").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        if isinstance(f.dataType, T.ShortType):
            return F.col(f.name).cast("int").alias(f.name)
        return F.col(f.name)

    return frame.select(*[one(f) for f in frame.schema])
