"""Dimension lookups in several roles.

No join here carries a broadcast hint: dimension tables are read from files, so
Spark knows their size and broadcasts those under its threshold, and adaptive
execution re-plans (and splits skewed partitions) for those above it. Lists of
ids are the exception: their files are small however many they are.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: as many rows may be broadcast; ids pack to a byte or two, so the size of their files says little about the driver's memory
BROADCAST_ROWS = 1_000_000


def moved_if_many(rows: DataFrame) -> DataFrame:
    """Rows that are read from files, marked for a merge join where they are too many to be gathered in the driver."""
    return rows.hint("merge") if rows.count() > BROADCAST_ROWS else rows


def lookup(
    frame: DataFrame,
    dimension: DataFrame,
    key: str,
    roles: Mapping[str, Column],
    take: str,
    how: str = "left",
) -> DataFrame:
    """Add one column per role: ``take`` of the dimension row whose ``key`` equals the role's expression."""
    for name, value in roles.items():
        side = dimension.select(F.col(key).alias("__key"), F.col(take).alias(name))
        frame = (
            frame.withColumn("__wanted", value)
            .join(side, F.col("__wanted") == F.col("__key"), how)
            .drop("__wanted", "__key")
        )
    return frame


def opponent_id(batting: Column, first: Column, second: Column) -> Column:
    """The other side of the match; the first team when the batting side is not the first."""
    return F.when(batting == first, second).otherwise(first)
