"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(frame: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given total order.

    Spark plans ``row_number = 1`` with a partial group limit ahead of the
    exchange: each map task ships at most one row per key, so a key that holds
    most of the table costs no more than any other.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return frame.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def keep_first_among(
    frame: DataFrame, contested: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]
) -> DataFrame:
    """``keep_first`` where a key can occur twice only in the groups that ``contested`` lists in its one column.

    The rows of all other groups stay where they are, beside their neighbours.
    ``contested`` is to be read from files, so that Spark knows how small it is.
    """
    (group,) = contested.columns
    listed = contested.withColumnRenamed(group, "__contested")
    same = F.col(group).eqNullSafe(F.col("__contested"))
    rest = frame.join(listed, same, "left_anti")
    return rest.unionByName(keep_first(frame.join(listed, same, "left_semi"), keys, order))
