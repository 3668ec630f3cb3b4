"""Row numbers and surrogate ids without one task seeing a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchmart.workspace import Workspace

_ROW_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def dense_ids(frame: DataFrame, order: Sequence[str], id_column: str, space: Workspace, start: int = 0) -> DataFrame:
    """Number rows ``start + 1, start + 2, ...`` in the order of unique ``order`` columns.

    Equal to a global ``row_number`` but sorted by ranges: each task numbers its
    own range, and a range begins after the rows of the ranges before it. Only
    one count per range comes to the driver.
    """
    ranged = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    positioned = space.freeze(ranged.withColumn("__at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("__at", _ROW_BITS).cast("int")
    counts = {r["part"]: r["n"] for r in positioned.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return frame.withColumn(id_column, F.lit(None).cast("long"))
    before, offsets = start, []
    for p in range(max(counts) + 1):
        offsets.append(before)
        before += counts.get(p, 0)
    offset = F.get(F.lit(offsets).cast("array<bigint>"), part)
    local = F.col("__at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return positioned.withColumn(id_column, offset + local + F.lit(1)).drop("__at")


def number_within(
    frame: DataFrame, group: Sequence[str], blocks: Sequence[str], order: Sequence[str], name: str
) -> DataFrame:
    """Number the rows of every group from 1 in the order ``blocks + order``.

    ``blocks`` are the leading order columns. Rows are sorted per (group,
    block) only, and each block starts after the counts of the blocks before it,
    so a huge group is spread over its blocks.
    """
    block_key = [*group, *blocks]
    inside = Window.partitionBy(*block_key).orderBy(*order)
    earlier = Window.partitionBy(*group).orderBy(*blocks).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        frame.groupBy(*block_key)
        .agg(F.count("*").alias("__rows"))
        .withColumn("__start", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
        .drop("__rows")
    )
    ranked = frame.withColumn("__inside", F.row_number().over(inside))
    return (
        ranked.join(starts, block_key)
        .withColumn(name, (F.col("__start") + F.col("__inside")).cast("int"))
        .drop("__start", "__inside")
    )
