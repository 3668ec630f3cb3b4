"""Keyed upsert: update what matches, insert what is new, keep the rest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def reject_repeated_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source itself, failing at run time when a key occurs twice.

    The window needs the same partitioning and order as the merge join on the
    keys, so the check adds no exchange of its own. A NULL key part matches
    nothing and may repeat.
    """
    order = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    repeated = F.lit(f"upsert source repeats key ({', '.join(keys)})")
    checked = source.withColumn("__nth", order)
    return checked.where(
        F.when((F.col("__nth") > 1) & complete, F.raise_error(repeated).cast("boolean")).otherwise(F.lit(True))
    ).drop("__nth")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    insert: Sequence[str] | None = None,
    unique_source: bool = False,
) -> DataFrame:
    """The target after merging the source.

    Matched rows take the ``update`` columns from the source, NULLs included,
    and keep their other columns. Source rows without a match are inserted with
    the ``insert`` columns (default: keys and ``update``), other columns NULL.
    Target rows without a match stay. A repeated source key is an error;
    ``unique_source`` skips that check when the caller already guarantees it.
    """
    insert = list(insert) if insert is not None else [*keys, *update]
    if not unique_source:
        source = reject_repeated_keys(source, keys)
    rest = [c for c in target.columns if c not in keys]
    if set(rest) <= set(update) and set(rest) <= set(insert):
        return _replace_rows(target, source, keys)
    return _merge_columns(target, source, keys, update, insert)


def _replace_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole rows are replaced: drop the matched ones and append the source.

    An anti join lets Spark broadcast a small source instead of moving the target.
    """
    types = {f.name: f.dataType for f in target.schema}
    incoming = source.select(*[F.col(c).cast(types[c]).alias(c) for c in target.columns])
    return target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns).unionByName(incoming)


def _merge_columns(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str], insert: Sequence[str]
) -> DataFrame:
    taken = list(dict.fromkeys([*keys, *update, *insert]))
    t = target.withColumn("__old", F.lit(True)).alias("t")
    s = source.select(*[F.col(c).alias(f"__new_{c}") for c in taken], F.lit(True).alias("__new")).alias("s")
    on = F.lit(True)
    for i, k in enumerate(keys):
        same = F.col(f"t.{k}") == F.col(f"s.__new_{k}")
        on = same if i == 0 else on & same
    old, new = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    columns = []
    for f in target.schema:
        kept = F.col(f"t.{f.name}")
        incoming = F.col(f"__new_{f.name}").cast(f.dataType) if f.name in taken else F.lit(None).cast(f.dataType)
        inserted = incoming if f.name in insert else F.lit(None).cast(f.dataType)
        matched = incoming if f.name in update and f.name not in keys else kept
        columns.append(F.when(old & new, matched).when(old, kept).otherwise(inserted).alias(f.name))
    return t.join(s, on, "full_outer").select(*columns)


def newer_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], version: Sequence[str] = (), place: Sequence[str] = ()
) -> DataFrame:
    """Target and source as one: of a key in both, the source's rows, or the target's if one of them has a greater ``version``.

    All rows are moved once, where a join would move both sides, and again for
    the versions: to their ``place``, columns that the keys determine, so that
    neighbours stay neighbours. A NULL key part matches nothing, so such rows stay.
    """
    place = [*(place or keys)]
    of_key = Window.partitionBy(*dict.fromkeys([*place, *keys]))
    new = F.col("__new")
    rows = target.withColumn("__new", F.lit(False)).unionByName(source.select(*target.columns).withColumn("__new", F.lit(True))).repartition(*place)
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    marks = {"__any": F.max(new).over(of_key)}
    kept = new | ~F.col("__any")
    if version:
        held, least = F.max(F.when(~new, F.struct(*version))), F.min(F.when(new, F.struct(*version)))
        marks["__stale"] = F.coalesce(held.over(of_key) > least.over(of_key), F.lit(False))
        kept = F.when(F.col("__stale"), ~new).otherwise(kept)
    return rows.withColumns(marks).where(~complete | kept).select(*target.columns)


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks, one per key, in the target's columns."""
    unseen = source.join(target.select(*keys), list(keys), "left_anti")
    return unseen.select(*target.columns)
