"""Data-quality checks: declared keys, required columns, references, row accounting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmart.contracts import FACT_KEY, Contract
from matchmart.functions.keys import natural_key
from matchmart.plans.contract_split import Split
from matchmart.plans.fact import BALL_KEY, has_ball, keyed


def duplicate_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count. Counting combines on the map side."""
    return frame.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def uniqueness(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Per table: distinct keys that repeat and rows beyond the first of each."""
    def one(name: str, frame: DataFrame, keys: Sequence[str]) -> DataFrame:
        return duplicate_keys(frame, keys).agg(
            F.lit(name).alias("table_name"),
            F.lit(",".join(keys)).alias("key_columns"),
            F.count("*").alias("repeated_keys"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("long").alias("extra_rows"),
        )

    return reduce(DataFrame.unionByName, [one(n, f, k) for n, (f, k) in tables.items()])


def null_counts(name: str, frame: DataFrame, columns: Sequence[str], max_share: float = 0.0) -> DataFrame:
    """NULLs per column and whether their share stays within the threshold. One pass over the table."""
    counts = frame.agg(F.count("*").alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns])
    return counts.select(
        F.lit(name).alias("table_name"), F.col("__rows").alias("rows"), F.inline(rows)
    ).withColumn("within_threshold", F.col("nulls") <= F.lit(max_share) * F.col("rows"))


def required_columns(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], max_share: float = 0.0) -> DataFrame:
    return reduce(DataFrame.unionByName, [null_counts(n, f, c, max_share) for n, (f, c) in tables.items()])


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-NULL foreign keys without a parent, with the number of rows that use them.

    Counted per key before the anti join, so a hot key travels once.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count("*").alias("rows")
    )
    known = parent.select(F.col(parent_key).alias("value"))
    return used.join(known, "value", "left_anti")


def references(contract: Contract, child: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Per declared foreign key: orphaned values and rows."""
    def one(column: str, table: str, key: str) -> DataFrame:
        return orphans(child, column, parents[table], key).agg(
            F.lit(contract.name).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(table).alias("parent_table"),
            F.count("*").alias("orphan_values"),
            F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("orphan_rows"),
        )

    parts = [one(c, t, k) for c, (t, k) in contract.references.items()]
    return reduce(DataFrame.unionByName, parts)


def reconcile(deliveries: DataFrame, fact: DataFrame) -> DataFrame:
    """Where the staged delivery rows went: fact, later versions or wickets, empty rows, unresolved.

    Three passes: one over the staged rows, one joining distinct balls with the
    fact by ball key, one over the fact.
    """
    no_ball = ~has_ball()
    staged = deliveries.agg(
        F.count("*").alias("staged"),
        F.count_if(no_ball & F.col("innings_number").isNull()).alias("rejected_no_innings"),
        F.count_if(no_ball & F.col("innings_number").isNotNull()).alias("rejected_no_overs"),
    )
    per_ball = (
        keyed(deliveries).groupBy(*BALL_KEY).agg(F.count("*").alias("copies"))
        .withColumnsRenamed({"match_type_number": "match_id", "over": "over_number"})
    )
    loaded = fact.select(*FACT_KEY, F.lit(True).alias("__loaded"))
    balls = per_ball.join(loaded, list(FACT_KEY), "left").agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("long").alias("deduplicated"),
        F.count_if(F.col("__loaded").isNull()).alias("rejected_unresolved"),
    )
    in_fact = fact.agg(F.count("*").alias("fact"))

    def steps(row: DataFrame) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("step"), F.col(c).alias("n")) for c in row.columns])
        return row.select(F.inline(pairs))

    return steps(staged).unionByName(steps(balls)).unionByName(steps(in_fact))


def reconcile_split(staged: DataFrame, parts: Split) -> DataFrame:
    """The account of ``reconcile`` from a stored split: its observed counts and its rejects."""
    missing = parts.rejected.agg(
        F.count_if(F.col("over_number").isNull() & F.col("innings_number").isNull()).alias("rejected_no_innings"),
        F.count_if(F.col("over_number").isNull() & F.col("innings_number").isNotNull()).alias("rejected_no_overs"),
        F.count_if(F.col("over_number").isNotNull()).alias("rejected_unresolved"),
    )
    totals = staged.agg(
        F.count("*").alias("staged"), (F.count("*") - F.lit(parts.counts["rows"])).alias("deduplicated"),
        F.lit(parts.counts["accepted"]).cast("long").alias("fact"),
    )

    def steps(row: DataFrame) -> DataFrame:
        return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("step"), F.col(c).alias("n")) for c in row.columns])))

    return steps(totals).unionByName(steps(missing))


def unknown_sides(deliveries: DataFrame, matches: DataFrame) -> DataFrame:
    """Rows whose batting side is neither of the match's two teams."""
    teams = matches.select(
        "match_type_number", natural_key("first_team").alias("__one"), natural_key("second_team").alias("__two")
    ).distinct()
    side = natural_key("country")
    stray = ~(side.eqNullSafe(F.col("__one")) | side.eqNullSafe(F.col("__two")))
    return deliveries.where("country IS NOT NULL").join(teams, "match_type_number").where(stray).drop("__one", "__two")


def off_roster(fact: DataFrame) -> DataFrame:
    """Balls whose striker, non-striker or bowler is in no squad, counted per role."""
    roles = ("striker_id", "non_striker_id", "bowler_id")
    counts = fact.agg(*[F.count_if(F.col(r).isNull()).alias(r) for r in roles])
    pairs = F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("balls")) for r in roles])
    return counts.select(F.inline(pairs))
