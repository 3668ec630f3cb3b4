"""Ball-grain fact: latest version per ball, resolved keys, derived flags."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchmart.contracts import FACT_DELIVERY, STG_DELIVERY, conform
from matchmart.functions import scorecard as rules
from matchmart.functions.keys import composite_key, match_bucket, natural_key
from matchmart.operators.latest import keep_first_among
from matchmart.operators.lookups import lookup, opponent_id
from matchmart.plans.contract_split import Split, length_rules, split
from matchmart.sources.sinks import BucketedTable
from matchmart.workspace import Workspace

BALL_KEY = STG_DELIVERY.key


def contested_matches(deliveries: DataFrame) -> DataFrame:
    """Matches in which a ball may occur twice.

    One bit per ball of an over: where there are fewer bits than rows, a ball
    came twice (or an over has more than 64 balls). Only a row per over is moved.
    """
    over = ["match_type_number", "innings_number", "over"]
    bits = F.bit_or(F.expr("shiftleft(1L, ball_in_over)"))
    counted = deliveries.groupBy(*over).agg(F.count("*").alias("rows"), F.coalesce(F.bit_count(bits), F.lit(0)).alias("balls"))
    return counted.where("rows > balls").select("match_type_number").distinct()


def latest_per_ball(deliveries: DataFrame, space: Workspace | None = None) -> DataFrame:
    """One row per ball: latest load, then a fixed order of files, then the first wicket.

    A further wicket always has its ball's first wicket beside it in the same
    document, so it never survives and is dropped before the exchange. Balls of
    matches in which none comes twice are not moved.
    """
    space = space or Workspace(deliveries.sparkSession)
    deliveries = deliveries.where(F.coalesce("wicket_index", F.lit(1)) == 1)
    order = [
        F.col("stg_modified_ts").desc_nulls_last(),
        F.col("stg_file_hashkey").desc_nulls_last(),
        F.col("wicket_index").asc_nulls_last(),
        F.col("stg_file_name").asc_nulls_last(),
    ]
    contested = space.freeze(contested_matches(deliveries), "contested")
    return keep_first_among(deliveries, contested, BALL_KEY, order)


def has_ball() -> Column:
    """Whether a staged row names a ball."""
    return reduce(and_, [F.col(c).isNotNull() for c in BALL_KEY])


def keyed(deliveries: DataFrame) -> DataFrame:
    """Rows that name a ball."""
    return deliveries.where(has_ball())


def keyless(deliveries: DataFrame) -> DataFrame:
    """Rows of empty documents and empty innings: no ball, rejected by the fact."""
    return deliveries.where(~has_ball())


def with_ball_flags(balls: DataFrame) -> DataFrame:
    off_bat = rules.runs_off_bat(F.col("total"), F.col("extras"))
    return (
        balls.withColumn("runs_off_bat", off_bat)
        .withColumn("is_boundary_4", rules.scored(off_bat, 4))
        .withColumn("is_boundary_6", rules.scored(off_bat, 6))
        .withColumn("is_wicket", F.col("player_out").isNotNull())
    )


def with_sides(balls: DataFrame, matches: DataFrame, teams: DataFrame, how: str = "inner") -> DataFrame:
    """Batting and bowling team ids and keys; balls of unknown matches or teams drop out, or stay with ``how="left"``."""
    sides = matches.select("match_id", "first_team_id", "second_team_id", F.lit(True).alias("known_match"))
    batting = teams.select(F.col("team_id").alias("batting_team_id"), F.col("team_key").alias("batting_key"))
    bowling = teams.select(F.col("team_id").alias("bowling_team_id"), F.col("team_key").alias("bowling_key"))
    other = opponent_id(F.col("batting_team_id"), F.col("first_team_id"), F.col("second_team_id"))
    return (
        balls.withColumn("match_id", F.col("match_type_number"))
        .join(sides, "match_id", how)
        .withColumn("batting_key", natural_key("country"))
        .join(batting, "batting_key", how)
        .withColumn("bowling_team_id", other)
        .join(bowling, "bowling_team_id", how)
    )


def with_players(balls: DataFrame, players: DataFrame) -> DataFrame:
    """Striker, non-striker and bowler ids; names outside the squads stay NULL."""
    roles = {
        "striker_id": composite_key("batter", "batting_key"),
        "non_striker_id": composite_key("non_striker", "batting_key"),
        "bowler_id": composite_key("bowler", "bowling_key"),
    }
    return lookup(balls, players, "player_key", roles, take="player_id")


def _as_fact(resolved: DataFrame) -> DataFrame:
    return resolved.withColumns({
        "over_number": F.col("over"),
        "total_runs": F.col("total"),
        "wicket_kind": F.col("player_out_kind"),
        "fielder_names": F.col("player_out_fielders"),
    })


def fact_delivery(
    deliveries: DataFrame, matches: DataFrame, teams: DataFrame, players: DataFrame, space: Workspace | None = None
) -> DataFrame:
    """Staged deliveries as fact rows.

    Deduplication comes first, on the four-part ball key, which no match can
    skew; the match lookup afterwards is an inner join whose ball side adaptive
    execution may split.
    """
    balls = with_ball_flags(latest_per_ball(keyed(deliveries), space))
    resolved = with_players(with_sides(balls, matches, teams), players)
    return conform(_as_fact(resolved), FACT_DELIVERY)


def fact_rules() -> dict[str, Column]:
    """What keeps a staged row out of the fact. Lookups are blamed for keys that are there."""
    known = F.coalesce("known_match", F.lit(False))
    rules = {f"{c} is missing": F.col(c).isNull() for c in FACT_DELIVERY.key}
    rules["match is unknown"] = F.col("match_id").isNotNull() & ~known
    rules["batting side is unknown"] = F.col("batting_key").isNotNull() & F.col("batting_team_id").isNull()
    rules["bowling side is unknown"] = known & F.col("batting_team_id").isNotNull() & F.col("bowling_key").isNull()
    return rules | length_rules(FACT_DELIVERY)


def split_deliveries(
    deliveries: DataFrame, matches: DataFrame, teams: DataFrame, players: DataFrame, space: Workspace, path: str | None = None
) -> Split:
    """Staged rows as fact rows and rejects; rows that a later version or the first wicket of a ball stands for are in neither.

    Rows without a ball have nothing to be deduplicated by and go past it. All
    lookups keep their rows, so one pass tells everything that is wrong with a row.
    """
    balls = latest_per_ball(keyed(deliveries), space).unionByName(keyless(deliveries))
    resolved = with_players(with_sides(with_ball_flags(balls), matches, teams, "left"), players)
    rows = _as_fact(resolved).select(*FACT_DELIVERY.columns, "known_match", "batting_key", "bowling_key", "stg_file_name", "run_id")
    return split(rows, fact_rules(), space, path)


def fact_table(space: Workspace, path: str, buckets: int = 64) -> BucketedTable:
    return BucketedTable(
        space, path, FACT_DELIVERY, lambda n: match_bucket("match_id", "over_number", n), buckets
    )
