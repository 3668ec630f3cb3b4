"""Dimension builders: distinct members from staging, stable ids, upsert.

Every builder takes the current dimension (or None) and returns the merged one.
Ids of known members never change; new members are numbered after the largest
id in the order of their natural key, so a rebuild gives the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchmart.contracts import DIM_DATE, DIM_MATCH, DIM_PLAYER, DIM_TEAM, DIM_VENUE, Contract, conform
from matchmart.functions import scorecard as rules
from matchmart.functions.keys import date_key, natural_key, padded_key, venue_key
from matchmart.operators.latest import keep_first, keep_first_among
from matchmart.operators.lookups import lookup
from matchmart.operators.numbering import dense_ids
from matchmart.operators.upsert import insert_only, upsert
from matchmart.sources.sinks import BucketedTable
from matchmart.workspace import Workspace

TEAM_COLUMNS = ("first_team", "second_team", "toss_winner", "winner")


def _merge_members(
    current: DataFrame | None,
    members: DataFrame,
    contract: Contract,
    id_column: str,
    natural: str,
    space: Workspace,
    created_at: Column | None = None,
) -> DataFrame:
    """Upsert members (one row per natural key), giving ids to the unseen ones.

    The members are few compared with the rows they were found in; they are
    written once and everything after works on that. A name that was ingested
    later stays, and of two of the same day the smaller one: neither the order
    of runs nor their repetition matters.
    """
    attributes = [c for c in members.columns if c != natural]
    stamped = [] if created_at is None else [created_at.alias("created_at")]
    if current is None:
        return conform(dense_ids(members, [natural], id_column, space).select("*", *stamped), contract)
    members = space.freeze(members, "members")
    names = [c for c in attributes if c != "named_at"]
    held = current.select(natural, _day("named_at").alias("__day"), F.struct(*names).alias("__names"))
    newer = (F.col("__day") > _day("named_at")) | ((F.col("__day") == _day("named_at")) & (F.col("__names") <= F.struct(*names)))
    members = members.join(members.join(held, natural).where(newer).select(natural), natural, "left_anti")
    start = current.agg(F.max(id_column)).first()[0] or 0
    unseen = members.select(natural).join(current.select(natural), natural, "left_anti")
    source = members.join(dense_ids(unseen, [natural], id_column, space, start), natural, "left").select("*", *stamped)
    insert = [c for c in contract.columns if c in source.columns]
    return upsert(current, source, [natural], attributes, insert, unique_source=True)


def _day(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("0001-01-01").cast("date"))


def team_names(matches: DataFrame) -> DataFrame:
    """Every team name in any of the four roles: one scan, one row per role, NULLs dropped."""
    names = F.explode(F.array(*TEAM_COLUMNS))
    return matches.select(names.alias("team_name"), "ingest_date").where("team_name IS NOT NULL")


def _one_per_key(rows: DataFrame, key: str, *names: str) -> DataFrame:
    """Most recently ingested spelling per key, then the smallest, with its day.

    The rows are first reduced to distinct spellings with their latest date, a
    hash aggregate that combines on the map side.
    """
    spellings = rows.groupBy(key, *names).agg(F.max("ingest_date").alias("named_at"))
    order = [F.col("named_at").desc_nulls_last(), *[F.col(n).asc_nulls_last() for n in names]]
    return keep_first(spellings, [key], order)


def team_members(matches: DataFrame) -> DataFrame:
    return _one_per_key(team_names(matches).withColumn("team_key", natural_key("team_name")), "team_key", "team_name")


def dim_team(
    matches: DataFrame, space: Workspace, current: DataFrame | None = None, created_at: Column | None = None
) -> DataFrame:
    return _merge_members(current, team_members(matches), DIM_TEAM, "team_id", "team_key", space, created_at)


def venue_members(matches: DataFrame) -> DataFrame:
    places = matches.select(
        padded_key("venue", "city").alias("venue_key"), F.col("venue").alias("venue_name"), "city", "ingest_date"
    )
    return _one_per_key(places, "venue_key", "venue_name", "city")


def dim_venue(matches: DataFrame, space: Workspace, current: DataFrame | None = None) -> DataFrame:
    return _merge_members(current, venue_members(matches), DIM_VENUE, "venue_id", "venue_key", space)


def player_members(players: DataFrame, teams: DataFrame) -> DataFrame:
    """Squad names per resolved team. Squads repeat in every match, so names are made distinct before the join."""
    named = players.where("player_name IS NOT NULL").select(
        "player_name", natural_key("country").alias("team_key"), "ingest_date"
    )
    spellings = named.groupBy("player_name", "team_key").agg(F.max("ingest_date").alias("ingest_date"))
    placed = spellings.join(teams.select("team_key", "team_id"), "team_key").select(
        F.concat(natural_key("player_name"), F.lit("|"), F.col("team_key")).alias("player_key"),
        F.col("player_name").alias("full_name"),
        "team_id",
        "ingest_date",
    )
    return _one_per_key(placed, "player_key", "full_name", "team_id")


def dim_player(
    players: DataFrame,
    teams: DataFrame,
    space: Workspace,
    current: DataFrame | None = None,
    created_at: Column | None = None,
) -> DataFrame:
    members = player_members(players, teams)
    return _merge_members(current, members, DIM_PLAYER, "player_id", "player_key", space, created_at)


def calendar(days: DataFrame, column: str = "event_date") -> DataFrame:
    """Calendar attributes of the distinct dates in a column."""
    d = F.col("full_date")
    return days.select(F.col(column).alias("full_date")).where("full_date IS NOT NULL").distinct().select(
        date_key(d).alias("date_key"),
        d,
        *[value.alias(name) for name, value in rules.date_parts(d).items()],
        F.weekofyear(d).alias("week"),
        F.quarter(d).alias("quarter"),
        F.date_format(d, "yyyy").alias("season"),
        (F.weekday(d) + F.lit(1)).alias("weekday"),
    )


def new_dates(matches: DataFrame, current: DataFrame) -> DataFrame:
    """Calendar rows for match dates the dimension lacks."""
    return insert_only(current, calendar(matches), ["full_date"])


def dim_date(matches: DataFrame, current: DataFrame | None = None) -> DataFrame:
    if current is None:
        return conform(calendar(matches), DIM_DATE)
    return current.unionByName(conform(new_dates(matches, current), DIM_DATE))


def one_per_match(matches: DataFrame, space: Workspace | None = None) -> DataFrame:
    """One staging row per match: latest load, then a fixed order of files. Matches with one row are not moved."""
    space = space or Workspace(matches.sparkSession)
    matches = matches.where("match_type_number IS NOT NULL")
    repeated = matches.groupBy("match_type_number").count().where(F.col("count") > 1).select("match_type_number")
    order = [
        F.col("stg_modified_ts").desc_nulls_last(),
        F.length("stg_file_name").asc_nulls_last(),
        F.col("stg_file_name").asc_nulls_last(),
        F.col("stg_file_hashkey").desc_nulls_last(),
    ]
    return keep_first_among(matches, space.freeze(repeated, "repeated"), ["match_type_number"], order)


def resolve_match(
    matches: DataFrame, teams: DataFrame, venues: DataFrame, strict_venue: bool = False
) -> DataFrame:
    """Team ids in four roles, venue id and date key for every match row."""
    resolved = lookup(
        matches,
        teams,
        "team_key",
        {
            "first_team_id": natural_key("first_team"),
            "second_team_id": natural_key("second_team"),
            "toss_winner_id": natural_key("toss_winner"),
            "winner_team_id": natural_key("winner"),
        },
        take="team_id",
    )
    resolved = lookup(resolved, venues, "venue_key", {"venue_id": venue_key("venue", "city", strict_venue)}, "venue_id")
    return resolved.withColumn("match_id", F.col("match_type_number")).withColumn("date_key", date_key("event_date"))


def dim_match(
    matches: DataFrame,
    teams: DataFrame,
    venues: DataFrame,
    current: DataFrame | None = None,
    strict_venue: bool = False,
    space: Workspace | None = None,
) -> DataFrame:
    source = conform(resolve_match(one_per_match(matches, space), teams, venues, strict_venue), DIM_MATCH)
    if current is None:
        return source
    attributes = [c for c in DIM_MATCH.columns if c not in DIM_MATCH.key]
    return upsert(current, source, DIM_MATCH.key, attributes, unique_source=True)


def match_dimension(space: Workspace, path: str, buckets: int = 8) -> BucketedTable:
    """The stored match dimension: it grows with the matches, so a batch rewrites touched buckets only."""
    return BucketedTable(space, path, DIM_MATCH, lambda n: F.pmod(F.xxhash64("match_id"), F.lit(n)).cast("int"), buckets)
