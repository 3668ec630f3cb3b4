"""Batsman marts.

The fact is aggregated on its narrow id columns first and the dimensions are
joined to the much smaller result; an id determines every attribute, so this
equals grouping the joined rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmart.contracts import FACT_KEY, MART_SUMMARY_SUMS
from matchmart.functions.keys import OVERS_PER_BUCKET, natural_key
from matchmart.functions.ratios import average, percentage
from matchmart.sources.sinks import BucketedTable
from matchmart.workspace import Workspace


def _totals(runs: str = "runs_off_bat"):
    return [
        F.sum(F.col(runs).cast("long")).alias("runs"),
        F.sum(F.col("extras").cast("long")).alias("extras"),
        F.count_if("is_boundary_4").alias("fours"),
        F.count_if("is_boundary_6").alias("sixes"),
        F.count("*").alias("balls"),
        F.count_if("is_wicket").alias("outs"),
    ]


def _batting(fact: DataFrame) -> DataFrame:
    return fact.where("striker_id IS NOT NULL").withColumnRenamed("striker_id", "player_id")


def _named(players: DataFrame) -> DataFrame:
    return players.select("player_id", F.lower("full_name").alias("batsman_name"), "team_id")


def _ratios(frame: DataFrame, runs: str, outs: str, balls: str) -> DataFrame:
    return frame.withColumn("batting_average", average(F.col(runs), F.col(outs))).withColumn(
        "strike_rate", percentage(F.col(runs), F.col(balls))
    )


def by_match(fact: DataFrame, sums: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``sums`` of the balls, by keys that hold the match.

    The balls of a match are moved once, to one place; what is grouped or joined
    by match afterwards needs no further exchange. Matches of so many overs that
    they may not fit a task are summed apart, combined before they are moved.
    """
    long = fact.where(F.col("over_number") >= OVERS_PER_BUCKET).select("match_id").distinct()
    if long.isEmpty():
        return sums(fact.repartition("match_id"))
    long = Workspace(fact.sparkSession).freeze(long, "long")
    short = fact.join(long, "match_id", "left_anti").select(*fact.columns)
    return sums(short.repartition("match_id")).unionByName(sums(fact.join(long, "match_id", "left_semi")))


def summary_sums(fact: DataFrame) -> DataFrame:
    """The numbers of the summary by id: one row per batsman, match and opponent."""
    sums = by_match(_batting(fact), lambda balls: balls.groupBy("player_id", "match_id", "bowling_team_id").agg(*_totals()))
    return sums.withColumnsRenamed({"runs": "runs_scored", "balls": "balls_faced", "outs": "times_out"})


def named_summary(sums: DataFrame, players: DataFrame, teams: DataFrame, matches: DataFrame) -> DataFrame:
    """The summary with today's names and ratios."""
    own = teams.select("team_id", "team_name")
    opponents = teams.select(F.col("team_id").alias("bowling_team_id"), F.col("team_name").alias("opponent_team"))
    about = matches.select("match_id", "event_name", "match_type", "event_date", "season")
    # matches are many, so sums meet them before they carry the names of the small dimensions
    rows = (
        sums.join(about, "match_id").join(_named(players), "player_id").join(own, "team_id")
        .join(opponents, "bowling_team_id")
    )
    return _ratios(rows, "runs_scored", "times_out", "balls_faced").select(
        "player_id", "batsman_name", "team_name", "opponent_team", "match_id", "event_name", "match_type",
        "event_date", "season", "runs_scored", "extras", "fours", "sixes", "balls_faced", "times_out",
        "batting_average", "strike_rate",
    )


def batsman_summary(
    fact: DataFrame, players: DataFrame, teams: DataFrame, matches: DataFrame
) -> DataFrame:
    """One row per batsman, match and opponent."""
    return named_summary(summary_sums(fact), players, teams, matches)


def _career_sums(fact: DataFrame, matches: DataFrame) -> DataFrame:
    """Totals per batsman with exact match and innings counts.

    Counted in steps (innings, match, batsman), each a partially combined hash
    aggregate, so no task holds a set of distinct values.
    """
    add = [F.sum(c).alias(c) for c in ("runs", "fours", "sixes", "balls", "outs")]

    def per_match(balls: DataFrame) -> DataFrame:
        per_innings = balls.groupBy("player_id", "match_id", "innings_number").agg(*_totals())
        counted = per_innings.groupBy("player_id", "match_id").agg(*add, F.count("*").alias("innings"))
        return counted.join(matches.select("match_id"), "match_id", "left_semi")

    return by_match(_batting(fact), per_match).groupBy("player_id").agg(
        *add, F.sum("innings").alias("innings"), F.count("*").alias("matches")
    )


def named_career(sums: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Totals per batsman under today's names, with ratios."""
    rows = (
        sums.join(_named(players), "player_id").join(teams.select("team_id", "team_name"), "team_id")
        .withColumnsRenamed({
            "runs": "total_runs", "fours": "total_fours", "sixes": "total_sixes", "outs": "times_out",
            "balls": "total_balls",
        })
    )
    return _ratios(rows, "total_runs", "times_out", "total_balls").select(
        "player_id", "batsman_name", "team_name", "matches", "innings", "total_runs", "total_balls", "total_fours",
        "total_sixes", "times_out", "batting_average", "strike_rate",
    )


def batsman_career_ext(fact: DataFrame, players: DataFrame, teams: DataFrame, matches: DataFrame) -> DataFrame:
    """Career totals with innings batted and balls faced."""
    return named_career(_career_sums(fact, matches), players, teams)


def batsman_career(fact: DataFrame, players: DataFrame, teams: DataFrame, matches: DataFrame) -> DataFrame:
    """Career totals per batsman."""
    return batsman_career_ext(fact, players, teams, matches).drop("innings", "total_balls")


def batsman_dismissal(fact: DataFrame, players: DataFrame) -> DataFrame:
    """Wickets per batsman (as striker) and kind."""
    counts = _batting(fact).where("is_wicket").groupBy("player_id", "wicket_kind").agg(
        F.count("*").alias("dismissals")
    )
    return named_dismissals(counts, players)


def named_dismissals(counts: DataFrame, players: DataFrame) -> DataFrame:
    return counts.join(_named(players), "player_id").select("player_id", "batsman_name", "wicket_kind", "dismissals")


def own_dismissals(deliveries: DataFrame, fact: DataFrame, players: DataFrame) -> DataFrame:
    """Per match and dismissed player: number of dismissals and the kind of the first.

    Taken from the wicket rows of the ball versions the fact holds, second
    wickets of a ball included, so a run-out non-striker is charged and the
    striker is not.
    """
    wickets = deliveries.where("player_out IS NOT NULL").alias("w")
    kept = fact.where("is_wicket").select(*FACT_KEY, "stg_file_hashkey", "stg_modified_ts").alias("k")
    w, k = (lambda c: F.col(f"w.{c}")), (lambda c: F.col(f"k.{c}"))
    same_version = (
        (w("match_type_number") == k("match_id"))
        & (w("innings_number") == k("innings_number"))
        & (w("over") == k("over_number"))
        & (w("ball_in_over") == k("ball_in_over"))
        & w("stg_file_hashkey").eqNullSafe(k("stg_file_hashkey"))
        & w("stg_modified_ts").eqNullSafe(k("stg_modified_ts"))
    )
    charged = wickets.join(kept, same_version, "left_semi").select(
        F.col("match_type_number").alias("match_id"),
        F.concat(natural_key("player_out"), F.lit("|"), natural_key("country")).alias("player_key"),
        F.struct("innings_number", "over", "ball_in_over", "wicket_index").alias("at"),
        "player_out_kind",
    )
    return (
        charged.join(players.select("player_key", "player_id"), "player_key")
        .groupBy("player_id", "match_id")
        .agg(F.count("*").alias("own_dismissals"), F.min_by("player_out_kind", "at").alias("dismissal_kind"))
    )


def batsman_summary_ext(summary: DataFrame, dismissals: DataFrame, matches: DataFrame, venues: DataFrame) -> DataFrame:
    """Summary rows with the venue and the batsman's own dismissals.

    Both are joined by match: a match has one row with the dismissals of its few
    players, so summary rows that lie by match are not moved again.
    """
    places = matches.select("match_id", "venue_id").join(
        venues.select("venue_id", "venue_name", F.col("city").alias("venue_city")), "venue_id", "left"
    )
    rest = [c for c in dismissals.columns if c != "match_id"]
    of_match = dismissals.groupBy("match_id").agg(F.collect_list(F.struct(*rest)).alias("__out"))
    mine = F.get(F.filter("__out", lambda o: o["player_id"] == F.col("player_id")), F.lit(0))
    joined = summary.join(places, "match_id", "left").join(of_match, "match_id", "left").withColumn("__out", mine)
    return joined.select(
        "player_id", "match_id", *[c for c in summary.columns if c not in ("player_id", "match_id")],
        *[c for c in places.columns if c != "match_id"],
        F.coalesce("__out.own_dismissals", F.lit(0).cast("long")).alias("own_dismissals"), "__out.dismissal_kind",
    )


def search(mart: DataFrame, text: str) -> DataFrame:
    """Mart rows whose batsman name contains the text (names are stored lower-case)."""
    return mart.where(F.col("batsman_name").contains(text.lower()))


def refresh_summary(
    mart: DataFrame,
    touched: DataFrame,
    fact: DataFrame,
    players: DataFrame,
    teams: DataFrame,
    matches: DataFrame,
) -> DataFrame:
    """The summary after the ``touched`` matches changed: only their rows are recomputed."""
    ids = touched.select("match_id").distinct()
    recomputed = batsman_summary(fact.join(ids, "match_id", "left_semi"), players, teams, matches)
    return mart.join(ids, "match_id", "left_anti").select(*mart.columns).unionByName(recomputed)


def career_from_summary(summary: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Career totals re-aggregated from the per-match mart, by id: a batsman of several spellings is one."""
    add = {
        "total_runs": "runs_scored", "total_fours": "fours", "total_sixes": "sixes", "times_out": "times_out",
        "total_balls": "balls_faced",
    }
    per_match = summary.groupBy("player_id", "match_id").agg(*[F.sum(c).alias(a) for a, c in add.items()])
    sums = per_match.groupBy("player_id").agg(F.count("*").alias("matches"), *[F.sum(a).alias(a) for a in add])
    rows = sums.join(_named(players), "player_id").join(teams.select("team_id", "team_name"), "team_id")
    return _ratios(rows, "total_runs", "times_out", "total_balls").select(
        "player_id", "batsman_name", "team_name", "matches", "total_runs", "total_fours", "total_sixes", "times_out",
        "batting_average", "strike_rate",
    )


def summary_table(space: Workspace, path: str, buckets: int = 16) -> BucketedTable:
    """The stored summary, in buckets of matches."""
    return BucketedTable(
        space, path, MART_SUMMARY_SUMS, lambda n: F.pmod(F.xxhash64("match_id"), F.lit(n)).cast("int"), buckets
    )
