"""Report queries over the marts: trends, opponents, venues, dismissals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchmart.functions.ratios import average, percentage


def _sums():
    return [
        F.sum("runs_scored").alias("runs"),
        F.sum("balls_faced").alias("balls"),
        F.sum("times_out").alias("outs"),
    ]


_BATSMAN = ("player_id", "batsman_name", "team_name")


def _by_month(summary: DataFrame) -> DataFrame:
    month = F.date_format("event_date", "yyyy-MM")
    return summary.withColumn("month", month).groupBy(*_BATSMAN, "season", "month").agg(*_sums())


def _trend(by_month: DataFrame, grain: str) -> DataFrame:
    add = [F.sum(c).alias(c) for c in ("runs", "balls", "outs")]
    per = by_month.groupBy(*_BATSMAN, F.col(grain).alias("period")).agg(*add)
    so_far = Window.partitionBy("player_id").orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        per.withColumn("running_runs", F.sum("runs").over(so_far))
        .withColumn("running_balls", F.sum("balls").over(so_far))
        .withColumn("strike_rate", percentage(F.col("runs"), F.col("balls")))
        .withColumn("running_strike_rate", percentage(F.col("running_runs"), F.col("running_balls")))
        .withColumn("grain", F.lit(grain))
        .drop("outs")
    )


def runs_trend(summary: DataFrame, grain: str = "month") -> DataFrame:
    """Runs and strike rate per batsman and period, with running totals.

    ``grain`` is month or season. The running window sees one row per period,
    not per match.
    """
    return _trend(_by_month(summary), grain)


def runs_trend_all(summary: DataFrame) -> DataFrame:
    """Both grains, rolled up from one aggregate by season and month; its exchange is planned once."""
    by_month = _by_month(summary)
    return _trend(by_month, "month").unionByName(_trend(by_month, "season"))


def _with_ratios(frame: DataFrame) -> DataFrame:
    return frame.withColumn("batting_average", average(F.col("runs"), F.col("outs"))).withColumn(
        "strike_rate", percentage(F.col("runs"), F.col("balls"))
    )


def versus_opponents(summary: DataFrame) -> DataFrame:
    """Per batsman and opponent; ratios from sums, not averages of ratios."""
    rows = summary.groupBy("player_id", "batsman_name", "team_name", "opponent_team").agg(
        F.count("*").alias("matches"), *_sums()
    )
    return _with_ratios(rows)


def venue_best_worst(summary: DataFrame, matches: DataFrame, venues: DataFrame, keep: int = 3) -> DataFrame:
    """The ``keep`` best and worst venues of every batsman by strike rate, ties by venue key.

    Runs are summed per venue first; both places are numbered on that one frame,
    in one exchange by batsman.
    """
    places = matches.select("match_id", "venue_id").join(venues.select("venue_id", "venue_key"), "venue_id")
    rows = _with_ratios(
        summary.join(places, "match_id")
        .groupBy("player_id", "batsman_name", "team_name", "venue_key")
        .agg(F.count("*").alias("matches"), *_sums())
    )

    def place(order) -> Column:
        return F.row_number().over(Window.partitionBy("player_id").orderBy(order, F.col("venue_key").asc()))

    columns = rows.columns
    places = rows.withColumns({
        "best": place(F.col("strike_rate").desc_nulls_last()), "worst": place(F.col("strike_rate").asc_nulls_last()),
    })
    lists = F.array(*[F.struct(F.col(n).alias("place"), F.lit(n).alias("list")) for n in ("best", "worst")])
    return places.withColumn("lists", lists).select(*columns, F.inline("lists")).where(F.col("place") <= keep)


def dismissal_pattern(dismissals: DataFrame) -> DataFrame:
    """Count and percentage share of every dismissal kind per batsman."""
    all_kinds = Window.partitionBy("player_id")
    return dismissals.withColumn("total", F.sum("dismissals").over(all_kinds)).withColumn(
        "share", percentage(F.col("dismissals"), F.col("total"))
    )
