"""Nested documents to match, player and ball tables.

Input frames carry ``info``, ``innings`` and the run-lineage columns, one row
per document. Everything here is projections and generators: no exchange, and
lineage travels with the row instead of being joined back on the match number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmart.contracts import RUN_LINEAGE
from matchmart.functions import scorecard as rules

_LINEAGE_SQL = ", ".join(f"doc.{c}" for c in RUN_LINEAGE)


def match_table(documents: DataFrame) -> DataFrame:
    """One row per document."""
    info = F.col("info")
    day = rules.first_match_date(info["dates"])
    event, outcome, toss = info["event"], info["outcome"], info["toss"]
    columns = {
        "match_type_number": info["match_type_number"],
        "event_name": event["name"],
        "match_stage": rules.match_stage(event["match_number"], event["stage"]),
        "event_date": day,
        **{f"event_{part}": value for part, value in rules.date_parts(day).items()},
        **{c: info[c] for c in ("match_type", "season", "team_type", "overs", "city", "venue", "gender")},
        "first_team": F.try_element_at(info["teams"], F.lit(1)),
        "second_team": F.try_element_at(info["teams"], F.lit(2)),
        "match_result": rules.match_result(outcome["winner"], outcome["result"]),
        "winner": rules.winner_name(outcome["winner"]),
        "toss_winner": toss["winner"],
        "toss_decision": rules.toss_decision(toss["decision"]),
    }
    return documents.select(*[value.alias(name) for name, value in columns.items()], *RUN_LINEAGE)


def player_table(documents: DataFrame) -> DataFrame:
    """One row per (document, team, squad name); teams without names keep one row."""
    return documents.sparkSession.sql(
        f"""
        SELECT doc.info.match_type_number AS match_type_number, country, player_name, {_LINEAGE_SQL}
        FROM {{documents}} AS doc
        LATERAL VIEW OUTER explode(doc.info.players) AS country, squad
        LATERAL VIEW OUTER explode(squad) AS player_name
        """,
        documents=documents,
    )


def innings_rows(documents: DataFrame) -> DataFrame:
    """One row per innings, numbered from 1; a document without innings keeps one row."""
    return documents.sparkSession.sql(
        """
        SELECT doc.info.match_type_number AS match_type_number,
               at + 1 AS innings_number,
               inn.team AS country,
               coalesce(size(inn.overs), 0) AS overs
        FROM {documents} AS doc LATERAL VIEW OUTER posexplode(doc.innings) AS at, inn
        """,
        documents=documents,
    )


def delivery_table(documents: DataFrame) -> DataFrame:
    """One row per ball, and one more for each further wicket on the same ball.

    Balls and wickets are numbered by position from 1. Documents without
    innings and innings without overs keep one row with NULL ball columns.
    """
    balls = documents.sparkSession.sql(
        f"""
        SELECT doc.info.match_type_number AS match_type_number,
               inn_at + 1 AS innings_number, inn.team AS country,
               ovr.over, ball_at + 1 AS ball_in_over,
               ball.bowler, ball.batter, ball.non_striker,
               ball.runs.batter AS runs, ball.runs.extras AS extras, ball.runs.total AS total,
               out.player_out, out.kind AS player_out_kind, out.fielders AS fielders,
               out_at + 1 AS wicket_index,
               {_LINEAGE_SQL}
        FROM {{documents}} AS doc
        LATERAL VIEW OUTER posexplode(doc.innings) AS inn_at, inn
        LATERAL VIEW OUTER explode(inn.overs) AS ovr
        LATERAL VIEW OUTER posexplode(ovr.deliveries) AS ball_at, ball
        LATERAL VIEW OUTER posexplode(ball.wickets) AS out_at, out
        """,
        documents=documents,
    )
    return balls.select(
        "match_type_number", "innings_number", "country", "over", "ball_in_over", "bowler", "batter", "non_striker",
        "runs", "extras", "total", "player_out", "player_out_kind",
        rules.fielder_names(F.col("fielders")).alias("player_out_fielders"),
        "wicket_index", *RUN_LINEAGE,
    )
