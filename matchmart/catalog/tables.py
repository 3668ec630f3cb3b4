"""Queries over the flattened tables and their column rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmart.catalog.lake import Lake
from matchmart.catalog.oracles import as_text, career, average, over_documents, percentage
from matchmart.catalog.registry import query
from matchmart.contracts import STG_DELIVERY, STG_MATCH, STG_PLAYER, conform
from matchmart.functions import keys, ratios
from matchmart.operators import flatten
from matchmart.plans import dims, fact, marts

_BALL = ("match_type_number", "innings_number", "over", "ball_in_over", "wicket_index")


@query(over_documents(as_text("SELECT * FROM stg_match", "event_date")))
def match_table(lake: Lake) -> DataFrame:
    return conform(flatten.match_table(lake.documents()), STG_MATCH)


@query(over_documents("SELECT * FROM stg_player"))
def player_table(lake: Lake) -> DataFrame:
    return conform(flatten.player_table(lake.documents()), STG_PLAYER)


@query(over_documents("SELECT * FROM stg_delivery"))
def delivery_table(lake: Lake) -> DataFrame:
    return conform(flatten.delivery_table(lake.documents()), STG_DELIVERY)


@query(over_documents("SELECT match_type_number, match_stage FROM stg_match"))
def match_stage(lake: Lake) -> DataFrame:
    return flatten.match_table(lake.documents()).select("match_type_number", "match_stage")


@query(over_documents("SELECT match_type_number, match_result, winner FROM stg_match"))
def match_result(lake: Lake) -> DataFrame:
    return flatten.match_table(lake.documents()).select("match_type_number", "match_result", "winner")


@query(over_documents(as_text(
    "SELECT match_type_number, event_date, event_year, event_month, event_day FROM stg_match", "event_date")))
def event_date_parts(lake: Lake) -> DataFrame:
    return flatten.match_table(lake.documents()).select(
        "match_type_number", "event_date", "event_year", "event_month", "event_day"
    )


@query("""
    SELECT c_custkey, lower(trim(' ' || upper(c_name) || '  ')) AS name_key,
           lower(trim(c_name)) || '|' || lower(trim(' ' || c_mktsegment)) AS segment_key
    FROM customer""")
def normalize_keys(lake: Lake) -> DataFrame:
    untidy = F.concat(F.lit(" "), F.upper("c_name"), F.lit("  "))
    return lake.table("customer").select(
        "c_custkey",
        keys.natural_key(untidy).alias("name_key"),
        keys.composite_key("c_name", F.concat(F.lit(" "), "c_mktsegment")).alias("segment_key"),
    )


@query(over_documents("""
    SELECT match_type_number,
           lower(trim(coalesce(venue, ''))) || '|' || lower(trim(coalesce(city, ''))) AS null_safe_key,
           lower(trim(venue)) || '|' || lower(trim(city)) AS strict_key
    FROM stg_match"""))
def venue_key_null_semantics(lake: Lake) -> DataFrame:
    return lake.staged("match").select(
        "match_type_number",
        keys.venue_key("venue", "city").alias("null_safe_key"),
        keys.venue_key("venue", "city", strict=True).alias("strict_key"),
    )


@query(over_documents(f"""
    SELECT {', '.join(_BALL)}, total - extras AS runs_off_bat, total - extras = 4 AS is_boundary_4,
           total - extras = 6 AS is_boundary_6, player_out IS NOT NULL AS is_wicket
    FROM stg_ball"""))
def ball_flags(lake: Lake) -> DataFrame:
    return fact.with_ball_flags(fact.keyed(lake.staged("delivery"))).select(
        *_BALL, "runs_off_bat", "is_boundary_4", "is_boundary_6", "is_wicket"
    )


@query(over_documents(f"""
    SELECT {', '.join(_BALL)}, player_out, player_out_kind, player_out_fielders
    FROM stg_delivery WHERE player_out IS NOT NULL"""))
def fielder_join(lake: Lake) -> DataFrame:
    return flatten.delivery_table(lake.documents()).where("player_out IS NOT NULL").select(
        *_BALL, "player_out", "player_out_kind", "player_out_fielders"
    )


@query(over_documents("SELECT * FROM stg_delivery WHERE match_type_number = 1134 AND innings_number = 2"))
def point_lookup(lake: Lake) -> DataFrame:
    """One innings of one match; both predicates reach the Parquet scan."""
    return lake.staged("delivery").where("match_type_number = 1134 AND innings_number = 2")


@query(over_documents(as_text("SELECT * FROM summary WHERE batsman_name LIKE '%player 1%'", "event_date")
                      + " ORDER BY match_id"))
def batsman_search(lake: Lake) -> DataFrame:
    return marts.search(lake.summary(), "player 1").orderBy("match_id")


@query(over_documents(f"SELECT * FROM ({career(extended=True)}) WHERE batsman_name LIKE '%player 1%'"))
def career_search(lake: Lake) -> DataFrame:
    mart = marts.batsman_career_ext(lake.fact(), lake.dim("player"), lake.dim("team"), lake.dim("match"))
    return marts.search(mart, "player 1")


@query(over_documents("SELECT * FROM dismissal WHERE batsman_name LIKE '%player 1%'"))
def dismissal_search(lake: Lake) -> DataFrame:
    return marts.search(marts.batsman_dismissal(lake.fact(), lake.dim("player")), "player 1")


@query(over_documents("""
    SELECT i.m AS match_type_number, CAST(i.innings AS INTEGER) AS innings_number, i.country,
           CAST(count(DISTINCT b.over_no) AS INTEGER) AS overs
    FROM fx_innings i LEFT JOIN fx_ball b USING (m, part, innings) GROUP BY i.m, i.part, i.innings, i.country
    UNION ALL
    SELECT d.m, NULL, NULL, 0 FROM fx_doc d ANTI JOIN fx_ball b ON b.m = d.m"""))
def innings_rows(lake: Lake) -> DataFrame:
    return flatten.innings_rows(lake.documents())


@query(over_documents("""
    SELECT match_type_number, innings_number, over, ball_in_over, count(*) AS wickets
    FROM stg_ball WHERE wicket_index IS NOT NULL GROUP BY 1, 2, 3, 4 HAVING count(*) > 1"""))
def multi_wicket_balls(lake: Lake) -> DataFrame:
    wickets = flatten.delivery_table(lake.documents()).where("wicket_index IS NOT NULL")
    return wickets.groupBy(*_BALL[:-1]).agg(F.count("*").alias("wickets")).where("wickets > 1")


@query(over_documents("""
    SELECT DISTINCT t AS team_name
    FROM (SELECT unnest([first_team, second_team, toss_winner, winner]) AS t FROM stg_match) WHERE t IS NOT NULL"""))
def team_union(lake: Lake) -> DataFrame:
    return dims.team_names(lake.staged("match")).select("team_name").distinct()


@query(f"""
    WITH sums AS (SELECT l_partkey, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS num,
                         count(*) FILTER (l_returnflag = 'R') AS den, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT l_partkey, num, den, {average('num', 'den')} AS average, {percentage('den', 'n')} AS share FROM sums""")
def safe_ratio(lake: Lake) -> DataFrame:
    sums = lake.table("lineitem").groupBy("l_partkey").agg(
        F.sum(F.col("l_quantity").cast("int")).alias("num"),
        F.count_if(F.col("l_returnflag") == "R").alias("den"),
        F.count("*").alias("n"),
    )
    return sums.select(
        "l_partkey", "num", "den",
        ratios.average(F.col("num"), F.col("den")).alias("average"),
        ratios.percentage(F.col("den"), F.col("n")).alias("share"),
    )
