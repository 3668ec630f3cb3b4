"""SQL over the flat test tables, computing what the pipeline should give.

``PRELUDE`` defines the relations; a query's SQL is the prelude plus one
SELECT. Nothing here is nested: numbering, lookups and marts are computed
straight from the tables, so flattening is tested against an independent path.
"""

from __future__ import annotations


def half_up(numerator: str, denominator: str, scale: int) -> str:
    return (
        f"CAST(({2 * scale} * ({numerator}) + ({denominator})) // (2 * nullif({denominator}, 0)) AS DOUBLE) / 100"
    )


def average(numerator: str, denominator: str) -> str:
    return half_up(numerator, denominator, 100)


def percentage(numerator: str, denominator: str) -> str:
    return half_up(numerator, denominator, 10_000)


_RELATIONS = {
    "fx_match": """
        SELECT o.o_orderkey AS m, o.o_custkey, o.o_orderstatus, o.o_orderpriority,
               CAST(o.o_orderdate AS DATE) AS d, h.n_name AS team1, a.n_name AS team2, r.r_name AS region
        FROM orders o
        JOIN customer c ON c.c_custkey = o.o_custkey
        JOIN nation h ON h.n_nationkey = c.c_nationkey
        JOIN region r ON r.r_regionkey = h.n_regionkey
        JOIN nation a ON a.n_nationkey = (c.c_nationkey + 1 + o.o_orderkey % 24) % 25""",
    "fx_ranked": """
        SELECT *, row_number() OVER (
                 PARTITION BY l_orderkey, l_linestatus
                 ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount,
                          l_tax, l_returnflag) AS rn
        FROM lineitem""",
    "fx_ball": """
        SELECT l_orderkey AS m, CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END AS innings,
               CAST((rn - 1) // 3 AS INTEGER) AS over_no, CAST((rn - 1) % 3 + 1 AS INTEGER) AS ball,
               (rn - 1) // 150 AS part,
               'Player ' || (l_partkey % 11) AS batter, 'Player ' || ((l_partkey + 1) % 11) AS partner,
               'Player ' || (l_suppkey % 11) AS bowler,
               CAST(CAST(l_quantity AS INTEGER) % 7 AS INTEGER) AS runs,
               CASE WHEN round(l_discount * 100) = 0 THEN 1 ELSE 0 END AS extras,
               CASE WHEN l_returnflag <> 'R' OR l_quantity >= 10 THEN 0 WHEN l_quantity < 3 THEN 2 ELSE 1 END AS outs,
               l_linenumber % 4 AS turn
        FROM fx_ranked""",
    "fx_doc": """
        SELECT m, part, CASE WHEN part = 0 THEN CAST(m AS VARCHAR) ELSE m || '-' || part END AS stem,
               '2024-01-0' || (m % 5 + 1) AS ingest_date,
               CASE WHEN m % 5 < 3 THEN '20240103_235959' ELSE '20240105_235959' END AS run_id,
               CASE WHEN m % 5 < 3 THEN '2024-01-03 23:59:59' ELSE '2024-01-05 23:59:59' END AS loaded
        FROM (SELECT o_orderkey AS m, 0 AS part FROM orders UNION SELECT m, part FROM fx_ball)""",
    "lineage": """
        SELECT m, part, stem || '.json' AS stg_file_name, 1 AS stg_file_row_number, sha256(stem) AS stg_file_hashkey,
               loaded AS stg_modified_ts, ingest_date, run_id
        FROM fx_doc""",
    "stg_match": """
        SELECT x.m AS match_type_number, 'Series ' || x.o_orderpriority AS event_name,
               CASE WHEN x.m % 7 <> 0 THEN CAST(x.m % 50 AS VARCHAR) WHEN x.m % 14 = 0 THEN 'Final' ELSE 'NA' END
                 AS match_stage,
               x.d AS event_date,
               CAST(year(x.d) AS INTEGER) AS event_year, CAST(month(x.d) AS INTEGER) AS event_month,
               CAST(day(x.d) AS INTEGER) AS event_day,
               'ODI' AS match_type, CAST(year(x.d) AS VARCHAR) AS season, 'international' AS team_type, 50 AS overs,
               CASE WHEN x.m % 11 <> 0 THEN x.region END AS city, 'Ground ' || (x.o_custkey % 20) AS venue,
               CASE WHEN x.m % 2 = 0 THEN 'male' ELSE 'female' END AS gender,
               x.team1 AS first_team, x.team2 AS second_team,
               CASE x.o_orderstatus WHEN 'F' THEN 'Result Declared' WHEN 'O' THEN 'Tie' ELSE 'No Result' END
                 AS match_result,
               CASE WHEN x.o_orderstatus <> 'F' THEN 'NA' WHEN x.m % 2 = 0 THEN x.team1 ELSE x.team2 END AS winner,
               x.team2 AS toss_winner,
               CASE WHEN x.m % 13 = 0 THEN NULL WHEN x.m % 3 = 0 THEN 'Bat' ELSE 'Field' END AS toss_decision,
               l.* EXCLUDE (m, part)
        FROM fx_match x JOIN lineage l USING (m)""",
    "stg_player": """
        SELECT s.match_type_number, t.country, 'Player ' || p.n AS player_name,
               s.stg_file_name, s.stg_file_row_number, s.stg_file_hashkey, s.stg_modified_ts, s.ingest_date, s.run_id
        FROM stg_match s
        JOIN LATERAL (SELECT unnest([s.first_team, s.second_team]) AS country) t ON true
        JOIN (SELECT unnest(range(10)) AS n) p ON true""",
    "fx_innings": """
        SELECT x.m, d.part, i.innings, CASE i.innings WHEN 1 THEN x.team1 ELSE x.team2 END AS country
        FROM (SELECT DISTINCT m, part FROM fx_ball) d
        JOIN fx_match x USING (m)
        JOIN (SELECT unnest([1, 2]) AS innings) i ON true""",
    "fx_rows": """
        SELECT i.m, i.part, i.innings, i.country, b.over_no, b.ball, b.bowler, b.batter, b.partner, b.runs, b.extras,
               CASE WHEN w.nth = 1 THEN b.batter WHEN w.nth = 2 THEN b.partner END AS player_out,
               CASE WHEN w.nth = 2 THEN 'run out'
                    WHEN w.nth = 1 THEN CASE b.turn WHEN 0 THEN 'bowled' WHEN 1 THEN 'caught' WHEN 2 THEN 'lbw'
                                                   ELSE 'run out' END END AS kind,
               CASE WHEN w.nth = 2 THEN b.bowler || ', ' || b.batter
                    WHEN w.nth = 1 AND b.turn = 1 THEN b.bowler
                    WHEN w.nth = 1 AND b.turn = 3 THEN b.bowler || ', ' || b.partner END AS fielders,
               w.nth AS wicket_index
        FROM fx_innings i
        LEFT JOIN fx_ball b USING (m, part, innings)
        LEFT JOIN (VALUES (1, 1), (2, 1), (2, 2)) w(outs, nth) ON w.outs = b.outs
        UNION ALL
        SELECT d.m, d.part, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
        FROM fx_doc d ANTI JOIN fx_ball b ON b.m = d.m""",
    "stg_delivery": """
        SELECT r.m AS match_type_number, CAST(r.innings AS INTEGER) AS innings_number, r.country, r.over_no AS over,
               r.ball AS ball_in_over, r.bowler, r.batter, r.partner AS non_striker, CAST(r.runs AS INTEGER) AS runs,
               CAST(r.extras AS INTEGER) AS extras, CAST(r.runs + r.extras AS INTEGER) AS total,
               r.player_out, r.kind AS player_out_kind, r.fielders AS player_out_fielders,
               CAST(r.wicket_index AS INTEGER) AS wicket_index, l.* EXCLUDE (m, part)
        FROM fx_rows r JOIN lineage l USING (m, part)""",
    "stg_ball": """
        SELECT * FROM stg_delivery
        WHERE innings_number IS NOT NULL AND over IS NOT NULL AND ball_in_over IS NOT NULL""",
    "team": """
        SELECT row_number() OVER (ORDER BY team_key) AS team_id, team_key, team_name
        FROM (SELECT lower(trim(t)) AS team_key, min(t) AS team_name
              FROM (SELECT unnest([first_team, second_team, toss_winner, winner]) AS t FROM stg_match)
              WHERE t IS NOT NULL GROUP BY 1)""",
    "venue": """
        SELECT row_number() OVER (ORDER BY venue_key) AS venue_id, venue_key, venue_name, city
        FROM (SELECT DISTINCT lower(trim(coalesce(venue, ''))) || '|' || lower(trim(coalesce(city, ''))) AS venue_key,
                     venue AS venue_name, city
              FROM stg_match)""",
    "player": """
        SELECT row_number() OVER (ORDER BY player_key) AS player_id, player_key, full_name, team_id
        FROM (SELECT DISTINCT lower(trim(p.player_name)) || '|' || t.team_key AS player_key,
                     p.player_name AS full_name, t.team_id
              FROM stg_player p JOIN team t ON t.team_key = lower(trim(p.country)))""",
    "calendar": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
               CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
               CAST(week(d) AS INTEGER) AS week, CAST(quarter(d) AS INTEGER) AS quarter,
               strftime(d, '%Y') AS season, CAST(isodow(d) AS INTEGER) AS weekday
        FROM (SELECT DISTINCT event_date AS d FROM stg_match)""",
    "dmatch": """
        SELECT s.match_type_number AS match_id, s.event_name, s.match_type, s.match_stage,
               CAST(strftime(s.event_date, '%Y%m%d') AS INTEGER) AS date_key, s.event_date, s.season, s.team_type,
               s.overs, v.venue_id, s.gender, t1.team_id AS first_team_id, t2.team_id AS second_team_id,
               s.match_result, tw.team_id AS winner_team_id, tt.team_id AS toss_winner_id, s.toss_decision,
               s.stg_file_name, s.stg_file_hashkey, s.ingest_date
        FROM stg_match s
        LEFT JOIN team t1 ON t1.team_key = lower(trim(s.first_team))
        LEFT JOIN team t2 ON t2.team_key = lower(trim(s.second_team))
        LEFT JOIN team tw ON tw.team_key = lower(trim(s.winner))
        LEFT JOIN team tt ON tt.team_key = lower(trim(s.toss_winner))
        LEFT JOIN venue v ON v.venue_key =
          lower(trim(coalesce(s.venue, ''))) || '|' || lower(trim(coalesce(s.city, '')))
        WHERE s.stg_file_name = s.match_type_number || '.json'""",
    "fact": """
        SELECT d.match_type_number AS match_id, d.innings_number, d.over AS over_number, d.ball_in_over,
               ps.player_id AS striker_id, pn.player_id AS non_striker_id, pb.player_id AS bowler_id,
               t.team_id AS batting_team_id, o.team_id AS bowling_team_id,
               d.total - d.extras AS runs_off_bat, d.extras, d.total AS total_runs,
               d.total - d.extras = 4 AS is_boundary_4, d.total - d.extras = 6 AS is_boundary_6,
               d.player_out IS NOT NULL AS is_wicket, d.player_out_kind AS wicket_kind,
               d.player_out_fielders AS fielder_names, d.stg_file_hashkey, d.ingest_date, d.stg_modified_ts
        FROM stg_ball d
        JOIN dmatch m ON m.match_id = d.match_type_number
        JOIN team t ON t.team_key = lower(trim(d.country))
        JOIN team o ON o.team_id =
          CASE WHEN t.team_id = m.first_team_id THEN m.second_team_id ELSE m.first_team_id END
        LEFT JOIN player ps ON ps.player_key = lower(trim(d.batter)) || '|' || t.team_key
        LEFT JOIN player pn ON pn.player_key = lower(trim(d.non_striker)) || '|' || t.team_key
        LEFT JOIN player pb ON pb.player_key = lower(trim(d.bowler)) || '|' || o.team_key
        WHERE coalesce(d.wicket_index, 1) = 1""",
    "corrected": """
        SELECT f.* REPLACE (
                 f.runs_off_bat + x.late AS runs_off_bat, f.total_runs + x.late AS total_runs,
                 f.runs_off_bat + x.late = 4 AS is_boundary_4, f.runs_off_bat + x.late = 6 AS is_boundary_6)
        FROM fact f
        JOIN (SELECT m, CASE WHEN d < DATE '1999-01-01' AND m % 10 = 0 THEN 1 ELSE 0 END AS late FROM fx_match) x
          ON x.m = f.match_id""",
    "summary": None,
    "corrected_summary": None,
    "dismissal": """
        SELECT p.player_id, lower(p.full_name) AS batsman_name, f.wicket_kind, count(*) AS dismissals
        FROM fact f JOIN player p ON p.player_id = f.striker_id WHERE f.is_wicket GROUP BY ALL""",
}


def summary(fact: str) -> str:
    return f"""
        SELECT *, {average('runs_scored', 'times_out')} AS batting_average,
               {percentage('runs_scored', 'balls_faced')} AS strike_rate
        FROM (SELECT p.player_id, lower(p.full_name) AS batsman_name, t.team_name, o.team_name AS opponent_team,
                     m.match_id, m.event_name, m.match_type, m.event_date, m.season,
                     CAST(sum(f.runs_off_bat) AS BIGINT) AS runs_scored, CAST(sum(f.extras) AS BIGINT) AS extras,
                     count(*) FILTER (f.is_boundary_4) AS fours, count(*) FILTER (f.is_boundary_6) AS sixes,
                     count(*) AS balls_faced, count(*) FILTER (f.is_wicket) AS times_out
              FROM {fact} f
              JOIN player p ON p.player_id = f.striker_id
              JOIN team t ON t.team_id = p.team_id
              JOIN dmatch m ON m.match_id = f.match_id
              JOIN team o ON o.team_id = f.bowling_team_id
              GROUP BY ALL)"""


_RELATIONS["summary"] = summary("fact")
_RELATIONS["corrected_summary"] = summary("corrected")


def career(fact: str = "fact", extended: bool = False) -> str:
    more = "count(DISTINCT (f.match_id, f.innings_number)) AS innings," if extended else ""
    balls = "count(*) AS total_balls," if extended else ""
    return f"""
        SELECT player_id, batsman_name, team_name, matches, total_runs, total_fours, total_sixes, times_out,
               {'innings, total_balls,' if extended else ''}
               {average('total_runs', 'times_out')} AS batting_average,
               {percentage('total_runs', 'n')} AS strike_rate
        FROM (SELECT p.player_id, lower(p.full_name) AS batsman_name, t.team_name,
                     count(DISTINCT f.match_id) AS matches, {more} {balls} count(*) AS n,
                     CAST(sum(f.runs_off_bat) AS BIGINT) AS total_runs,
                     count(*) FILTER (f.is_boundary_4) AS total_fours,
                     count(*) FILTER (f.is_boundary_6) AS total_sixes, count(*) FILTER (f.is_wicket) AS times_out
              FROM {fact} f
              JOIN player p ON p.player_id = f.striker_id
              JOIN team t ON t.team_id = p.team_id
              GROUP BY ALL)"""


def as_text(select: str, *dates: str) -> str:
    """The SELECT with its date columns as ISO text."""
    return f"SELECT * REPLACE ({', '.join(f'CAST({d} AS VARCHAR) AS {d}' for d in dates)}) FROM ({select})"


def over_documents(select: str) -> str:
    """A SELECT over the scorecard relations."""
    relations = ",\n".join(f"{name} AS ({body})" for name, body in _RELATIONS.items())
    return f"WITH {relations}\n{select}"


EVENT_MANIFEST = """
    SELECT 'file' AS record_type, 'landing/' || user_id || '.json' AS object_key,
           'file:///landing/' || user_id || '.json' AS uri, user_id || '.json' AS stg_file_name,
           sha256(props) AS stg_file_hashkey, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ingested_at,
           CAST(floor(value) AS BIGINT) AS size_bytes, 'events' AS source_url,
           CASE event_type WHEN 'error' THEN 'skipped' ELSE 'uploaded' END AS action,
           CAST(CAST(ts AS DATE) AS VARCHAR) AS ingest_date, strftime(ts, '%Y%m%d') AS run_id
    FROM events"""


def over_manifest(select: str) -> str:
    """A SELECT over the event manifest."""
    return f"WITH manifest AS ({EVENT_MANIFEST})\n{select}"
