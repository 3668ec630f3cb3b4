"""Queries over lookups, upserts, dimensions and the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmart.catalog import fixtures
from matchmart.catalog.lake import Lake
from matchmart.catalog.oracles import as_text, over_documents
from matchmart.catalog.registry import query
from matchmart.contracts import FACT_DELIVERY, FACT_KEY
from matchmart.operators.latest import keep_first
from matchmart.operators.numbering import dense_ids
from matchmart.operators.upsert import upsert
from matchmart.plans import dims, fact


@query(over_documents("""
    SELECT d.match_type_number, d.carried_rows, s.documents, d.carried_rows * s.documents AS joined_rows
    FROM (SELECT match_type_number, count(*) AS carried_rows FROM stg_delivery GROUP BY 1) d
    JOIN (SELECT m AS match_type_number, count(*) + count(*) FILTER (m % 10 = 0) AS documents
          FROM lineage GROUP BY 1) s USING (match_type_number)"""))
def lineage_join_fanout(lake: Lake) -> DataFrame:
    """Rows a join of balls back to documents on the match number would give, when numbers repeat.

    Both sides are counted per match first, so the multiplied rows never exist.
    """
    once = lake.documents().select("_source", F.col("info.match_type_number").alias("match_type_number"))
    again = once.where("match_type_number % 10 = 0").withColumn("_source", F.concat("_source", F.lit("#2")))
    sources = once.unionByName(again).groupBy("match_type_number").agg(F.count("*").alias("documents"))
    carried = lake.staged("delivery").groupBy("match_type_number").agg(F.count("*").alias("carried_rows"))
    return carried.join(sources, "match_type_number").withColumn(
        "joined_rows", F.col("carried_rows") * F.col("documents")
    )


@query(over_documents("""
    SELECT d.match_id, d.first_team_id, d.second_team_id, d.toss_winner_id, d.winner_team_id, d.venue_id,
           v.venue_id AS strict_venue_id
    FROM dmatch d JOIN stg_match s ON s.match_type_number = d.match_id AND s.stg_file_name = d.stg_file_name
    LEFT JOIN venue v ON v.venue_key = lower(trim(s.venue)) || '|' || lower(trim(s.city))"""))
def role_playing_lookup(lake: Lake) -> DataFrame:
    matches = dims.one_per_match(lake.staged("match"), lake.space)
    safe = dims.resolve_match(matches, lake.dim("team"), lake.dim("venue"))
    strict = dims.resolve_match(
        safe.withColumnRenamed("venue_id", "__safe").drop(
            "first_team_id", "second_team_id", "toss_winner_id", "winner_team_id", "match_id", "date_key"
        ),
        lake.dim("team"), lake.dim("venue"), strict_venue=True,
    )
    return strict.select(
        "match_id", "first_team_id", "second_team_id", "toss_winner_id", "winner_team_id",
        F.col("__safe").alias("venue_id"), F.col("venue_id").alias("strict_venue_id"),
    )


@query(over_documents(as_text("SELECT * FROM calendar WHERE full_date >= DATE '1999-01-01'", "full_date")))
def new_dates_anti(lake: Lake) -> DataFrame:
    known = lake.dim("date").where(F.col("full_date") < F.lit(fixtures.SPLIT_DATE).cast("date"))
    return dims.new_dates(lake.staged("match"), known)


@query(over_documents(f"SELECT {', '.join(FACT_KEY)}, batting_team_id, bowling_team_id FROM fact"))
def opponent_resolution(lake: Lake) -> DataFrame:
    balls = fact.latest_per_ball(fact.keyed(lake.staged("delivery")), lake.space)
    sides = fact.with_sides(balls, lake.dim("match"), lake.dim("team"))
    return sides.withColumn("over_number", F.col("over")).select(*FACT_KEY, "batting_team_id", "bowling_team_id")


@query(over_documents(f"SELECT {', '.join(FACT_KEY)}, striker_id, non_striker_id, bowler_id FROM fact"))
def player_role_lookup(lake: Lake) -> DataFrame:
    balls = fact.latest_per_ball(fact.keyed(lake.staged("delivery")), lake.space)
    sides = fact.with_sides(balls, lake.dim("match"), lake.dim("team"))
    roles = fact.with_players(sides, lake.dim("player"))
    return roles.withColumn("over_number", F.col("over")).select(
        *FACT_KEY, "striker_id", "non_striker_id", "bowler_id"
    )


@query("""
    WITH target AS (SELECT o_orderkey AS k, o_orderstatus AS status, o_orderpriority AS priority, 'old' AS origin
                    FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
    source AS (SELECT o_orderkey AS k, CASE WHEN o_orderstatus <> 'P' THEN lower(o_orderstatus) END AS status,
                      'new ' || o_orderpriority AS priority
               FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')
    SELECT coalesce(t.k, s.k) AS k, CASE WHEN s.k IS NOT NULL THEN s.status ELSE t.status END AS status,
           coalesce(t.priority, s.priority) AS priority, t.origin
    FROM target t FULL JOIN source s ON t.k = s.k""")
def upsert_generic(lake: Lake) -> DataFrame:
    """Status is updated (NULLs included), priority only inserted, origin kept."""
    orders = lake.table("orders")
    day = F.to_date("o_orderdate")
    target = orders.where(day < F.lit("1999-01-01").cast("date")).select(
        F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"), F.lit("old").alias("origin"),
    )
    source = orders.where(day >= F.lit("1997-01-01").cast("date")).select(
        F.col("o_orderkey").alias("k"),
        F.when(F.col("o_orderstatus") != "P", F.lower("o_orderstatus")).alias("status"),
        F.concat(F.lit("new "), "o_orderpriority").alias("priority"),
    )
    return upsert(target, source, ["k"], update=["status"], insert=["k", "status", "priority"])


@query("SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_name) AS customer_id FROM customer")
def surrogate_keys(lake: Lake) -> DataFrame:
    return dense_ids(lake.table("customer").select("c_custkey", "c_name"), ["c_name"], "customer_id", lake.space)


@query(over_documents("SELECT team_id, team_key, team_name FROM team"))
def dim_team(lake: Lake) -> DataFrame:
    return dims.dim_team(lake.staged("match"), lake.space).drop("created_at", "named_at")


@query(over_documents("SELECT venue_id, venue_key, venue_name, city, CAST(NULL AS VARCHAR) AS country FROM venue"))
def dim_venue(lake: Lake) -> DataFrame:
    return dims.dim_venue(lake.staged("match"), lake.space).drop("named_at")


@query(over_documents("SELECT player_id, player_key, full_name, team_id FROM player"))
def dim_player(lake: Lake) -> DataFrame:
    return dims.dim_player(lake.staged("player"), lake.dim("team"), lake.space).drop("created_at", "named_at")


@query(over_documents(as_text("SELECT * FROM calendar", "full_date")))
def dim_date(lake: Lake) -> DataFrame:
    return dims.dim_date(lake.staged("match"))


@query(over_documents(as_text("SELECT * FROM dmatch", "event_date")))
def dim_match(lake: Lake) -> DataFrame:
    return dims.dim_match(lake.staged("match"), lake.dim("team"), lake.dim("venue"), space=lake.space).drop("stg_modified_ts")


@query(over_documents(f"SELECT {', '.join(FACT_DELIVERY.columns)} FROM fact"))
def fact_delivery(lake: Lake) -> DataFrame:
    lake.dim("match"), lake.staged("delivery")
    return lake.warehouse.build_fact()


_RELOAD = "l_orderkey, l_linenumber, version, l_partkey, l_suppkey, quantity, l_returnflag, l_linestatus"
_RELOAD_SQL = f"""
    SELECT {_RELOAD} FROM (
      SELECT *, row_number() OVER (
               PARTITION BY l_orderkey, l_linenumber
               ORDER BY version DESC, l_partkey DESC, l_suppkey DESC, quantity DESC, l_extendedprice DESC,
                        l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
      FROM (SELECT *, CAST(l_shipdate AS DATE) AS version, CAST(l_quantity AS INTEGER) AS quantity FROM lineitem))
    WHERE rn = 1"""


def _latest_versions(rows: DataFrame) -> DataFrame:
    order = [F.col(c).desc() for c in fixtures.RELOAD_ORDER]
    return keep_first(rows, ["l_orderkey", "l_linenumber"], order)


@query(as_text(_RELOAD_SQL, "version"))
def dedupe_deliveries(lake: Lake) -> DataFrame:
    rows = _latest_versions(fixtures.redelivered(lake.spark, lake.sf_dir))
    return rows.select(*_RELOAD.split(", "))


@query(as_text(_RELOAD_SQL, "version"))
def late_correction(lake: Lake) -> DataFrame:
    """An early load, then a later one that corrects some of its balls and adds others."""
    rows = fixtures.redelivered(lake.spark, lake.sf_dir)
    cut = F.lit(fixtures.SPLIT_DATE).cast("date")
    first = _latest_versions(rows.where(F.col("version") < cut))
    second = _latest_versions(rows.where(F.col("version") >= cut))
    key = ["l_orderkey", "l_linenumber"]
    rest = [c for c in rows.columns if c not in key]
    return upsert(first, second, key, rest, unique_source=True).select(*_RELOAD.split(", "))
