"""Scorecard documents, manifests and file states made from the test tables.

The rules are those of FIXTURES.md. Documents really are nested and serialised
to JSON here; the pipeline only ever sees that text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchmart.operators.numbering import number_within

# Fixed values of the fixture rules.
SQUAD_SIZE = 10
NAMES = 11
BALLS_PER_OVER = 3
OVERS_PER_DOCUMENT = 50
LANDING = "file:///landing/"
EARLY_RUN, LATE_RUN = "20240103_235959", "20240105_235959"
LOADED_AT = {EARLY_RUN: "2024-01-03 23:59:59", LATE_RUN: "2024-01-05 23:59:59"}
SPLIT_DATE = "1999-01-01"

#: matches with more balls than this are numbered and gathered in parts; at most one ball in so many starts such a match
LONG_MATCH = 10_000
#: lines are first counted in so many buckets of matches
COUNT_BUCKETS = 65_536
_PLACE = ["l_linenumber", "l_partkey"]
_REST = ["l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: who played where and when."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    home = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("team1"), F.col("r_name").alias("region")
    )
    away = nation.select(F.col("n_nationkey").alias("away_key"), F.col("n_name").alias("team2"))
    away_key = ((F.col("c_nationkey") + F.lit(1) + F.col("o_orderkey") % F.lit(24)) % F.lit(25)).cast("int")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(home, "c_nationkey")
        .withColumn("away_key", away_key)
        .join(away, "away_key")
        .select(
            F.col("o_orderkey").alias("m"), "o_custkey", "o_orderstatus", "o_orderpriority",
            F.to_date("o_orderdate").alias("day"), "team1", "team2", "region",
        )
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems of matches."""
    rows = table(spark, sf_dir, "lineitem").where("l_orderkey IS NOT NULL")
    return rows.select("l_orderkey", "l_linestatus", *_PLACE, *_REST)


def _long_matches(lines: DataFrame) -> DataFrame:
    """Matches (l_orderkey) of too many balls for one task: at most one row for every ``LONG_MATCH`` lineitems.

    Only matches in a bucket of that many lines can be long, so only their lines are counted by match.
    """
    bucket = F.pmod(F.hash("l_orderkey"), F.lit(COUNT_BUCKETS))
    full = lines.groupBy(bucket.alias("bucket")).count().where(F.col("count") > LONG_MATCH).select("bucket")
    candidates = lines.join(F.broadcast(full), bucket == F.col("bucket"), "left_semi")
    return candidates.groupBy("l_orderkey").count().where(F.col("count") > LONG_MATCH).select("l_orderkey")


def _numbered_whole(lines: DataFrame) -> DataFrame:
    """Lines with their number ``rn`` in their innings, where a match fits a task: all rows of a match are moved together.

    Lines without a place count, but are no balls.
    """
    innings = Window.partitionBy("l_orderkey", "l_linestatus").orderBy(*_PLACE, *_REST)
    return lines.withColumn("rn", F.row_number().over(innings)).dropna(subset=["l_linestatus", *_PLACE])


def _numbered_in_parts(lines: DataFrame) -> DataFrame:
    """The same numbers where a match may hold most of the lines."""
    return number_within(lines, ["l_orderkey", "l_linestatus"], _PLACE, _REST, "rn")


def balls_of(numbered: DataFrame, runs_added: int = 0) -> DataFrame:
    """One row per numbered lineitem with its place in the match and its delivery struct."""
    quantity = F.col("l_quantity").cast("int")
    batter, partner, bowler = (
        F.concat(F.lit("Player "), (x % F.lit(NAMES)).cast("string"))
        for x in (F.col("l_partkey"), F.col("l_partkey") + F.lit(1), F.col("l_suppkey"))
    )
    runs = quantity % F.lit(7) + F.lit(runs_added)
    extras = F.when(F.round(F.col("l_discount") * 100) == 0, F.lit(1)).otherwise(F.lit(0))

    def fielders(*names: Column) -> Column:
        return F.array(*[F.struct(n.alias("name")) for n in names])

    nobody = F.lit(None).cast("array<struct<name:string>>")
    kinds = {0: ("bowled", nobody), 1: ("caught", fielders(bowler)), 2: ("lbw", nobody),
             3: ("run out", fielders(bowler, partner))}
    turn = F.col("l_linenumber") % F.lit(4)
    kind = F.coalesce(*[F.when(turn == n, F.lit(k)) for n, (k, _) in kinds.items()])
    catchers = F.when(turn == 1, kinds[1][1]).when(turn == 3, kinds[3][1]).otherwise(nobody)
    first = F.struct(batter.alias("player_out"), kind.alias("kind"), catchers.alias("fielders"))
    second = F.struct(
        partner.alias("player_out"), F.lit("run out").alias("kind"), fielders(bowler, batter).alias("fielders")
    )
    wicket = (F.col("l_returnflag") == "R") & (F.col("l_quantity") < 10)
    wickets = F.when(wicket & (F.col("l_quantity") < 3), F.array(first, second)).when(wicket, F.array(first))
    over = F.call_function("div", F.col("rn") - F.lit(1), F.lit(BALLS_PER_OVER)).cast("int")
    return numbered.select(
        F.col("l_orderkey").alias("m"),
        F.when(F.col("l_linestatus") == "F", F.lit(1)).otherwise(F.lit(2)).alias("innings"),
        over.alias("over"),
        ((F.col("rn") - F.lit(1)) % F.lit(BALLS_PER_OVER) + F.lit(1)).alias("ball"),
        F.struct(
            bowler.alias("bowler"), batter.alias("batter"), partner.alias("non_striker"),
            F.struct(runs.alias("batter"), extras.alias("extras"), (runs + extras).alias("total")).alias("runs"),
            wickets.alias("wickets"),
        ).alias("delivery"),
    )


def _overs(place: Column, innings: int) -> Column:
    """The overs of one innings from the document's sorted balls."""
    mine = F.filter(place, lambda b: b["innings"] == F.lit(innings))
    numbers = F.array_distinct(F.transform(mine, lambda b: b["over"]))
    return F.transform(
        numbers,
        lambda o: F.struct(
            o.alias("over"),
            F.transform(F.filter(mine, lambda b: b["over"] == o), lambda b: b["delivery"]).alias("deliveries"),
        ),
    )


def documents(spark: SparkSession, sf_dir: str, only: DataFrame | None = None, runs_added: int = 0) -> DataFrame:
    """Raw JSON documents with their manifest record.

    A document holds at most ``OVERS_PER_DOCUMENT`` overs of each innings, so
    no group gathered here can grow with the data; a longer match comes in
    several documents, as ``<match>.json``, ``<match>-1.json`` and so on.
    ``only`` restricts to the matches of a frame with column ``m``.

    The lines of a match are moved once, and numbered, gathered and joined with
    the match where they then are; only a match of very many balls is taken apart.
    """
    lines, about = _lines(spark, sf_dir), matches(spark, sf_dir).where("m IS NOT NULL")
    long = F.broadcast(_long_matches(lines))
    long_m = F.broadcast(_long_matches(lines).withColumnRenamed("l_orderkey", "m"))
    short_lines = lines.join(long, "l_orderkey", "left_anti").repartition("l_orderkey")
    long_lines = lines.join(long, "l_orderkey", "left_semi")
    if only is not None:
        chosen = only.select(F.col("m").alias("l_orderkey"))
        short_lines, long_lines = (x.join(chosen, "l_orderkey", "left_semi") for x in (short_lines, long_lines))
        about = about.join(only, "m", "left_semi")
    short = _gathered(balls_of(_numbered_whole(short_lines), runs_added))
    parts = _gathered(balls_of(_numbered_in_parts(long_lines), runs_added))
    # a match without balls has one document; a long match has balls
    whole = about.join(long_m, "m", "left_anti").join(short, "m", "left")
    apart = parts.join(about.join(long_m, "m", "left_semi"), "m").select(*whole.columns)
    no_part, no_balls = F.coalesce("part", F.lit(0)), F.coalesce("balls", F.array().cast(short.schema["balls"].dataType))
    return _as_documents(whole.withColumns({"part": no_part, "balls": no_balls})).unionByName(_as_documents(apart))


def _gathered(played: DataFrame) -> DataFrame:
    """The balls of every document in their order."""
    part = F.call_function("div", F.col("over"), F.lit(OVERS_PER_DOCUMENT)).cast("int")
    placed = played.select("m", part.alias("part"), F.struct("innings", "over", "ball", "delivery").alias("ball"))
    return placed.groupBy("m", "part").agg(F.sort_array(F.collect_list("ball")).alias("balls"))


def _as_documents(gathered: DataFrame) -> DataFrame:
    """Documents as JSON text with their manifest record."""
    m, key = F.col("m"), F.col("m").cast("string")
    team1, team2 = F.col("team1"), F.col("team2")
    even = m % F.lit(2) == 0
    squad = F.array(*[F.lit(f"Player {i}") for i in range(SQUAD_SIZE)])
    info = F.struct(
        m.alias("match_type_number"),
        F.struct(
            F.concat(F.lit("Series "), F.col("o_orderpriority")).alias("name"),
            F.when(m % F.lit(7) != 0, m % F.lit(50)).alias("match_number"),
            F.when(m % F.lit(14) == 0, F.lit("Final")).alias("stage"),
        ).alias("event"),
        F.array(F.col("day").cast("string")).alias("dates"),
        F.lit("ODI").alias("match_type"),
        F.year("day").alias("season"),
        F.lit("international").alias("team_type"),
        F.lit(50).alias("overs"),
        F.when(m % F.lit(11) != 0, F.col("region")).alias("city"),
        F.concat(F.lit("Ground "), (F.col("o_custkey") % F.lit(20)).cast("string")).alias("venue"),
        F.when(even, F.lit("male")).otherwise(F.lit("female")).alias("gender"),
        F.array(team1, team2).alias("teams"),
        F.struct(
            F.when(F.col("o_orderstatus") == "F", F.when(even, team1).otherwise(team2)).alias("winner"),
            F.when(F.col("o_orderstatus") == "O", F.lit("tie"))
            .when(F.col("o_orderstatus") == "P", F.lit("no result")).alias("result"),
        ).alias("outcome"),
        F.struct(
            team2.alias("winner"),
            F.when(m % F.lit(13) != 0, F.when(m % F.lit(3) == 0, F.lit("bat")).otherwise(F.lit("field")))
            .alias("decision"),
        ).alias("toss"),
        F.create_map(team1, squad, team2, squad).alias("players"),
    )
    both = F.array(
        F.struct(team1.alias("team"), _overs(F.col("balls"), 1).alias("overs")),
        F.struct(team2.alias("team"), _overs(F.col("balls"), 2).alias("overs")),
    )
    innings = F.when(F.size("balls") > 0, both)
    stem = F.when(F.col("part") == 0, key).otherwise(F.concat(key, F.lit("-"), F.col("part").cast("string")))
    day = m % F.lit(5)
    return (
        gathered.withColumn("stem", stem)
        .select(
            F.concat(F.lit(LANDING), F.col("stem"), F.lit(".json")).alias("_source"),
            F.concat(F.col("stem"), F.lit(".json")).alias("stg_file_name"),
            F.sha2("stem", 256).alias("stg_file_hashkey"),
            F.concat(F.lit("2024-01-0"), (day + F.lit(1)).cast("string"), F.lit("T00:00:00Z")).alias("ingested_at"),
            F.to_json(F.struct(info.alias("info"), innings.alias("innings"))).alias("value"),
            F.when(day < 3, F.lit(EARLY_RUN)).otherwise(F.lit(LATE_RUN)).alias("run_id"),
        )
    )


def load_stamp() -> Column:
    """The load time of a row's run."""
    late = F.lit(LOADED_AT[LATE_RUN])
    return F.when(F.col("run_id") == EARLY_RUN, F.lit(LOADED_AT[EARLY_RUN])).otherwise(late).cast("timestamp")


def document_manifest(raw: DataFrame) -> DataFrame:
    """Manifest records of raw documents."""
    return raw.select(
        F.lit("file").alias("record_type"),
        F.regexp_replace("_source", r"^file:/+", "").alias("object_key"),
        F.col("_source").alias("uri"),
        "stg_file_name", "stg_file_hashkey", "ingested_at",
        F.octet_length("value").cast("bigint").alias("size_bytes"),
        F.lit("landing").alias("source_url"),
        F.lit("uploaded").alias("action"),
        F.to_date(F.substring("ingested_at", 1, 10)).alias("ingest_date"),
        "run_id",
    )


def event_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest records made from the events: many records per URI, one run per day."""
    e = table(spark, sf_dir, "events")
    name = F.concat(F.col("user_id").cast("string"), F.lit(".json"))
    return e.select(
        F.lit("file").alias("record_type"),
        F.concat(F.lit("landing/"), name).alias("object_key"),
        F.concat(F.lit(LANDING), name).alias("uri"),
        name.alias("stg_file_name"),
        F.sha2("props", 256).alias("stg_file_hashkey"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ingested_at"),
        F.floor("value").cast("bigint").alias("size_bytes"),
        F.lit("events").alias("source_url"),
        F.when(F.col("event_type") == "error", F.lit("skipped")).otherwise(F.lit("uploaded")).alias("action"),
        F.to_date("ts").alias("ingest_date"),
        F.date_format("ts", "yyyyMMdd").alias("run_id"),
        "event_id",
    )


def document_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a scan of all documents sees: key and checksum."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))


def landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state before the scan: some documents unseen, some with other content."""
    old = F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").where(F.col("doc_id") % 3 != 0).select(
        "doc_id", F.sha2(old, 256).alias("digest")
    )


def redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems as ball versions: key (order, line), version by ship date."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("version"), "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("int").alias("quantity"), "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
        "l_linestatus",
    )


RELOAD_ORDER = (
    "version", "l_partkey", "l_suppkey", "quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus",
)
