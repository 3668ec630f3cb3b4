"""Rows that need no company stay where they are; the others are moved once."""

import re

from pyspark.sql import functions as F

from matchmart.catalog import fixtures
from matchmart.catalog.analysis import _Site
from matchmart.catalog.lake import Lake
from matchmart.contracts import MATCH_NUMBERS, STG_MATCH, conform
from matchmart.operators.latest import keep_first, keep_first_among
from matchmart.plans import marts
from matchmart.plans.fact import BALL_KEY, contested_matches, latest_per_ball
from matchmart.plans.mart_store import partial_sums, summary_of
from matchmart.sources.sinks import BucketedTable, write_history


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def tables(spark, folder, long=40):
    """Match 7 has most lines, match 3 none; keys repeat and some are null."""
    places = [(7, s, n, n % 4) for s in "FO" for n in range(long)] + [(1, "F", 1, 1), (1, "F", 1, 1), (2, "O", 1, 5), (None, "F", 1, 1), (9, "F", 1, 1), (2, None, 1, 1), (1, "F", None, 1), (7, "O", 3, None)]
    lines = [(m, s, n, p, 4, "1998-01-0%d" % ((n or 0) % 9 + 1), float((n or 0) % 9 + 1), 10.0 + (n or 0), 0.0, 0.02, "R") for m, s, n, p in places]
    spark.createDataFrame(lines, "l_orderkey long, l_linestatus string, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate string, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string").write.parquet(f"{folder}/lineitem.parquet")
    orders = [(m, 1, "F", "1-URGENT", "1998-05-01") for m in (1, 2, 3, 7, 2, None)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(1, 0)], "c_custkey long, c_nationkey int").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(i, f"NATION_{i}", 0) for i in range(25)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(0, "AREA")], "r_regionkey int, r_name string").write.parquet(f"{folder}/region.parquet")
    return str(folder)


def test_long_matches_give_the_same_documents(spark, tmp_path, monkeypatch):
    made = {}
    folder = tables(spark, tmp_path, long=400)
    for limit in (10_000, 10, 0):
        monkeypatch.setattr(fixtures, "LONG_MATCH", limit)
        made[limit] = sorted(map(tuple, fixtures.documents(spark, folder).collect()))
        assert [r[1] for r in made[limit]] == ["1.json", "2.json", "2.json", "3.json", "7-1.json", "7-2.json", "7.json"]
    assert made[10_000] == made[10] == made[0]
    only = spark.createDataFrame([(3,), (7,)], "m long")
    assert sorted(r[1] for r in fixtures.documents(spark, folder, only).collect()) == ["3.json", "7-1.json", "7-2.json", "7.json"]


def test_lines_are_moved_once(spark, small):
    """Besides the branch for long matches, which has few lines or none, one exchange carries a line's columns."""
    carried = re.findall(r"Exchange hashpartitioning\(l_orderkey#\d+L?, \d+\), REPARTITION_BY_COL", plan(fixtures.documents(spark, small)))
    assert len(carried) == 1


def test_folders_are_packed_and_not_sorted_first(spark, tmp_path):
    rows = [(m, "2024-01-0%d" % (m % 2 + 1), "r1") for m in range(20)]
    frame = spark.createDataFrame(rows, "match_type_number long, ingest_date string, run_id string").withColumn("ingest_date", F.to_date("ingest_date"))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in STG_MATCH.read_schema if f.name not in frame.columns]
    write_history(conform(frame.select("*", *missing), STG_MATCH), f"{tmp_path}/h")
    files = list((tmp_path / "h").glob("*/*/*.parquet"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 1
    assert spark.read.parquet(f"{tmp_path}/h").count() == 20


def deliveries(spark):
    ddl = "match_type_number long, innings_number int, over int, ball_in_over int, wicket_index int, stg_modified_ts string, stg_file_hashkey string, stg_file_name string"
    whole = [(m, 1, o, b, None, "2024-01-01", f"h{m}", f"{m}.json") for m in range(5) for o in range(3) for b in range(1, 5)]
    again = [(3, 1, 0, 2, None, "2024-01-02", "h9", "3.json"), (4, 1, 0, 65, 1, "2024-01-01", "h4", "4.json"), (4, 1, 0, 65, 2, "2024-01-01", "h4", "4.json")]
    long = [(6, 1, 0, b, None, "2024-01-01", "h6", "6.json") for b in range(1, 80)]
    return spark.createDataFrame(whole + again + long, ddl)


def test_only_contested_matches_are_moved(spark, space):
    rows = deliveries(spark)
    # ball 65 shares its bit with ball 1, and 79 balls do not fit: both are looked at closely
    assert sorted(r[0] for r in contested_matches(rows).collect()) == [3, 4, 6]
    order = [F.col(c).desc_nulls_last() for c in ("stg_modified_ts", "stg_file_hashkey")]
    expected = keep_first(rows.where("coalesce(wicket_index, 1) = 1"), BALL_KEY, order)
    found = latest_per_ball(rows, space)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
    text = plan(found).split("Initial Plan")[0]
    assert re.search(r"LeftAnti.*", text) and len(re.findall("Exchange hashpartitioning", text)) == 1


def test_a_missing_key_can_be_contested(spark, space):
    rows = spark.createDataFrame([(None, 1), (None, 2), (5, 1)], "k long, v int")
    listed = space.freeze(spark.createDataFrame([(None,)], "k long"))
    assert sorted((r.k or 0, r.v) for r in keep_first_among(rows, listed, ["k"], [F.col("v").desc()]).collect()) == [(0, 2), (5, 1)]


def test_texts_are_not_moved_to_learn_their_day(spark, tmp_path):
    first, later = (b[2] for b in _Site(Lake(spark, tables(spark, tmp_path))).batches())
    assert "Exchange" not in plan(first)
    assert sorted(r.stg_file_name for r in first.collect()) == ["1.json", "2.json", "2.json", "3.json", "7.json"] and later.count() == 0


def test_sums_meet_their_matches_before_they_are_named(spark):
    sums = spark.createDataFrame([], "player_id long, match_id long, bowling_team_id long, runs_scored long, extras long, fours long, sixes long, balls_faced long, times_out long")
    players = spark.createDataFrame([], "player_id long, full_name string, team_id long")
    teams = spark.createDataFrame([], "team_id long, team_name string")
    matches = spark.createDataFrame([], "match_id long, event_name string, match_type string, event_date date, season string")
    text = marts.named_summary(sums, players, teams, matches)._jdf.queryExecution().analyzed().toString()
    # the innermost join is printed last
    assert "match_id" in [line for line in text.splitlines() if "Join Inner" in line][-1]


BALLS = "match_id long, innings_number int, over_number int, ball_in_over int, striker_id long, bowling_team_id long, runs_off_bat int, extras int, is_boundary_4 boolean, is_boundary_6 boolean, is_wicket boolean, wicket_kind string"


def balls(spark):
    rows = [(m, i, o, b, s, 9, o % 7, b % 2, o % 7 == 4, o % 7 == 6, o == 3, "bowled" if o == 3 else None) for m in (1, 2, 3) for i in (1, 2) for o in range(4) for b, s in ((1, 7), (2, 8), (3, None))]
    return spark.createDataFrame(rows, BALLS)


def found(frame):
    return sorted(map(tuple, frame.select(*sorted(frame.columns)).collect()), key=repr)


def moves(frame):
    return re.findall(r"Exchange (\w+\([^)]*\))", plan(frame))


def test_balls_are_moved_once_by_match(spark, monkeypatch):
    matches = spark.createDataFrame([(1,), (2,)], "match_id long").hint("merge")
    career = marts._career_sums(balls(spark), matches)
    # the balls and the matches; the rows per batsman
    assert len([x for x in moves(career) if "match_id" in x]) == 2 and len(moves(career)) == 3
    assert len(moves(marts.summary_sums(balls(spark)).join(matches, "match_id"))) == 2
    assert len(moves(partial_sums(balls(spark)).join(matches, "match_id"))) == 2
    partials = partial_sums(balls(spark)).localCheckpoint()
    assert len(moves(summary_of(partials).join(matches, "match_id"))) == 2
    made = [found(career), found(marts.summary_sums(balls(spark))), found(partial_sums(balls(spark)))]
    assert [(r.player_id, r.innings, r.matches, r.balls, r.runs) for r in career.orderBy("player_id").collect()] == [(7, 4, 2, 16, 24), (8, 4, 2, 16, 24)]
    for over in (0, 2):
        monkeypatch.setattr(marts, "OVERS_PER_BUCKET", over)
        assert [found(marts._career_sums(balls(spark), matches)), found(marts.summary_sums(balls(spark))), found(partial_sums(balls(spark)))] == made


def test_some_matches_are_long(spark, monkeypatch):
    monkeypatch.setattr(marts, "OVERS_PER_BUCKET", 4)
    more = balls(spark).unionByName(balls(spark).where("match_id = 2").withColumn("over_number", F.col("over_number") + 50))
    assert {r.match_id: r.n for r in partial_sums(more).groupBy("match_id").agg(F.sum("balls").alias("n")).collect()} == {1: 24, 2: 48, 3: 24}


def test_summary_rows_are_not_moved_for_own_dismissals(spark):
    summary = spark.createDataFrame([(7, 1, "a"), (8, 1, "b"), (7, 2, "a")], "player_id long, match_id long, batsman_name string").repartition("match_id")
    out = spark.createDataFrame([(7, 1, 2, None), (9, 1, 1, "lbw"), (8, 3, 1, "lbw")], "player_id long, match_id long, own_dismissals long, dismissal_kind string")
    matches = spark.createDataFrame([(1, 5), (2, None)], "match_id long, venue_id long")
    venues = spark.createDataFrame([(5, "Park", "Town")], "venue_id long, venue_name string, city string")
    frame = marts.batsman_summary_ext(summary, out, matches.hint("merge"), venues)
    assert not [x for x in moves(frame) if "player_id" in x and "match_id" in x]
    assert sorted(map(tuple, frame.collect())) == [(7, 1, "a", 5, "Park", "Town", 2, None), (7, 2, "a", None, None, None, 0, None), (8, 1, "b", 5, "Park", "Town", 0, None)]


def test_first_rows_are_written_where_they_are(spark, space, tmp_path):
    rows = spark.range(400).select(F.col("id").alias("match_id"), (F.col("id") + 1).alias("match_no"))
    table = BucketedTable(space, str(tmp_path / "t"), MATCH_NUMBERS, lambda n: F.pmod("match_id", F.lit(n)).cast("int"), 2)
    table.merge(rows.repartition(4), unique_source=True)
    files = {f: len(list((tmp_path / "t/rows").glob(f"version=1/bucket={f}/*.parquet"))) for f in (0, 1)}
    assert files == {0: 4, 1: 4} and table.read().count() == 400
    table.merge(rows.where("match_id = 0").withColumn("match_no", F.lit(0).cast("long")), unique_source=True)
    assert len(list((tmp_path / "t/rows").glob("version=2/bucket=0/*.parquet"))) == 1
    assert table.read().agg(F.sum("match_no")).first()[0] == 400 * 401 // 2 - 1


def test_only_full_buckets_are_counted_by_match(spark, tmp_path, monkeypatch):
    folder = tables(spark, tmp_path)
    lines = fixtures._lines(spark, folder)
    assert "LeftSemi" in plan(fixtures._long_matches(lines))
    for buckets in (1, 2, 65_536):
        monkeypatch.setattr(fixtures, "COUNT_BUCKETS", buckets)
        for limit, long in ((10_000, []), (10, [7]), (2, [1, 7])):
            monkeypatch.setattr(fixtures, "LONG_MATCH", limit)
            assert sorted(r[0] for r in fixtures._long_matches(lines).collect()) == long
