"""Reading and flattening hand-written documents, edge cases included."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from scorecards import ball, overs, scorecard, write

from matchmart.functions.uris import basename, normalize_uri
from matchmart.operators import flatten
from matchmart.sources import documents as docs

STAMP = "2024-01-01 00:00:00"
NO_ENTRIES = "uri STRING, stg_file_name STRING, stg_file_hashkey STRING, ingested_at STRING, run_id STRING"


def read(spark, folder):
    found = docs.attach_manifest(docs.read_files(spark, folder), spark.createDataFrame([], NO_ENTRIES))
    return docs.with_lineage(found, STAMP)


def match_rows(spark, tmp_path, **cards):
    folder = write(tmp_path / "in", {f"{n}.json": c for n, c in cards.items()})
    rows = flatten.match_table(docs.well_formed(read(spark, folder))).collect()
    return {r["stg_file_name"].removesuffix(".json"): r for r in rows}


def test_match_columns(spark, tmp_path):
    row = match_rows(spark, tmp_path, a=scorecard(number=9))["a"]
    assert (row.match_type_number, row.match_stage, row.event_date) == (9, "3", dt.date(2020, 2, 1))
    assert (row.event_year, row.event_month, row.event_day) == (2020, 2, 1)
    assert (row.first_team, row.second_team, row.winner) == ("Alpha", "Beta", "Alpha")
    assert (row.match_result, row.toss_decision) == ("Result Declared", "Bat")
    assert (row.stg_file_name, row.stg_file_row_number, row.ingest_date) == ("a.json", 1, None)


def test_dates_and_teams_that_are_missing_or_broken_give_null(spark, tmp_path):
    rows = match_rows(
        spark, tmp_path,
        none=scorecard(dates=[]), text=scorecard(dates=["soon"]), absent=scorecard(dates=None),
        teams=scorecard(teams=(), outcome=None, toss=None), one=scorecard(teams=("Alpha",)),
    )
    assert [rows[n].event_date for n in ("none", "text", "absent")] == [None] * 3
    assert rows["teams"].first_team is None and rows["teams"].toss_decision is None
    assert (rows["one"].first_team, rows["one"].second_team) == ("Alpha", None)


def test_numbers_where_text_is_declared(spark, tmp_path):
    assert match_rows(spark, tmp_path, a=scorecard(season=2021))["a"].season == "2021"


@pytest.mark.parametrize("outcome, shown, winner", [
    ({"winner": "Beta"}, "Result Declared", "Beta"), ({"result": "tie"}, "Tie", "NA"),
    ({"result": "no result"}, "No Result", "NA"), ({"result": "awarded"}, "awarded", "NA"), ({}, None, "NA"),
])
def test_results(spark, tmp_path, outcome, shown, winner):
    row = match_rows(spark, tmp_path, a=scorecard(outcome=outcome))["a"]
    assert (row.match_result, row.winner) == (shown, winner)


@pytest.mark.parametrize("event, stage", [
    ({"match_number": 7, "stage": "Final"}, "7"), ({"stage": "Final"}, "Final"), ({}, "NA"), (None, "NA"),
])
def test_stage_fallback(spark, tmp_path, event, stage):
    assert match_rows(spark, tmp_path, a=scorecard(event=event))["a"].match_stage == stage


def test_malformed_documents_are_rejected_with_their_text(spark, tmp_path):
    folder = write(tmp_path / "in", {"good.json": scorecard(), "bad.json": '{"info": {"match_type_number": 1'})
    found = read(spark, folder)
    assert docs.well_formed(found).count() == 1
    (reject,) = docs.rejects(found).collect()
    assert reject["_source"].endswith("/bad.json") and reject["_corrupt_record"].startswith('{"info"')


def test_bundles_parse_like_files(spark, tmp_path):
    raw = spark.createDataFrame([('{"info": {"match_type_number": 4}}', "x"), ("{oops", "y"), ("", "z")], "value STRING, _source STRING")
    parsed = docs.parse(raw)
    assert [r.info.match_type_number for r in docs.well_formed(parsed).collect()] == [4]
    assert [r["_source"] for r in docs.rejects(parsed).collect()] == ["y", "z"]


def deliveries(spark, tmp_path, innings, **info):
    folder = write(tmp_path / "in", {"a.json": scorecard(innings=innings, **info)})
    return flatten.delivery_table(docs.well_formed(read(spark, folder))).orderBy(
        "innings_number", "over", "ball_in_over", "wicket_index"
    ).collect()


def test_positions_start_at_one_and_lineage_is_carried(spark, tmp_path):
    rows = deliveries(spark, tmp_path, [overs("Alpha", ball(runs=4), ball(extras=1)), overs("Beta", ball(runs=6), over=7)])
    assert [(r.innings_number, r.over, r.ball_in_over, r.runs, r.extras, r.total) for r in rows] == [
        (1, 0, 1, 4, 0, 4), (1, 0, 2, 0, 1, 1), (2, 7, 1, 6, 0, 6)]
    assert {r.stg_file_name for r in rows} == {"a.json"}


def test_two_wickets_give_two_rows_and_fielders_join(spark, tmp_path):
    both = [
        {"player_out": "A One", "kind": "caught", "fielders": [{"name": "B One"}, {}, {"name": "B Two"}]},
        {"player_out": "A Two", "kind": "run out"},
    ]
    rows = deliveries(spark, tmp_path, [overs("Alpha", ball(wickets=both))])
    assert [(r.wicket_index, r.player_out, r.player_out_fielders) for r in rows] == [
        (1, "A One", "B One, B Two"), (2, "A Two", None)]


def test_empty_parents_keep_a_row(spark, tmp_path):
    assert [(r.innings_number, r.over) for r in deliveries(spark, tmp_path / "1", None)] == [(None, None)]
    assert [(r.innings_number, r.country, r.over) for r in deliveries(spark, tmp_path / "2", [{"team": "Alpha", "overs": []}])] == [
        (1, "Alpha", None)]


def test_squads(spark, tmp_path):
    folder = write(tmp_path / "in", {"a.json": scorecard(players={"Alpha": ["A"], "Beta": []}), "b.json": scorecard(players=None)})
    rows = flatten.player_table(docs.well_formed(read(spark, folder))).collect()
    assert sorted(((r.stg_file_name, r.country, r.player_name) for r in rows), key=str) == sorted(
        [("a.json", "Alpha", "A"), ("a.json", "Beta", None), ("b.json", None, None)], key=str)


def test_two_files_with_one_match_number_do_not_multiply_balls(spark, tmp_path):
    card = scorecard(innings=[overs("Alpha", ball(), ball())])
    folder = write(tmp_path / "in", {"a.json": card, "b.json": card})
    assert flatten.delivery_table(docs.well_formed(read(spark, folder))).count() == 4


@pytest.mark.parametrize("spelling", ["file:///d/a%20b+c.json", "file:/d/a b+c.json", "file:///d/a b+c.json"])
def test_uri_spellings(spark, spelling):
    row = spark.createDataFrame([(spelling,)], "u STRING").select(normalize_uri("u").alias("u"), basename(normalize_uri("u")).alias("b")).first()
    assert (row.u, row.b) == ("file:/d/a b+c.json", "a b+c.json")


def test_uri_that_is_no_percent_encoding_is_kept(spark):
    assert spark.range(1).select(normalize_uri(F.lit("store://b/100%.json")).alias("u")).first().u == "store://b/100%.json"
