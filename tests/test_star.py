"""Dimension and fact rules on small staging tables."""

import pytest
from pyspark.sql import functions as F

from matchmart.contracts import STG_DELIVERY, STG_MATCH, STG_PLAYER, conform
from matchmart.plans import dims, fact, marts, quality

DAY = "2024-01-01"


def staged(spark, contract, rows):
    """Staging rows from dicts; columns left out are NULL."""
    kinds = {f.name: f.dataType.simpleString() for f in contract.read_schema}
    names = sorted({n for r in rows for n in r})
    types = {"date": "string", "timestamp": "string"}
    schema = ", ".join(f"{n} {types.get(kinds[n], kinds[n])}" for n in names)
    return conform(spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema), contract)


def match(number, first="Alpha", second="Beta", **more):
    return {"match_type_number": number, "first_team": first, "second_team": second, "winner": "NA",
            "toss_winner": first, "venue": "Park", "city": "Town", "event_date": "2020-02-01", "ingest_date": DAY,
            "stg_file_name": f"{number}.json", "stg_modified_ts": f"{DAY} 00:00:00", "stg_file_hashkey": "h", **more}


def squad(country, *names, **more):
    return [{"match_type_number": 1, "country": country, "player_name": n, "ingest_date": DAY, **more} for n in names]


def ball(over=0, at=1, match=1, country="Alpha", ts=f"{DAY} 00:00:00", runs=0, extras=0, **more):
    return {"match_type_number": match, "innings_number": 1, "country": country, "over": over, "ball_in_over": at,
            "batter": "A One", "non_striker": "A Two", "bowler": "B One", "runs": runs, "extras": extras,
            "total": runs + extras, "stg_modified_ts": ts, "stg_file_hashkey": "h", "ingest_date": DAY, **more}


@pytest.fixture
def star(spark, space):
    class Star:
        def build(self, matches, players=None, strict=False):
            m = staged(spark, STG_MATCH, matches)
            p = staged(spark, STG_PLAYER, players or squad("Alpha", "A One", "A Two") + squad("Beta", "B One"))
            self.team = space.freeze(dims.dim_team(m, space))
            self.venue = space.freeze(dims.dim_venue(m, space))
            self.player = space.freeze(dims.dim_player(p, self.team, space))
            self.match = space.freeze(dims.dim_match(m, self.team, self.venue, strict_venue=strict))
            return self

        def fact(self, rows):
            self.deliveries = staged(spark, STG_DELIVERY, rows)
            return fact.fact_delivery(self.deliveries, self.match, self.team, self.player)

        def ids(self, frame, key, value):
            return {r[key]: r[value] for r in frame.collect()}

    return Star()


def test_spelling_variants_are_one_member(star):
    s = star.build([match(1, "Alpha", "Beta"), match(2, " ALPHA ", "beta", ingest_date="2024-01-05")])
    names = star.ids(s.team, "team_key", "team_name")
    assert names == {"alpha": " ALPHA ", "beta": "beta", "na": "NA"}


def test_no_winner_points_at_the_sentinel_team(star):
    s = star.build([match(1)])
    teams = star.ids(s.team, "team_key", "team_id")
    assert s.match.first().winner_team_id == teams["na"]


def test_ids_are_stable_and_new_members_follow(spark, space, star):
    s = star.build([match(1, "Delta", "Beta")])
    before = star.ids(s.team, "team_key", "team_id")
    more = staged(spark, STG_MATCH, [match(2, "Alpha", "BETA", ingest_date="2024-02-01"), match(3, "Charlie", "Delta")])
    after = dims.dim_team(more, space, s.team, F.lit("2024-03-01 00:00:00").cast("timestamp")).collect()
    ids = {r.team_key: r.team_id for r in after}
    assert {k: ids[k] for k in before} == before == {"beta": 1, "delta": 2, "na": 3}
    assert (ids["alpha"], ids["charlie"]) == (4, 5)
    created = {r.team_key: r.created_at for r in after}
    assert created["beta"] is None and created["alpha"] is not None
    assert {r.team_key: r.team_name for r in after}["beta"] == "BETA"


@pytest.mark.parametrize("strict, found", [(False, True), (True, False)])
def test_venue_without_city(star, strict, found):
    s = star.build([match(1, city=None)], strict=strict)
    assert [(r.venue_key, r.city) for r in s.venue.collect()] == [("park|", None)]
    assert (s.match.first().venue_id is not None) is found


def test_one_match_row_per_number(star):
    s = star.build([match(1, event_name="old"), match(1, event_name="new", stg_modified_ts="2024-01-02 00:00:00"), match(None)])
    assert [(r.match_id, r.event_name) for r in s.match.collect()] == [(1, "new")]


def test_new_dates_only(spark, star):
    m = staged(spark, STG_MATCH, [match(1), match(2, event_date="2021-01-01"), match(3, event_date=None)])
    first = dims.dim_date(m.where("match_type_number = 1"))
    grown = dims.dim_date(m, first)
    assert sorted((r.date_key, r.week, r.quarter, r.season, r.weekday) for r in grown.collect()) == [
        (20200201, 5, 1, "2020", 6), (20210101, 53, 1, "2021", 5)]


def test_players_need_a_known_team(star):
    s = star.build([match(1)], squad("ALPHA ", "A One", " a one") + squad("Nowhere", "X") + squad("Beta", None))
    assert [r.player_key for r in s.player.collect()] == ["a one|alpha"]


def test_fact_resolves_roles_and_flags(star):
    s = star.build([match(1)])
    rows = s.fact([ball(runs=4), ball(at=2, runs=6), ball(at=3, runs=3, extras=1), ball(at=4, batter="Stranger")]).collect()
    rows = sorted(rows, key=lambda r: r.ball_in_over)
    team, player = star.ids(s.team, "team_key", "team_id"), star.ids(s.player, "player_key", "player_id")
    assert {(r.batting_team_id, r.bowling_team_id) for r in rows} == {(team["alpha"], team["beta"])}
    assert [r.striker_id for r in rows] == [player["a one|alpha"]] * 3 + [None]
    assert {r.bowler_id for r in rows} == {player["b one|beta"]}
    assert [(r.is_boundary_4, r.is_boundary_6) for r in rows] == [(True, False), (False, True), (False, False), (False, False)]
    assert [r.runs_off_bat for r in rows] == [4, 6, 3, 0]


def test_batting_side_that_is_neither_team_bowls_at_first(star):
    s = star.build([match(1), match(2, "Gamma", "Delta")])
    f = s.fact([ball(country="Gamma"), ball(at=2, country="Beta"), ball(at=3, country="Unknown")])
    teams = star.ids(s.team, "team_id", "team_key")
    assert {(teams[r.batting_team_id], teams[r.bowling_team_id]) for r in f.collect()} == {
        ("gamma", "alpha"), ("beta", "alpha")}
    m = s.match.select(F.col("match_id").alias("match_type_number"), F.lit("Alpha").alias("first_team"), F.lit("Beta").alias("second_team"))
    stray = quality.unknown_sides(s.deliveries, m.where("match_type_number = 1"))
    assert sorted(r.country for r in stray.collect()) == ["Gamma", "Unknown"]


def test_latest_version_then_first_wicket(star):
    s = star.build([match(1)])
    out = {"player_out": "A One", "player_out_kind": "bowled", "wicket_index": 1}
    second = {"player_out": "A Two", "player_out_kind": "run out", "wicket_index": 2}
    rows = [ball(runs=1, ts="2024-01-01 00:00:00"), ball(runs=2, ts="2024-01-02 00:00:00", **second),
            ball(runs=2, ts="2024-01-02 00:00:00", **out)]
    (row,) = s.fact(rows).collect()
    assert (row.runs_off_bat, row.wicket_kind, row.is_wicket) == (2, "bowled", True)


def test_rows_without_a_ball_are_kept_out(star):
    s = star.build([match(1)])
    rows = [ball(), ball(over=None, at=None), ball(over=None, at=None, innings_number=None, country=None)]
    assert s.fact(rows).count() == 1
    steps = {r.step: r.n for r in quality.reconcile(s.deliveries, s.fact(rows)).collect()}
    assert steps == {"staged": 3, "rejected_no_innings": 1, "rejected_no_overs": 1, "deduplicated": 0, "fact": 1,
                     "rejected_unresolved": 0}


def test_wickets_are_charged_to_the_striker_but_own_dismissals_are_not(star):
    s = star.build([match(1)])
    f = s.fact([ball(player_out="A Two", player_out_kind="run out", wicket_index=1)])
    player = star.ids(s.player, "player_key", "player_id")
    (by_striker,) = marts.batsman_dismissal(f, s.player).collect()
    (own,) = marts.own_dismissals(s.deliveries, f, s.player).collect()
    assert by_striker.player_id == player["a one|alpha"] and own.player_id == player["a two|alpha"]


def test_own_dismissals_follow_the_version_in_the_fact(star):
    s = star.build([match(1)])
    stale = ball(player_out="A Two", player_out_kind="run out", wicket_index=1)
    f = s.fact([stale, ball(ts="2024-01-02 00:00:00")])
    assert marts.own_dismissals(s.deliveries, f, s.player).isEmpty()


def test_strikers_outside_the_squads_are_reported(star):
    s = star.build([match(1)])
    f = s.fact([ball(), ball(at=2, batter="Stranger")])
    assert {r.role: r.balls for r in quality.off_roster(f).collect()} == {
        "striker_id": 1, "non_striker_id": 0, "bowler_id": 0}
    assert marts.batsman_career(f, s.player, s.team, s.match).first().matches == 1


def test_summary_adds_up_to_career(star):
    s = star.build([match(1), match(2, "Alpha", "Gamma")])
    f = s.fact([ball(runs=n % 7, match=1 + n % 2, at=n) for n in range(1, 20)])
    summary = marts.batsman_summary(f, s.player, s.team, s.match)
    direct = marts.batsman_career(f, s.player, s.team, s.match)
    again = marts.career_from_summary(summary, s.player, s.team).select(*direct.columns)
    assert direct.collect() == again.collect()


@pytest.mark.parametrize("num, den, average, share", [(201, 200, 1.01, 100.5), (1, 3, 0.33, 33.33), (2, 3, 0.67, 66.67),
                                                      (0, 5, 0.0, 0.0), (5, 0, None, None), (-201, 200, -1.01, -100.5)])
def test_ratios(spark, num, den, average, share):
    from matchmart.functions import ratios

    n, d = F.lit(num), F.lit(den)
    assert tuple(spark.range(1).select(ratios.average(n, d), ratios.percentage(n, d)).first()) == (average, share)
