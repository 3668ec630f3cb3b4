"""Marts by difference: equal to a rebuild, complete after an interruption, touched folders only."""

import re

import pytest
from pyspark.sql import functions as F

from matchmart.contracts import FACT_DELIVERY, conform
from matchmart.operators import lookups
from matchmart.plans import mart_store
from matchmart.plans.mart_store import MartStore, kind_totals, partial_sums, player_totals
from matchmart.workspace import Workspace


def balls(spark, rows):
    """(match, innings, over, striker, runs, wicket kind)"""
    frame = spark.createDataFrame(
        [(m, i, o, at, s, 9, r, 0, r, r == 4, r == 6, k is not None, k) for at, (m, i, o, s, r, k) in enumerate(rows)],
        "match_id long, innings_number int, over_number int, ball_in_over int, striker_id long, bowling_team_id long, runs_off_bat int,"
        " extras int, total_runs int, is_boundary_4 boolean, is_boundary_6 boolean, is_wicket boolean, wicket_kind string",
    )
    return conform(frame, FACT_DELIVERY)


FIRST = [(1, 1, 0, 7, 4, None), (1, 2, 0, 7, 6, "bowled"), (1, 1, 1, 8, 1, None), (2, 1, 0, 7, 2, "caught"), (2, 1, 60, None, 3, None), (3, 1, 0, 8, 0, "lbw")]
#: match 1 lost its second innings, match 2 a batsman, match 4 is new
SECOND = [(1, 1, 0, 7, 5, None), (1, 1, 1, 8, 1, None), (2, 1, 0, 8, 2, "caught"), (4, 1, 0, 9, 6, None)]


def state(store):
    career = {r.player_id: r.asDict() for r in store.career().collect()}
    kinds = {(r.player_id, r.wicket_kind): r.outs for r in store.kinds.current().collect()}
    return career, kinds, sorted(map(tuple, store.partials.read().drop("match_no").collect()), key=repr)


def rebuilt(spark, space, tmp_path):
    store = MartStore(space, str(tmp_path / "rebuilt"))
    rows = [r for r in FIRST if r[0] == 3] + SECOND
    store.refresh(balls(spark, rows), balls(spark, rows).select("match_id"))
    return state(store)


def second(spark):
    return balls(spark, SECOND), spark.createDataFrame([(1,), (2,), (4,)], "match_id long")


def test_equals_a_rebuild(spark, space, tmp_path):
    store = MartStore(space, str(tmp_path / "store"))
    store.refresh(balls(spark, FIRST), balls(spark, FIRST).select("match_id"))
    career, kinds, _ = state(store)
    assert (career[7]["matches"], career[7]["innings"], career[7]["runs"]) == (2, 3, 12) and kinds == {(7, "bowled"): 1, (7, "caught"): 1, (8, "lbw"): 1}
    store.refresh(*second(spark))
    assert state(store) == rebuilt(spark, space, tmp_path)
    store.refresh(*second(spark))
    assert state(store) == rebuilt(spark, space, tmp_path / "again")


@pytest.mark.parametrize("dies_at", ["totals", "kinds", "partials", "sets"])
def test_an_interrupted_refresh_is_completed(spark, space, tmp_path, monkeypatch, dies_at):
    store = MartStore(space, str(tmp_path / "store"))
    store.refresh(balls(spark, FIRST), balls(spark, FIRST).select("match_id"))

    def die(*_):
        raise KeyboardInterrupt

    table = getattr(store, dies_at)
    monkeypatch.setattr(table, "replace" if dies_at in ("totals", "kinds") else "replace_groups", die)
    with pytest.raises(KeyboardInterrupt):
        store.refresh(*second(spark))
    again = MartStore(space, str(tmp_path / "store"))
    again.recover()
    assert state(again) == rebuilt(spark, space, tmp_path)


def test_a_batch_opens_its_folders_only(spark, space, tmp_path):
    """Match numbers 1 and 40 000 are in different folders of partials and bitmaps."""
    store = MartStore(space, str(tmp_path / "store"))
    many = spark.range(1, 33_000).select(F.col("id").alias("match_id"), F.lit(1).alias("innings_number"), F.lit(7).cast("long").alias("striker_id"))
    fact = conform(many.withColumns({"over_number": F.lit(0), "ball_in_over": F.lit(1), "runs_off_bat": F.lit(1), "extras": F.lit(0), "is_wicket": F.lit(False)}), FACT_DELIVERY)
    store.refresh(fact, many.select("match_id"))
    assert store.career().first().matches == 32_999 and store.sets.read().count() == 2
    last = store.numbers.read().where("match_no = 32999")
    plan = store.of_matches(last)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ = 2", plan) or re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN \(2\)", plan)


def test_totals_are_invertible(spark):
    one, two = partial_sums(balls(spark, FIRST)), partial_sums(balls(spark, SECOND))
    for totals, keys, values in ((player_totals, ["player_id"], mart_store.TOTALS), (kind_totals, ["player_id", "wicket_kind"], ["outs"])):
        delta = mart_store.difference(totals(two), totals(one), keys, values)
        found = mart_store.added(totals(one), delta, keys, values, values[-2] if len(values) > 1 else "outs")
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, totals(two).select(*keys, *values).collect()), key=repr)


def test_the_first_refresh_joins_no_stored_rows(spark, space, tmp_path):
    """Of a table without rows the plan knows that; rows of unknown size would have all matches broadcast to them."""
    store = MartStore(space, str(tmp_path / "store"))
    matches = space.freeze(spark.range(5).select(F.col("id").alias("match_id"), F.col("id").alias("match_no")))
    found = store.of_matches(matches)
    assert found.collect() == [] and "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert "wicket_kind" in found.columns


def test_many_matches_are_not_gathered_in_the_driver(spark, space, tmp_path, monkeypatch):
    """Lists of ids have small files; beyond a number of rows they are moved, not broadcast."""
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 1)
    made, write, freeze = [], MartStore._write, Workspace.freeze
    look = lambda frame: made.append(frame._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(MartStore, "_write", lambda self, name, frame: (look(frame), write(self, name, frame))[1])
    monkeypatch.setattr(Workspace, "freeze", lambda self, frame, *a, **b: (look(frame), freeze(self, frame, *a, **b))[1])
    store = MartStore(space, str(tmp_path / "store"))
    store.refresh(balls(spark, FIRST), balls(spark, FIRST).select("match_id"))
    store.refresh(*second(spark))
    assert any("Join" in text for text in made)
    # long matches are few, and summed apart
    assert not [text for text in made if "BroadcastHashJoin" in text and "over_number" not in text]
    assert state(store) == rebuilt(spark, space, tmp_path)
