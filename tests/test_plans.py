"""Physical plans: what must and must not be in them."""

import re

import pytest

import __spark_entry__  # noqa: F401 (registers the queries)
from matchmart.catalog.registry import QUERIES
from matchmart.catalog import tables
from matchmart.catalog.lake import lake

NAMES = sorted(QUERIES)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in NAMES if n != "incremental_two_batches"])
def test_no_python_no_cross_join_no_global_window(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert not re.search(r"PythonUDF|ArrowEvalPython|BatchEvalPython|InPandas", text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for window in re.findall(r"windowspecdefinition\(([^$]*?)specifiedwindowframe", text):
        assert not re.match(r"\S+ (ASC|DESC)", window), "window without partition keys"


@pytest.mark.parametrize("name", ["match_table", "player_table", "delivery_table", "innings_rows"])
def test_flattening_has_no_exchange_and_one_scan(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "Exchange" not in text and text.count("FileScan") == 1


def test_flattening_reads_only_the_fields_it_needs(spark, small):
    players = plan(QUERIES["player_table"](spark, small))
    assert "players" in players and "innings" not in re.search(r"ReadSchema: \S+", players).group()
    stage = re.search(r"ReadSchema: \S+", plan(QUERIES["match_stage"](spark, small))).group()
    assert "venue" not in stage and "innings" not in stage


def test_point_lookup_is_pushed_down(spark, small):
    text = plan(tables.point_lookup(lake(spark, small)))
    assert "EqualTo(match_type_number,1134)" in text and "EqualTo(innings_number,2)" in text


@pytest.mark.parametrize("name", ["fact_delivery", "dedupe_deliveries", "latest_per_uri", "content_dedupe", "dim_match"])
def test_keep_latest_is_limited_before_the_shuffle(spark, small, name):
    assert plan(QUERIES[name](spark, small)).count("WindowGroupLimit") >= 2


def test_date_selection_prunes_folders(spark, small):
    assert re.search(r"PartitionFilters: \[[^\]]*ingest_date", plan(QUERIES["run_for_date"](spark, small)))


def test_fact_shuffles_the_balls_once(spark, small):
    """With dimensions under the broadcast threshold only the dedupe moves balls."""
    text = plan(QUERIES["fact_delivery"](spark, small))
    assert len(re.findall(r"Exchange hashpartitioning", text.split("Initial Plan")[0])) == 1
