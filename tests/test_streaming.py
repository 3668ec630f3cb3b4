"""Incremental runs: exactly once, empty manifests, repeated batches."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from scorecards import ball, overs, scorecard

from matchmart.contracts import MANIFEST_DDL
from matchmart.plans import marts
from matchmart.plans.publish import publish
from matchmart.plans.warehouse import Warehouse
from matchmart.sources.documents import write_bundles
from matchmart.sources.manifests import write_manifest
from matchmart.streaming.incremental import process_batch, run_available

AT = datetime(2024, 5, 1, tzinfo=timezone.utc)


@pytest.fixture
def site(spark, space, tmp_path):
    import json

    class Site:
        store, manifests, checkpoint = (str(tmp_path / n) for n in ("raw", "manifest", "checkpoint"))
        warehouse = Warehouse(space, str(tmp_path / "warehouse"), buckets=4)

        def arrive(self, run, cards, action="uploaded", at="2024-05-01T00:00:00Z"):
            rows = [(f"file:/landing/{n}.json", f"{n}.json", f"{run}-{n}", at, json.dumps(c), run)
                    for n, c in cards.items()]
            raw = spark.createDataFrame(
                rows, "_source STRING, stg_file_name STRING, stg_file_hashkey STRING, ingested_at STRING, value STRING, run_id STRING")
            if rows:
                write_bundles(raw, self.store)
            entries = raw.select(
                F.col("stg_file_name").alias("object_key"), F.col("_source").alias("uri"), "stg_file_name",
                "stg_file_hashkey", "ingested_at", F.lit(1).cast("long").alias("size_bytes"),
                F.lit("s").alias("source_url"), F.lit(action).alias("action"))
            write_manifest(entries, self.manifests, run, "2024-05-01")

        def run(self):
            run_available(spark, self.manifests, self.store, self.warehouse, self.checkpoint, lambda _: AT, marts=True)

        def runs(self):
            return {r.match_id: r.r for r in self.warehouse.fact().groupBy("match_id").agg(F.sum("runs_off_bat").alias("r")).collect()}

    return Site()


def card(number, *runs):
    return scorecard(number, innings=[overs("Alpha", *[ball(runs=r) for r in runs])])


def test_batches_corrections_and_quiet_runs(site):
    site.arrive("r1", {"a": card(1, 4, 4), "b": card(2, 1)})
    site.run()
    assert site.runs() == {1: 8, 2: 1}
    ids = {r.player_key: r.player_id for r in site.warehouse.dim("player").collect()}
    site.run()
    assert site.runs() == {1: 8, 2: 1}
    site.arrive("r2", {})
    site.run()
    site.arrive("r3", {"a": card(1, 6, 4), "c": card(3, 2)})
    site.arrive("r4", {"b": card(2, 5)}, action="skipped")
    site.run()
    assert site.runs() == {1: 10, 2: 1, 3: 2}
    assert {r.player_key: r.player_id for r in site.warehouse.dim("player").collect()} == ids
    assert site.warehouse.fact().count() == 4
    house = site.warehouse
    whole = marts.batsman_summary(house.fact(), house.dim("player"), house.dim("team"), house.dim("match"))
    assert sorted(map(tuple, house.summary().collect())) == sorted(map(tuple, whole.collect()))
    (career,) = house.career.current().collect()
    assert (career.matches, career.total_runs) == (3, 13)


def test_published_views_answer_sql(spark, site):
    site.arrive("r1", {"a": card(1134, 4), "b": card(1927, 6, 1)})
    site.run()
    names = publish(site.warehouse)
    assert len(names) == 14
    assert spark.sql("SELECT * FROM stg.delivery_table WHERE match_type_number = 1134 AND innings_number = 1").count() == 1
    assert spark.sql("SELECT * FROM dw.fact_delivery WHERE match_id = 1927").count() == 2
    found = spark.sql("SELECT * FROM mart.batsman_summary_mv WHERE batsman_name LIKE '%one%' ORDER BY match_id")
    assert [(r.match_id, r.runs_scored) for r in found.collect()] == [(1134, 4), (1927, 7)]
    assert spark.sql("SELECT * FROM mart.batsman_career_mv WHERE batsman_name LIKE '%one%'").first().total_runs == 11
    assert spark.sql("SELECT * FROM mart.batsman_dismissal_mv").isEmpty()
    assert dict(spark.table("stg.match_table").dtypes)["run_id"] == "string"
    site.arrive("r2", {"c": card(3, 2)})
    site.run()
    publish(site.warehouse)
    assert spark.sql("SELECT count(*) AS n FROM dw.dim_match").first().n == 3
    for name in names:
        spark.sql(f"DROP VIEW {name}")


def test_a_run_is_loaded_whole_when_its_header_arrives(spark, site):
    site.arrive("r1", {"a": card(1, 4), "b": card(2, 6)})
    arrived = spark.read.schema(MANIFEST_DDL).json(site.manifests)
    args = (site.manifests, site.store, site.warehouse, AT)
    assert process_batch(arrived.where("uri LIKE '%a.json'"), *args) == []
    assert process_batch(arrived.where("record_type = 'run'"), *args) == ["r1"]
    assert site.runs() == {1: 4, 2: 6}


def test_a_repeated_batch_changes_nothing(spark, site):
    site.arrive("r1", {"a": card(1, 4, 4)})
    entries = spark.read.schema(MANIFEST_DDL).json(site.manifests)
    for _ in range(2):
        assert process_batch(entries, site.manifests, site.store, site.warehouse, AT) == ["r1"]
        assert site.runs() == {1: 8} and site.warehouse.staged("delivery").count() == 2
        assert site.warehouse.dim("match").count() == 1 and site.warehouse.dim("date").count() == 1


def test_versions_do_not_depend_on_batches_or_repeats(spark, space, site, tmp_path):
    """An older run that is loaded again does not undo a newer one, and two runs in one batch are as two batches."""
    site.arrive("r1", {"z": card(1, 1)}, at="2024-05-01T00:00:00Z")
    site.run()
    site.arrive("r2", {"a": scorecard(1, city="Elsewhere", innings=[overs("Alpha", ball(runs=6))])}, at="2024-05-02T00:00:00Z")
    site.run()
    entries = spark.read.schema(MANIFEST_DDL).json(site.manifests)
    process_batch(entries.where("run_id = 'r1'"), site.manifests, site.store, site.warehouse, AT)
    venues = {r.venue_id: r.city for r in site.warehouse.dim("venue").collect()}
    assert site.runs() == {1: 6}
    assert [venues[r.venue_id].lower() for r in site.warehouse.dim("match").collect()] == ["elsewhere"]
    together = Warehouse(space, str(tmp_path / "other"), buckets=4)
    process_batch(entries, site.manifests, site.store, together, AT)
    assert [r.runs_off_bat for r in together.fact().collect()] == [6]


def test_a_respelt_team_stays_one_batsman(spark, site):
    site.arrive("r1", {"a": card(1, 4)})
    site.run()
    respelt = scorecard(2, teams=("ALPHA", "Beta"), innings=[overs("ALPHA", ball(runs=6))],
                        players={"ALPHA": ["A One", "A Two"], "Beta": ["B One", "B Two"]})
    site.arrive("r2", {"b": respelt}, at="2024-05-02T00:00:00Z")
    site.run()
    house = site.warehouse
    assert [(r.matches, r.total_runs) for r in house.career.current().collect()] == [(2, 10)]
    whole = marts.batsman_summary(house.fact(), house.dim("player"), house.dim("team"), house.dim("match"))
    assert sorted(map(tuple, house.summary().collect())) == sorted(map(tuple, whole.collect()))


def test_marts_of_a_batch_read_touched_buckets_only(spark, site):
    """The fact is not scanned whole for a batch, and the marts equal a rebuild."""
    site.arrive("r1", {"a": card(1, 4, 4), "b": card(2, 1), "c": card(3, 6)})
    site.run()
    site.arrive("r2", {"b": card(2, 5, 5)})
    site.run()
    house = site.warehouse
    touched = house.staged("match", ["r2"]).selectExpr("match_type_number AS match_id").distinct()
    plan = house.balls_of(touched, ["r2"])._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    direct = marts.batsman_career_ext(house.fact(), house.dim("player"), house.dim("team"), house.dim("match"))
    assert sorted(map(tuple, house.career_ext.current().collect())) == sorted(map(tuple, direct.collect()))
    kinds = marts.batsman_dismissal(house.fact(), house.dim("player"))
    assert sorted(map(tuple, house.dismissal.current().collect())) == sorted(map(tuple, kinds.collect()))
