"""Batches that stop and go on, runs that come again, and names that keep their latest spelling."""

import json
import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from scorecards import ball, overs, scorecard

from matchmart.plans.ledger import Ledger, batch_key
from matchmart.plans.warehouse import Warehouse
from matchmart.sources.documents import write_bundles
from matchmart.sources.manifests import read_manifests, write_manifest
from matchmart.streaming import incremental
from matchmart.streaming.incremental import process_batch
from matchmart.workspace import subdirectories

AT = datetime(2024, 5, 1, tzinfo=timezone.utc)


@pytest.fixture
def site(spark, space, tmp_path):
    class Site:
        store, manifests = str(tmp_path / "raw"), str(tmp_path / "manifest")
        warehouse = Warehouse(space, str(tmp_path / "warehouse"), buckets=2)

        def arrive(self, run, date, cards):
            rows = [(f"file:/landing/{n}.json", f"{n}.json", f"{run}-{n}", f"{date}T00:00:00Z", json.dumps(c), run) for n, c in cards.items()]
            raw = spark.createDataFrame(rows, "_source STRING, stg_file_name STRING, stg_file_hashkey STRING, ingested_at STRING, value STRING, run_id STRING")
            write_bundles(raw, self.store)
            entries = raw.select(
                F.col("stg_file_name").alias("object_key"), F.col("_source").alias("uri"), "stg_file_name", "stg_file_hashkey",
                "ingested_at", F.lit(1).cast("long").alias("size_bytes"), F.lit("s").alias("source_url"), F.lit("uploaded").alias("action"))
            write_manifest(entries, self.manifests, run, date)

        def load(self, *runs):
            arrived = read_manifests(spark, self.manifests).where(F.col("run_id").isin(list(runs)))
            return process_batch(arrived, self.manifests, self.store, self.warehouse, AT)

    return Site()


def card(number, first, *runs):
    return scorecard(number, teams=(first, "Beta"), innings=[overs(first, *[ball(runs=r) for r in runs])], players={first: ["A One", "A Two"], "Beta": ["B One"]})


def test_an_interrupted_batch_goes_on_where_it_stopped(site, monkeypatch):
    site.arrive("r1", "2024-01-01", {"a": card(1, "Alpha", 4)})
    done = []
    for name in ("land", "stage", "refresh_dimensions", "merge_fact"):
        real = getattr(site.warehouse, name)
        monkeypatch.setattr(site.warehouse, name, lambda *a, real=real, name=name, **k: (done.append(name), real(*a, **k)))

    def die(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(site.warehouse, "merge_fact", die)
        with pytest.raises(KeyboardInterrupt):
            site.load("r1")
    assert done.count("land") == 1 and done.count("stage") == 3
    assert site.load("r1") == ["r1"]
    assert done.count("land") == 1 and done.count("stage") == 3 and done.count("merge_fact") == 1
    assert site.warehouse.fact().count() == 1
    assert {r.step for r in site.warehouse.ledger.rows().collect()} == {"land", "stage_match", "stage_player", "stage_delivery", "dimensions", "fact"}


def test_a_finished_batch_looks_for_no_texts(site, space, monkeypatch):
    """And a batch opens the manifests of its runs only, and leaves nothing of what it wrote on its way."""
    site.arrive("r1", "2024-01-01", {"a": card(1, "Alpha", 4)})
    site.arrive("r2", "2024-01-02", {"b": card(2, "Alpha", 6)})
    plans, real = [], incremental.latest_per_uri
    monkeypatch.setattr(incremental, "latest_per_uri", lambda frame: (plans.append(frame._jdf.queryExecution().executedPlan().toString()), real(frame))[1])
    assert site.load("r1") == ["r1"]
    monkeypatch.setattr(incremental, "selected_texts", None)
    assert site.load("r1") == ["r1"] and site.warehouse.fact().count() == 1
    assert len(plans) == 2 and all(re.search(r"PartitionFilters: \[[^\]]*run_id#\d+ = r1", text) for text in plans)
    assert not [f for f in subdirectories(space.spark, space.root) if f.startswith("batch-")]


def test_an_older_run_does_not_bring_its_spelling_back(site):
    site.arrive("r1", "2024-01-01", {"a": card(1, "Alpha", 4)})
    site.arrive("r2", "2024-02-01", {"b": card(2, "ALPHA", 6)})
    site.load("r1")
    site.load("r2")
    house = site.warehouse
    names = lambda: {r.team_key: r.team_name for r in house.dim("team").collect()}
    assert names()["alpha"] == "ALPHA"
    # past the ledger, as a repair would do it
    for runs in (["r1"], ["r2", "r1"], ["r1"]):
        house.refresh_dimensions(runs)
        assert names()["alpha"] == "ALPHA" and len(names()) == 2
    assert {r.match_id for r in house.dim("match").collect()} == {1, 2}


def test_batches_are_named_by_content(spark, space, tmp_path):
    def key(*rows):
        return batch_key(spark.createDataFrame(rows, "run_id string, uri string, stg_file_hashkey string, ingested_at string"), "uploaded")

    one, two = ("r1", "a", "x", "t"), ("r2", "b", "y", "t")
    assert key(one, two) == key(two, one) != key(one)
    assert key(one) != key(("r1", "a", "z", "t"))
    ledger = Ledger(space, str(tmp_path / "ledger"))
    assert ledger.steps("k") == set() and ledger.rows().count() == 0
    seen = []
    for _ in range(2):
        ledger.once("k", ["r1"], "land", lambda: seen.append(1))
    ledger.once(None, ["r1"], "land", lambda: seen.append(2))
    assert seen == [1, 2] and ledger.steps("k") == {"land"}
