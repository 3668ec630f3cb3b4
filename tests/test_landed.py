"""The landed state: levels, interruptions, lookups without moving the stored runs."""

import re

import pytest
from pyspark.sql import functions as F

from matchmart.sources.landed import LandedRuns
from matchmart.sources.manifests import landed_state, read_manifests, write_manifest
from matchmart.workspace import subdirectories

NAMES = ["object_key", "uri", "stg_file_name", "stg_file_hashkey", "ingested_at", "size_bytes", "source_url", "action"]


@pytest.fixture
def place(spark, tmp_path):
    class Place:
        manifests, base = str(tmp_path / "manifest"), str(tmp_path / "landed")

        def run(self, n, files, action="uploaded"):
            rows = [(f, f"file:/l/{f}", f, h, f"2024-01-{n:02d}T00:00:00Z", 1, "s", action) for f, h in files.items()]
            frame = spark.createDataFrame(rows, ", ".join(f"{c} {'long' if c == 'size_bytes' else 'string'}" for c in NAMES))
            write_manifest(frame, self.manifests, f"r{n:02d}", f"2024-01-{n:02d}")

        def state(self):
            return LandedRuns(spark, self.base, 2)

        def whole(self, **but):
            return pairs(landed_state(read_manifests(spark, self.manifests), **but))

    return Place()


def pairs(frame):
    return sorted((r.uri, r.stg_file_hashkey) for r in frame.collect())


def test_levels_and_lookups(spark, place):
    for n in range(1, 7):
        place.run(n, {"a": f"a{n}", f"f{n}": "x"})
        assert place.state().catch_up(place.manifests) == [f"r{n:02d}"]
    assert place.state().catch_up(place.manifests) == []
    # four runs became one of the next level
    assert sorted(t[0] for t in place.state().tables()) == ["0", "0", "1"]
    assert pairs(place.state().state()) == place.whole()
    scan = spark.createDataFrame([("file:/l/a",), ("file:///l/f2",), ("file:/l/none",), ("file:/l/a",)], "uri string")
    assert pairs(place.state().of(scan)) == [("file:/l/a", "a6"), ("file:/l/f2", "x")]
    assert pairs(place.state().of(scan, except_run="r06")) == [("file:/l/a", "a5"), ("file:/l/f2", "x")]


def test_only_the_scan_moves(spark, place):
    for n in range(1, 4):
        place.run(n, {f"f{i}": "x" for i in range(20)})
        place.state().catch_up(place.manifests)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = place.state().of(spark.createDataFrame([("file:/l/f1",)], "uri string"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and plan.count("SortMergeJoin") == 3


def test_interrupted_additions(spark, place, monkeypatch):
    """A run that was stored but not marked is taken over again; a compaction that died in between says nothing new."""
    place.run(1, {"a": "a1"})
    state = place.state()

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr("matchmart.sources.landed.touch", die)
        with pytest.raises(KeyboardInterrupt):
            state.catch_up(place.manifests)
    assert place.state().catch_up(place.manifests) == ["r01"]
    place.run(2, {"a": "a2", "b": "b2"})
    place.run(3, {"a": "a3"}, action="skipped")
    with monkeypatch.context() as patch:
        patch.setattr("matchmart.sources.landed.remove", die)
        place.state().catch_up(place.manifests)
        place.run(4, {"c": "c4"})
        with pytest.raises(KeyboardInterrupt):
            place.state().catch_up(place.manifests)
    assert pairs(place.state().state()) == place.whole() == [("file:/l/a", "a2"), ("file:/l/b", "b2"), ("file:/l/c", "c4")]


def test_a_run_without_its_header_has_landed_nothing(spark, place):
    place.run(1, {"a": "a1"})
    (spark.createDataFrame([("file", "file:/l/z", "z9", "uploaded")], "record_type string, uri string, stg_file_hashkey string, action string")
        .write.json(f"{place.manifests}/ingest_date=2024-01-09/run_id=r09"))
    assert place.state().catch_up(place.manifests) == ["r01"]
    assert pairs(place.state().state()) == [("file:/l/a", "a1")]
    assert subdirectories(spark, f"{place.base}/_added") == ["run_id=r01"]
    assert place.state().of(spark.range(1).select(F.lit("file:/l/q").alias("uri"))).count() == 0
