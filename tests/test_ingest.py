"""Ingest runs over real folders: checksums, manifests, selection, compaction."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from scorecards import scorecard, write

from matchmart.plans.ingest import ingest, landed
from matchmart.sources import checksums, documents, manifests

RUNS = [datetime(2024, 3, d, 10, 0, 0) for d in (1, 2, 3)]


@pytest.fixture
def place(tmp_path, spark, space):
    class Place:
        files, base, store = str(tmp_path / "in"), str(tmp_path / "manifest"), str(tmp_path / "raw")

        def put(self, **cards):
            write(tmp_path / "in", {f"{n}.json": c for n, c in cards.items()})

        def run(self, at):
            self.outcome = ingest(spark, self.files, self.base, self.store, space, at)
            return self.outcome.run_id

        def manifest(self):
            return manifests.read_manifests(spark, self.base)

    return Place()


def actions(manifest, run):
    rows = manifest.where((F.col("run_id") == run) & (F.col("record_type") == "file")).collect()
    return {r.stg_file_name: r.action for r in rows}


def test_new_changed_and_unchanged_files(spark, place):
    place.put(a=scorecard(1), b=scorecard(2))
    first = place.run(RUNS[0])
    place.put(b=scorecard(2, city="Elsewhere"), c=scorecard(3))
    second = place.run(RUNS[1])
    assert (place.outcome.uploaded, place.outcome.skipped) == (2, 1) and place.outcome.elapsed_seconds > 0
    m = place.manifest()
    assert actions(m, first) == {"a.json": "uploaded", "b.json": "uploaded"}
    assert actions(m, second) == {"a.json": "skipped", "b.json": "uploaded", "c.json": "uploaded"}
    audit = {(r.run_id, r.action): r.files for r in manifests.run_audit(m.where("record_type = 'file'")).collect()}
    assert audit[(second, "uploaded")] == 2
    stored = documents.read_bundles(spark, place.store)
    assert {(r.stg_file_name, r.run_id) for r in stored.collect()} == {
        ("a.json", first), ("b.json", first), ("b.json", second), ("c.json", second)}


def test_a_run_without_news_is_the_newest_run(spark, space, place):
    place.put(a=scorecard(1))
    place.run(RUNS[0])
    quiet = place.run(RUNS[1])
    newest = manifests.newest_run(place.manifest())
    assert {r.run_id for r in newest.select("run_id").collect()} == {quiet}
    assert manifests.select_entries(place.manifest()).isEmpty()
    with pytest.raises(manifests.NoNewInput):
        documents.read_selected(spark, place.store, manifests.select_entries(place.manifest()), space, fail_when_empty=True)
    assert documents.read_selected(spark, place.store, manifests.select_entries(place.manifest()), space).isEmpty()


def test_an_empty_folder_still_records_its_run(spark, place, tmp_path):
    (tmp_path / "in").mkdir()
    run = place.run(RUNS[0])
    (header,) = place.manifest().collect()
    assert (header.record_type, header.run_id, header.uri) == ("run", run, None)


def test_newest_run_by_folder_names(spark, place):
    place.put(a=scorecard(1))
    place.run(RUNS[0])
    place.put(b=scorecard(2))
    run = place.run(RUNS[1])
    newest = manifests.read_newest_run(spark, place.base)
    assert {r.run_id for r in newest.collect()} == {run}
    assert "PartitionFilters: [isnotnull(ingest_date" in newest._jdf.queryExecution().executedPlan().toString()


def test_files_of_a_run_that_died_before_its_manifest_are_new_again(spark, place, tmp_path):
    place.put(a=scorecard(1))
    place.run(RUNS[0])
    place.put(b=scorecard(2))
    scan = checksums.scan_files(spark, place.files)
    work = checksums.work_list(scan, landed(spark, place.base), "uri", "stg_file_hashkey")
    assert [r.uri.rsplit("/", 1)[1] for r in work.collect()] == ["b.json"]


def test_rerun_of_a_run_replaces_it(spark, place):
    place.put(a=scorecard(1))
    place.run(RUNS[0])
    place.put(b=scorecard(2))
    place.run(RUNS[1])
    before = place.manifest().count()
    place.run(RUNS[1])
    assert place.manifest().count() == before


def numbers(frame):
    return sorted(r.info.match_type_number for r in frame.collect())


def test_selected_texts_come_from_the_run(spark, space, place, tmp_path):
    place.put(a=scorecard(1), b=scorecard(2), **{"c d": scorecard(3), "e[1]%20{x}": scorecard(4)})
    place.run(RUNS[0])
    place.put(b=scorecard(20))
    place.run(RUNS[1])
    chosen = manifests.select_entries(place.manifest(), mode="date", date="2024-03-01").where(F.col("stg_file_name") != "a.json")
    assert numbers(documents.read_selected(spark, place.store, chosen, space)) == [2, 3, 4]
    newest = documents.read_selected(spark, place.store, manifests.select_entries(place.manifest()), space)
    assert numbers(newest) == [20]
    every = documents.read_selected(spark, place.store, manifests.select_entries(place.manifest(), action="any"), space)
    assert numbers(every) == [1, 3, 4, 20] and {r.run_id for r in every.collect()} == {"20240302_100000"}


def test_a_listed_text_that_is_missing_is_an_error(spark, space, place):
    place.put(a=scorecard(1))
    place.run(RUNS[0])
    entries = manifests.select_entries(place.manifest()).withColumn("uri", F.explode(F.array("uri", F.lit("file:/gone.json"))))
    with pytest.raises(documents.MissingTexts, match="gone.json"):
        documents.read_selected(spark, place.store, entries, space)


def test_files_in_subfolders_are_stored(spark, space, place, tmp_path):
    write(tmp_path / "in" / "sub", {"b.json": scorecard(2)})
    place.put(a=scorecard(1))
    place.run(RUNS[0])
    assert numbers(documents.read_selected(spark, place.store, manifests.select_entries(place.manifest()), space)) == [1, 2]
    assert numbers(documents.read_files(spark, place.files)) == [1, 2]


def test_a_run_without_header_has_landed_nothing(spark, place, tmp_path):
    place.put(a=scorecard(1))
    run = place.run(RUNS[0])
    for file in (tmp_path / "manifest").rglob("*.json"):
        if '"record_type":"run"' in file.read_text():
            file.write_text("")
    assert landed(spark, place.base).isEmpty()
    again = place.run(RUNS[1])
    assert again != run and actions(place.manifest(), again) == {"a.json": "uploaded"}


def test_a_repeated_run_uploads_again_what_it_uploaded(spark, space, place):
    place.put(a=scorecard(1))
    run = place.run(RUNS[0])
    place.run(RUNS[0])
    assert actions(place.manifest(), run) == {"a.json": "uploaded"}
    assert numbers(documents.read_selected(spark, place.store, manifests.select_entries(place.manifest()), space)) == [1]


def test_the_stored_checksum_is_that_of_the_stored_text(spark, place):
    place.put(a=scorecard(1), b="{oops é")
    place.run(RUNS[0])
    stored = documents.read_bundles(spark, place.store)
    assert stored.where(F.sha2("value", 256) != F.col("stg_file_hashkey")).isEmpty() and stored.count() == 2


def test_files_before_a_time_are_left_alone(spark, space, place):
    place.put(a=scorecard(1))
    done = ingest(spark, place.files, place.base, place.store, space, RUNS[0], modified_after="2100-01-01T00:00:00")
    assert (done.uploaded, done.skipped) == (0, 0)


def test_two_spellings_of_one_file_are_one_record(spark):
    rows = [("file:///a b.json", "2024-01-01", "h1"), ("file:/a%20b.json", "2024-01-02", "h2")]
    frame = spark.createDataFrame(rows, "uri STRING, ingested_at STRING, stg_file_hashkey STRING")
    assert [r.stg_file_hashkey for r in manifests.latest_per_uri(frame).collect()] == ["h2"]


def test_unmatched_guard(spark, place):
    place.put(a=scorecard(1))
    place.run(RUNS[0])
    place.put(b=scorecard(2))
    entries = manifests.select_entries(place.manifest(), mode="all")
    found = documents.attach_manifest(documents.read_files(spark, place.files), entries)
    assert [r["_source"].rsplit("/", 1)[1] for r in documents.unmatched(found).collect()] == ["b.json"]
    with pytest.raises(documents.UnmatchedDocuments):
        documents.require_matched(found)
    assert documents.with_lineage(found, "2024-01-01 00:00:00").where("ingest_date = DATE '2024-03-01'").count() == 1


def test_a_later_skip_does_not_hide_an_upload(spark):
    rows = [("u", "2024-01-01T00:00:00Z", "uploaded"), ("u", "2024-01-02T00:00:00Z", "skipped")]
    m = spark.createDataFrame(rows, "uri STRING, ingested_at STRING, action STRING").select(
        "*", F.lit("file").alias("record_type"), F.lit("h").alias("stg_file_hashkey"), F.lit("r").alias("run_id"))
    (entry,) = manifests.select_entries(m, mode="all", action="uploaded").collect()
    assert entry.ingested_at.startswith("2024-01-01")
    assert manifests.select_entries(m, mode="all", action="any").first().action == "skipped"
    with pytest.raises(ValueError):
        manifests.select_entries(m, mode="some")


def test_manifest_lines_of_another_writer(spark, tmp_path):
    folder = tmp_path / "m" / "ingest_date=2024-01-01"
    folder.mkdir(parents=True)
    (folder / "m.jsonl").write_text('{"object_uri":"store://b/1.json","stg_file_hashkey":"h","action":"uploaded"}\n')
    (row,) = manifests.read_manifests(spark, str(tmp_path / "m"), uri_field="object_uri").collect()
    assert (row.uri, row.record_type, row.action) == ("store://b/1.json", "file", "uploaded")
