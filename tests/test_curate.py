"""The flatten job end to end over files."""

from datetime import datetime

import pytest
from scorecards import ball, overs, scorecard, write

from matchmart.contracts import STG_DELIVERY, STG_MATCH
from matchmart.plans.curate import curate
from matchmart.plans.ingest import ingest
from matchmart.sources import sinks
from matchmart.sources.documents import UnmatchedDocuments
from matchmart.sources.manifests import NoNewInput


@pytest.fixture
def job(spark, space, tmp_path):
    class Job:
        def put(self, **cards):
            write(tmp_path / "in", {f"{n}.json": c for n, c in cards.items()})

        def ingest(self, day):
            return ingest(spark, str(tmp_path / "in"), str(tmp_path / "m"), str(tmp_path / "raw"), space, datetime(2024, 3, day)).run_id

        def run(self, **options):
            return curate(spark, str(tmp_path / "raw"), str(tmp_path / "m"), str(tmp_path / "out"), files=str(tmp_path / "in"), **options)

        def numbers(self, path, contract=STG_MATCH):
            return sorted(r.match_type_number for r in sinks.read_history(spark, path, contract).collect())

    return Job()


def card(number):
    return scorecard(number, innings=[overs("Alpha", ball(), ball())])


def test_modes_one_after_another(spark, job):
    job.put(a=card(1), b=card(2))
    first = job.ingest(1)
    done = job.run()
    assert done.run_id == first and job.numbers(done.history["match"]) == [1, 2]
    job.put(b=card(20), c="{broken")
    second = job.ingest(2)
    done = job.run(csv=True)
    assert done.run_id == second and [r["_source"].rsplit("/", 1)[1] for r in done.rejected.collect()] == ["c.json"]
    assert job.numbers(done.history["match"]) == [1, 2, 20]
    latest = spark.read.schema(STG_MATCH.read_schema).parquet(done.latest["match"])
    assert [r.match_type_number for r in latest.collect()] == [20]
    csv = spark.read.option("header", True).csv(done.latest["match"].replace("latest", "csv"))
    assert csv.columns == STG_MATCH.columns and csv.count() == 1
    job.ingest(3)
    assert job.run().run_id is None
    with pytest.raises(NoNewInput):
        job.run(fail_when_empty=True)
    assert job.run(mode="date", date="2024-03-01").run_id == first
    everything = job.run(mode="all", output_files=1)
    assert job.numbers(everything.history["delivery"], STG_DELIVERY).count(20) == 2
    assert job.numbers(everything.history["match"]) == [1, 20]


def test_files_mode_wants_every_document_recorded(spark, job):
    job.put(a=card(1))
    job.ingest(1)
    job.put(b=card(2))
    with pytest.raises(UnmatchedDocuments):
        job.run(mode="files")
    done = job.run(mode="files", fail_on_unmatched=False)
    assert job.numbers(done.history["match"]) == [1, 2]
