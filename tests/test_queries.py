"""Every named query equals its SQL, on the small tables and with a third of the rows on one key."""

import pytest
from compare import check, duck
from skewed import write

import __spark_entry__ as contract
from matchmart.catalog.registry import QUERIES

SKEW_PRONE = (
    "scorecard_roundtrip", "delivery_table", "match_table", "dim_match", "fact_delivery", "batsman_summary",
    "batsman_career_ext", "batsman_summary_ext", "dedupe_deliveries", "late_correction", "latest_per_uri",
    "content_dedupe", "manifest_roundtrip", "run_audit", "lineage_join_fanout", "dq_duplicates", "dq_reconcile",
    "incremental_two_batches",
)


@pytest.fixture(scope="module")
def duckdb_small(small):
    return duck(small)


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory, small):
    return write(small, tmp_path_factory.mktemp("skewed"))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, small, duckdb_small, name):
    _, problems = check(spark, duckdb_small, QUERIES[name], small)
    assert not problems


@pytest.mark.parametrize("name", SKEW_PRONE)
def test_equals_sql_with_a_hot_key(spark, skewed_dir, name):
    _, problems = check(spark, duck(skewed_dir), QUERIES[name], skewed_dir)
    assert not problems


def test_contract_is_complete():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).count() == 6480
