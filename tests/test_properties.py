"""Models the operators must agree with, and the counts known for the test tables."""

from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchmart import workspace
from matchmart.catalog.lake import lake
from matchmart.functions import ratios
from matchmart.operators.upsert import upsert
from matchmart.plans import fact, marts, reports

SCHEMA = "k INT, a STRING, b INT"
ROWS = st.dictionaries(st.integers(0, 6), st.tuples(st.one_of(st.none(), st.sampled_from("xyz")), st.integers(0, 3)))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=ROWS, source=ROWS, whole=st.booleans())
def test_upsert_agrees_with_a_dictionary(spark, target, source, whole):
    def frame(rows):
        return spark.createDataFrame([(k, *v) for k, v in rows.items()], SCHEMA)

    expected = dict(target)
    for k, (a, b) in source.items():
        expected[k] = (a, b if whole or k not in target else target[k][1])
    merged = upsert(frame(target), frame(source), ["k"], ["a", "b"] if whole else ["a"], ["k", "a", "b"])
    assert {r.k: (r.a, r.b) for r in merged.collect()} == expected


def test_ratios_agree_with_decimal_rounding(spark):
    pairs = spark.range(400).select((F.col("id") * 7 % 211).alias("n"), (F.col("id") % 40).alias("d"))
    rows = pairs.select("n", "d", ratios.average(F.col("n"), F.col("d")).alias("r"), ratios.percentage(F.col("n"), F.col("d")).alias("p"))

    def exact(n, d, scale):
        if d == 0:
            return None
        return float((Decimal(n) * scale / Decimal(d)).quantize(Decimal("0.01"), ROUND_HALF_UP))

    for r in rows.collect():
        assert (r.r, r.p) == (exact(r.n, r.d, 1), exact(r.n, r.d, 100))


def test_known_counts(spark, small):
    here = lake(spark, small)
    matches = here.staged("match")
    by_result = {r.match_result: r["count"] for r in matches.groupBy("match_result").count().collect()}
    assert by_result == {"Result Declared": 493, "Tie": 514, "No Result": 493}
    stages = {r.match_stage: r["count"] for r in matches.groupBy("match_stage").count().collect()}
    assert (stages["NA"], stages["Final"]) == (107, 108)
    assert matches.where("city IS NULL").count() == 137
    assert here.staged("player").count() == 30_000
    assert here.staged("delivery").count() == 6_480
    assert [here.dim(d).count() for d in ("team", "player", "venue", "date", "match")] == [26, 250, 93, 1_094, 1_500]
    balls = here.fact()
    flags = balls.agg(
        F.count("*").alias("n"), F.count_if("is_boundary_4").alias("fours"), F.count_if("is_boundary_6").alias("sixes"),
        F.sum("extras").alias("extras"), F.count_if(F.col("striker_id").isNull()).alias("unknown"),
        F.count_if("is_wicket").alias("wickets"),
    ).first()
    assert tuple(flags) == (6_000, 844, 787, 290, 538, 360)
    assert fact.keyless(here.staged("delivery")).count() == 362 + 27
    summary = here.summary()
    assert (summary.count(), summary.where("batting_average IS NULL").count()) == (5_011, 4_688)
    assert reports.versus_opponents(summary).count() == 3_315
    assert marts.batsman_dismissal(balls, here.dim("player")).count() == 275


def test_every_layer_is_written_once(spark, small):
    here = lake(spark, small)
    assert lake(spark, small + "/") is here
    before = here.space._written.copy()
    here.load_everything()
    written = here.space._written.copy()
    here.load_everything()
    assert before <= written == here.space._written


class _Session:
    """A session with one setting."""

    def __init__(self, master, setting=None):
        self.conf = self
        self.sparkContext = type("Context", (), {"master": master, "applicationId": master})
        self.setting = setting

    def get(self, name, default):
        return self.setting if name == "spark.checkpoint.dir" and self.setting else default


def test_a_cluster_needs_the_shared_folder():
    assert workspace.shared_root(_Session("spark://host", "store://bucket/shared/")) == "store://bucket/shared"
    assert workspace.shared_root(_Session("local[2]", "store://bucket/shared")) == "store://bucket/shared"
    assert "matchmart-" in workspace.shared_root(_Session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_root(_Session("spark://host"))


def test_releasing_stays_inside_the_workspace(space):
    with pytest.raises(ValueError):
        space.release("/somewhere/else")
