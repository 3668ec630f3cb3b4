"""Upsert semantics, bucketed tables, snapshots, sinks."""

import pytest
from pyspark.sql import functions as F

from matchmart.contracts import DIM_TEAM, FACT_DELIVERY, MART_SUMMARY_SUMS, STG_MATCH, conform, create_layers, create_table
from matchmart.operators.upsert import insert_only, newer_rows, upsert
from matchmart.plans.fact import fact_table
from matchmart.plans.marts import summary_table
from matchmart.sources import sinks

TARGET = [(1, "a", "keep1", 10), (2, "b", "keep2", 20), (None, "n", "keep3", 30)]
SCHEMA = "k INT, v STRING, created STRING, n INT"


@pytest.fixture
def target(spark):
    return spark.createDataFrame(TARGET, SCHEMA)


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_update_insert_keep(spark, target):
    source = spark.createDataFrame([(2, None, "x", 99), (3, "c", "x", 33)], SCHEMA)
    merged = upsert(target, source, ["k"], update=["v"], insert=["k", "v", "n"])
    assert rows(merged) == rows(spark.createDataFrame(
        [(1, "a", "keep1", 10), (2, None, "keep2", 20), (3, "c", None, 33), (None, "n", "keep3", 30)], SCHEMA))


def test_whole_row_replacement_gives_the_same(spark, target):
    source = spark.createDataFrame([(2, None, "x", 99), (3, "c", "x", 33), (None, "m", "x", 1)], SCHEMA)
    rest = ["v", "created", "n"]
    merged = upsert(target, source, ["k"], rest)
    assert rows(merged) == rows(spark.createDataFrame(
        [TARGET[0], TARGET[2], (2, None, "x", 99), (3, "c", "x", 33), (None, "m", "x", 1)], SCHEMA))
    assert "FullOuter" not in merged._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("update", [["v"], ["v", "created", "n"]])
def test_repeated_source_key_fails(spark, target, update):
    source = spark.createDataFrame([(2, "x", "x", 1), (2, "y", "y", 2)], SCHEMA)
    with pytest.raises(Exception, match="repeats key"):
        upsert(target, source, ["k"], update).collect()


@pytest.mark.parametrize("update", [["v"], ["v", "created", "n"]])
def test_idempotent(spark, target, update):
    source = spark.createDataFrame([(2, "z", "s", 5), (4, "w", "s", 6)], SCHEMA)
    once = upsert(target, source, ["k"], update, ["k", "v", "created", "n"])
    assert rows(upsert(once, source, ["k"], update, ["k", "v", "created", "n"])) == rows(once)


def test_rows_that_meet_once_are_those_of_the_joins(spark):
    """Newer and older versions, equal ones, repeated keys on either side, keys that are missing."""
    ddl = "k INT, part STRING, ver INT, v STRING"
    target = spark.createDataFrame([(1, "a", 1, "t"), (2, "a", 5, "t"), (3, "a", 2, "t"), (3, "a", 2, "t2"), (None, "a", 1, "t"), (5, None, 1, "t"), (6, "b", None, "t"), (7, "b", 1, "t"), (8, "b", 3, "t")], ddl)
    source = spark.createDataFrame([(1, "a", 2, "s"), (2, "a", 4, "s"), (2, "a", 6, "s"), (3, "a", 2, "s"), (None, "a", 0, "s"), (5, None, 0, "s"), (6, "b", 1, "s"), (7, "b", None, "s"), (9, "b", 1, "s"), (9, "b", 1, "s2")], ddl)
    keys = ["k", "part"]
    stale = target.select(*keys, F.struct("ver").alias("held")).join(source.select(*keys, F.struct("ver").alias("new")), keys).where("held > new")
    fresh = source.join(stale.select(*keys), keys, "left_anti").select(*source.columns)
    for version, incoming in ((("ver",), fresh), ((), source)):
        once = newer_rows(target, source, keys, version, ["k"])
        assert rows(once) == rows(upsert(target, incoming, keys, ["ver", "v"], unique_source=True))
        assert once._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_a_large_batch_merges_as_a_small_one(spark, space, tmp_path, monkeypatch):
    made = []
    for limit, folder in ((10**6, "few"), (0, "many")):
        monkeypatch.setattr(sinks, "BROADCAST_ROWS", limit)
        table = fact_table(space, str(tmp_path / folder), buckets=4)
        at = lambda m, n, day: balls(spark, m, n).withColumn("stg_modified_ts", F.lit(f"2024-01-0{day}").cast("timestamp"))
        for batch in (at(range(6), 1, 2), at([3, 9], 6, 3), at([3, 4], 2, 1)):
            table.merge(batch, unique_source=True, version=("stg_modified_ts", "stg_file_hashkey"))
        made.append(rows(table.read()))
    assert made[0] == made[1] and len(made[0]) == 21
    assert {r.match_id: r.runs_off_bat for r in table.read().collect()} == {0: 1, 1: 1, 2: 1, 3: 6, 4: 1, 5: 1, 9: 6}


def test_insert_only(spark, target):
    source = spark.createDataFrame([(2, "x", "x", 1), (5, "e", "e", 5)], SCHEMA)
    assert rows(insert_only(target, source, ["k"])) == [(5, "e", "e", 5)]


def balls(spark, matches, runs):
    keys = spark.createDataFrame([(m, 1, o, 1) for m in matches for o in (0, 1, 60)],
                                 "match_id LONG, innings_number INT, over_number INT, ball_in_over INT")
    return conform(keys.withColumn("runs_off_bat", F.lit(runs).cast("smallint")), FACT_DELIVERY)


def test_bucketed_merge_rewrites_touched_buckets_only(spark, space, tmp_path):
    table = fact_table(space, str(tmp_path / "fact"), buckets=16)
    assert table.read().count() == 0
    table.merge(balls(spark, range(20), 1))
    before = table.placed()
    table.merge(balls(spark, [3, 25], 6))
    assert sorted((r.runs_off_bat, r["count"]) for r in table.read().groupBy("runs_off_bat").count().collect()) == [(1, 57), (6, 6)]
    kept = {f for f, v in table.placed().items() if before.get(f) == v}
    assert kept and len(kept) < len(before)
    written = {p.parent.name for p in tmp_path.glob("fact/rows/version=2/bucket=*/*.parquet")}
    assert written and not written & kept
    table.merge(balls(spark, [3, 25], 6))
    assert table.read().count() == 63
    table.merge(balls(spark, [], 6))
    assert table.read().count() == 63


def test_a_job_killed_before_its_record_leaves_the_old_table(spark, space, tmp_path, monkeypatch):
    table = fact_table(space, str(tmp_path / "fact"), buckets=16)
    table.merge(balls(spark, range(20), 1))
    reading = table.read()

    def killed(placed):
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(table, "_publish", killed)
        with pytest.raises(RuntimeError, match="killed"):
            table.merge(balls(spark, range(30), 6))
    assert list(tmp_path.glob("fact/rows/version=2/bucket=*/*.parquet"))
    fresh = fact_table(space, str(tmp_path / "fact"), buckets=16)
    assert [(r.runs_off_bat, r["count"]) for r in fresh.read().groupBy("runs_off_bat").count().collect()] == [(1, 60)]
    fresh.clean()
    assert not list(tmp_path.glob("fact/rows/version=2"))
    fresh.merge(balls(spark, range(30), 6))
    assert [(r.runs_off_bat, r["count"]) for r in fresh.read().groupBy("runs_off_bat").count().collect()] == [(6, 90)]
    # a reader that started before goes on with what it saw
    assert reading.count() == 60 and reading.agg(F.sum("runs_off_bat")).first()[0] == 60


def test_cleaning_keeps_what_counts(spark, space, tmp_path):
    table = fact_table(space, str(tmp_path / "fact"), buckets=16)
    for runs, matches in enumerate([range(20), [3], [3, 4], [5]]):
        table.merge(balls(spark, matches, runs))
    rows = sorted(map(tuple, table.read().select("match_id", "runs_off_bat").collect()))
    table.clean()
    assert sorted(map(tuple, table.read().select("match_id", "runs_off_bat").collect())) == rows
    there = {(int(p.parent.name.partition("=")[2]), p.name) for p in tmp_path.glob("fact/rows/version=*/bucket=*")}
    assert there == {(v, f) for f, v in table.placed().items()}


def test_bucketed_merge_rejects_repeated_keys(spark, space, tmp_path):
    table = fact_table(space, str(tmp_path / "fact"), buckets=4)
    twice = balls(spark, [1], 1).unionByName(balls(spark, [1], 2))
    with pytest.raises(Exception, match="repeats key"):
        table.merge(twice)


def test_long_matches_spread_over_buckets(spark, space, tmp_path):
    one = spark.range(3000).select(F.lit(7).cast("long").alias("match_id"), F.lit(1).alias("innings_number"),
                                   F.col("id").cast("int").alias("over_number"), F.lit(1).alias("ball_in_over"))
    table = fact_table(space, str(tmp_path / "fact"), buckets=16)
    table.merge(conform(one, FACT_DELIVERY))
    assert len(list(tmp_path.glob("fact/rows/version=1/bucket=*"))) > 8


def test_replacing_groups_drops_rows_that_are_gone(spark, space, tmp_path):
    table = summary_table(space, str(tmp_path / "mart"), buckets=8)

    def rows_of(*pairs):
        frame = spark.createDataFrame([(m, p, 1) for m, p in pairs], "match_id LONG, player_id LONG, bowling_team_id LONG")
        return conform(frame, MART_SUMMARY_SUMS)

    def groups(*ids):
        return spark.createDataFrame([(i,) for i in ids], "match_id LONG")

    table.replace_groups(rows_of(*[(m, p) for m in range(6) for p in (1, 2)]), "match_id", groups(*range(6)))
    table.replace_groups(rows_of((1, 9), (7, 1)), "match_id", groups(0, 1, 2, 7))
    assert sorted((r.match_id, r.player_id) for r in table.read().collect()) == [
        (1, 9), (3, 1), (3, 2), (4, 1), (4, 2), (5, 1), (5, 2), (7, 1)]


def test_snapshots_switch_to_finished_versions(spark, tmp_path):
    shots = sinks.Snapshots(spark, str(tmp_path / "dim"))
    assert shots.current() is None
    shots.replace(spark.range(3))
    second = shots.replace(shots.current().union(spark.range(2)))
    assert second.count() == shots.current().count() == 5
    (tmp_path / "dim" / "v00000009").mkdir()
    assert shots.current().count() == 5
    assert shots.replace(spark.range(1)).count() == shots.current().count() == 1


def test_history_rerun_replaces_its_run_and_keeps_others(spark, tmp_path):
    base = str(tmp_path / "history")

    def batch(run, date, numbers):
        f = spark.createDataFrame([(n,) for n in numbers], "match_type_number LONG")
        f = f.withColumn("run_id", F.lit(run)).withColumn("ingest_date", F.lit(date).cast("date"))
        sinks.write_history(conform(f, STG_MATCH), base)

    batch("r1", "2024-01-01", [1, 2])
    batch("r2", None, [3])
    batch("r1", "2024-01-01", [1, 2])
    read = sinks.read_history(spark, base, STG_MATCH)
    assert sorted((r.match_type_number, r.run_id, str(r.ingest_date)) for r in read.collect()) == [
        (1, "r1", "2024-01-01"), (2, "r1", "2024-01-01"), (3, "r2", "None")]
    sinks.write_latest(read, str(tmp_path / "latest"), "r2")
    assert [r.match_type_number for r in spark.read.parquet(str(tmp_path / "latest")).collect()] == [3]


def test_file_count(spark, tmp_path):
    sinks.write_csv(spark.range(100).repartition(5), str(tmp_path / "csv"), files=2)
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 2


def test_tables_enforce_lengths(spark, tmp_path):
    create_layers(spark)
    name = create_table(spark, DIM_TEAM, str(tmp_path / "dim_team"), replace=True)
    spark.sql(f"INSERT INTO {name} VALUES (1, 'k', 'n', NULL, NULL)")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        spark.sql(f"INSERT INTO {name} VALUES (2, 'k', repeat('x', 129), NULL, NULL)")
    spark.sql(f"DROP TABLE {name}")


def test_conform_raises_on_overflow(spark):
    wide = spark.createDataFrame([(1, 70000)], "match_id LONG, runs_off_bat INT")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        conform(wide, FACT_DELIVERY).collect()
