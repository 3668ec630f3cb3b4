import hashlib

import pytest
from compare import check, duck
from odd import kept_text, odd_rows
from pyspark.sql import functions as F

from matchmart.llm import line_dedup, queries
from matchmart.llm.line_dedup import LineRuns, dedup_lines, line_dedup_digest


def test_equals_brute_force(docs, space):
    expected = kept_text(odd_rows())
    rows = line_dedup_digest(docs, space).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        lines, dropped, text = expected[r.doc_id]
        assert (r.n_lines, r.n_dropped, r.kept_sha256) == (lines, dropped, hashlib.sha256(text.encode()).hexdigest())
    assert sum(r.n_dropped for r in rows) > 5


@pytest.mark.parametrize("batches", [1, 7])
def test_batches_do_not_matter(docs, space, batches):
    one = {(r.doc_id, r["__kept"]) for r in dedup_lines(docs, space, batches=batches).collect()}
    assert one == {(i, t) for i, (_, _, t) in kept_text(odd_rows()).items()}


def test_empty_table_and_clashing_columns(nothing, docs, space):
    assert dedup_lines(nothing, space).count() == 0
    wide = docs.withColumns({"h1": F.lit(1), "at": F.lit("x"), "line": F.lit(2), "key": F.lit(3), "top_doc": F.lit(4), "batch": F.lit(5)})
    found = dedup_lines(wide, space)
    assert found.columns == [*wide.columns, "__kept", "__n_lines", "__n_dropped"]
    assert found.count() == wide.count()


def test_every_key_is_in_one_run(spark, space):
    runs = LineRuns(spark, space, buckets=3)
    for start in range(0, 50, 10):
        runs.add(spark.range(start, start + 30).select(F.col("id").alias("h1"), F.lit(0).cast("long").alias("h2"), F.lit(1).cast("long").alias("n_docs"), F.col("id").alias("top_doc")))
    held = [r.h1 for names in runs.levels.values() for n in names for r in spark.table(n).collect()]
    assert sorted(held) == list(range(70))
    assert sum(len(v) for v in runs.levels.values()) == 2  # of five batches: one run of four and one of one
    assert {r.h1: r.n_docs for r in runs.totals().collect()} == {i: sum(s <= i < s + 30 for s in range(0, 50, 10)) for i in range(70)}
    runs.drop()


def test_equals_sql(spark, small):
    class Query:
        sql = queries.ORACLES["op4_line_dedup"]

        def __call__(self, spark, sf_dir):
            return queries.QUERIES["op4_line_dedup"](spark, sf_dir)

    _, problems = check(spark, duck(small), Query(), small)
    assert not problems


def test_no_python_in_the_plan(docs, space, capsys):
    dedup_lines(docs, space).explain()
    assert "Python" not in capsys.readouterr().out
    assert not hasattr(line_dedup, "pa")


def test_time_grows_with_the_lines(spark, space):
    """A text is split once: five texts of 50 000 lines take seconds."""
    import time

    lines = [f"line {i} of a long text that five documents have in common" for i in range(25_000)]
    rows = [(d, "\n".join(x for i, line in enumerate(lines) for x in (line, f"{d} {i}"))) for d in range(5)]
    docs = space.freeze(spark.createDataFrame(rows, "doc_id long, text string"))
    start = time.monotonic()
    found = {r.doc_id: r for r in dedup_lines(docs, space).collect()}
    assert time.monotonic() - start < 60
    for d, text in rows:
        assert found[d]["__n_lines"] == 50_000 and found[d]["__n_dropped"] == (25_000 if d < 4 else 0)
        assert found[d]["__kept"] == (text if d == 4 else "\n".join(f"{d} {i}" for i in range(25_000)))
