from collections import Counter, defaultdict

import pytest
from odd import odd_rows, words_of
from pyspark.sql import functions as F

from matchmart.llm import queries
from matchmart.llm.mixing import draw_of, mix_sources, mixing_digest


def targets_of(sizes: dict, most: int = 3) -> dict:
    """Share by weight; what is above the cap is shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        share = {s: rest * weight[s] / max(1, sum(weight[o] for o in open_)) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else share[s] for s in order}
        full |= over


def by_source(rows):
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len(words_of(text))
    return sizes


def test_targets_and_taken(docs, space):
    rows = mix_sources(docs, space).collect()
    sizes = by_source(odd_rows())
    expected = targets_of(sizes)
    taken = Counter()
    for r in rows:
        assert r["__size"] == len(words_of(r.text))
        assert r["__source_size"] == sizes[r.source]
        assert r["__target"] == pytest.approx(expected[r.source])
        assert 0 <= r["__copies"] <= 3
        taken[r.source] += r["__size"] * r["__copies"]
    assert len(rows) == len(odd_rows())
    for source, target in expected.items():
        largest = max(len(words_of(t)) for _, t, _, s, _ in odd_rows() if s == source)
        assert abs(taken[source] - target) <= largest


def test_caps_reshare(spark, space):
    rows = [(i, "w " * n, "x", s, 0) for i, (s, n) in enumerate([("a", 1000), ("b", 10), ("c", 10), ("d", 500)])]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.source: r["__target"] for r in mix_sources(frame, space).collect()}
    assert found == {"a": 730.0, "b": 30.0, "c": 30.0, "d": 730.0}


def test_reruns_agree(docs, space):
    one, two = ({(r.doc_id, r.taken) for r in mixing_digest(frame, space).collect()} for frame in (docs, docs.repartition(7)))
    assert one == two


def due_of(sizes: list[int], target: float, most: int = 3) -> dict[int, float]:
    """Expected copies by binary digits of the size, found by halving the level."""
    low, high = 0.0, float(most)
    for _ in range(200):
        level = (low + high) / 2
        if sum(n * min(most, level * n.bit_length()) for n in sizes) > target:
            high = level
        else:
            low = level
    return {w: min(most, low * w) for w in {max(n, 1).bit_length() for n in sizes}}


def lengths(spark, n=6000):
    repeat = F.repeat(F.lit("w "), (F.pow(F.lit(2), F.col("id") % 8) + F.col("id") % 3).cast("int"))
    return spark.range(n).select(F.col("id").alias("doc_id"), repeat.alias("text"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"))


def test_longer_documents_are_drawn_by_their_probability(spark, space):
    rows = mix_sources(lengths(spark), space).collect()
    for source in "ab":
        own = [r for r in rows if r.source == source]
        assert abs(sum(r["__size"] * r["__copies"] for r in own) - own[0]["__target"]) <= 130
        due = due_of([r["__size"] for r in own], own[0]["__target"])
        assert len({round(d, 6) for d in due.values()}) > 3
        for weight, expected in due.items():
            copies = [r["__copies"] for r in own if r["__size"].bit_length() == weight]
            assert set(copies) <= {int(expected + 1e-9), int(expected + 1e-9) + 1}
            assert sum(copies) / len(copies) == pytest.approx(expected, abs=4 * (0.25 / len(copies)) ** 0.5 + 0.02)


def test_the_front_of_the_ranking_is_taken(spark, space):
    """Against a plain sort of one source by random odds over inclusion odds."""
    frame = lengths(spark, 900).withColumn("source", F.lit("a"))
    frame = frame.unionByName(lengths(spark, 900).withColumns({"source": F.lit("b"), "doc_id": F.col("doc_id") + 900}))
    drawn = frame.withColumn("draw", draw_of(F.xxhash64("doc_id", "source", "text"), F.lit(1)))
    rows = mix_sources(drawn, space).collect()
    for source in "ab":
        own = [r for r in rows if r.source == source]
        due = due_of([r["__size"] for r in own], own[0]["__target"])
        ranked, missing = [], 0.0
        for r in own:
            chance = due[r["__size"].bit_length()] % 1
            missing += chance * r["__size"]
            ranked.append((r.draw / (1 - r.draw) * (1 - chance) / chance if chance > 1e-8 else float("inf"), r))
        ranked.sort(key=lambda x: x[0])
        taken, front = 0, set()
        for _, r in ranked:
            if taken + r["__size"] > missing:
                break
            taken += r["__size"]
            front.add(r.doc_id)
        more = {r.doc_id for r in own if r["__copies"] > int(due[r["__size"].bit_length()] + 1e-9)}
        assert front <= more and len(more - front) <= 1


@pytest.mark.parametrize("doc_id", [None, 7])
def test_repeated_rows_are_drawn_one_by_one(spark, space, doc_id):
    rows = [(doc_id, "w " * 10, "a", i) for i in range(40)] + [(i, "w " * 10, "b", i) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, row int").repartition(5)
    found = mix_sources(frame, space).collect()
    assert sorted(r.row for r in found if r.source == "a") == list(range(40))
    for source in "ab":
        own = [r for r in found if r.source == source]
        assert abs(sum(r["__copies"] * r["__size"] for r in own) - own[0]["__target"]) <= 5
    again = mix_sources(frame.repartition(3), space).collect()
    assert Counter((r.doc_id, r["__copies"]) for r in found) == Counter((r.doc_id, r["__copies"]) for r in again)


def test_empty_table_and_clashing_columns(nothing, docs, space, spark):
    assert mix_sources(nothing, space).count() == 0
    blank = spark.createDataFrame([(1, None, "s"), (2, "", None)], "doc_id long, text string, source string")
    assert {r["__copies"] for r in mix_sources(blank, space).collect()} <= {0}
    wide = docs.withColumns({"cut": F.lit(1), "draw": F.lit("x"), "whole": F.lit(2), "rank": F.lit(0), "target": F.lit(3)})
    assert mix_sources(wide, space).columns[: len(wide.columns)] == wide.columns


def test_query_on_given_tables(spark, small):
    rows = queries.QUERIES["op5_mixing"](spark, small).collect()
    assert len(rows) == 200
    assert sum({(r.target, r.source_size): r.target for r in rows}.values()) == pytest.approx(sum(r["size"] for r in rows), rel=0.3)
