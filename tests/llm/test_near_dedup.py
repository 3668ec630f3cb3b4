import numpy as np
import pytest
from odd import components_of, odd_rows, shingles_of
from pyspark.sql import functions as F

from matchmart.llm import near_dedup
from matchmart.llm.components import components
from matchmart.llm.near_dedup import estimate, keep_one, link_block, near_digest
from matchmart.llm.shingles import lists, minima, packed, shingle_set

NO_ID = -(2**63)


@pytest.mark.parametrize("least", [85, 80])
def test_equals_brute_force(docs, space, least):
    expected = components_of(odd_rows(), least)
    rows = near_digest(docs, space, least).collect()
    assert len(rows) == len(odd_rows())
    texts = {r[0]: r[1] for r in odd_rows()}
    for r in rows:
        own = NO_ID if r.doc_id is None else r.doc_id
        assert r.n_shingles == len(shingles_of(texts[r.doc_id]))
        assert r.component_id == (None if expected[own] == NO_ID else expected[own])
        assert r.kept == (expected[own] == own)
    assert len(set(expected.values())) < len(expected) - 5


def test_chain_without_a_common_neighbour(spark, space):
    """Members of a bucket that are no neighbours of its first one are still compared."""
    words = [f"w{i}" for i in range(1000)]
    rows = [(i, " ".join(words[i * 20 : i * 20 + 400])) for i in range(25)]
    found = {r.component_id for r in near_digest(spark.createDataFrame(rows, "doc_id long, text string"), space).collect()}
    assert found == {0}


def test_large_group_in_many_blocks(spark, space, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 400)
    rng = np.random.Generator(np.random.PCG64(3))
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(60):
        copy = list(base)
        for at in rng.integers(0, 60, i % 7):
            copy[at] = f"x{rng.integers(0, 9)}"
        rows.append((i, " ".join(copy)))
    expected = components_of(rows, 85)
    found = {r.doc_id: r.component_id for r in near_digest(spark.createDataFrame(rows, "doc_id long, text string"), space).collect()}
    assert found == expected


def test_keep_one(docs, space, nothing):
    wide = docs.withColumns({"doc": F.lit("x"), "component": F.lit(1), "row": F.lit(2), "n": F.lit(3), "set_key": F.lit(4)})
    kept = keep_one(wide, space)
    assert kept.columns == wide.columns
    ids = [r.doc_id for r in kept.collect()]
    expected = components_of(odd_rows(), 85)
    assert sorted(NO_ID if i is None else i for i in ids) == sorted(set(expected.values()))
    assert keep_one(nothing, space).count() == 0
    assert near_digest(nothing, space).count() == 0


def test_estimate_corrects_chance(spark):
    rng = np.random.Generator(np.random.PCG64(1))
    pool = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    for shared in (0, 1000, 1900, 2000):
        one, other = np.unique(pool[:2000]), np.unique(pool[2000 - shared : 4000 - shared])
        planes = packed(np.stack([minima(one), minima(other)]))
        frame = spark.createDataFrame([(planes[0].tolist(), planes[1].tolist())], "a array<long>, b array<long>")
        truth = len(np.intersect1d(one, other)) / len(np.union1d(one, other))
        assert abs(frame.select(estimate(F.col("a"), F.col("b"))).first()[0] - truth) < 0.15
    assert lists(planes).to_pylist() == planes.tolist()


def test_link_block_connects_all(spark):
    sets = [np.arange(i, i + 100, dtype=np.int64) for i in range(0, 40, 4)]
    found = link_block(np.arange(10), np.arange(10), sets)
    assert len(found) == 9


def test_components(spark, space):
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (10, 9), (9, 8), (20, 20), (50, 1), (7, 8)], "a long, b long")
    assert {(r.doc, r.component) for r in components(links, space).collect()} == {(1, 1), (2, 1), (3, 1), (4, 1), (50, 1), (7, 7), (8, 7), (9, 7), (10, 7)}
    chain = spark.range(1, 400).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    assert {r.component for r in components(chain, space).collect()} == {0}


def test_short_texts_are_one_shingle():
    assert len(shingle_set(b"a b c d")) == 1
    assert len(shingle_set(b"a b c d e")) == 1
    assert set(shingle_set(b"A  b\tc d")) == set(shingle_set(b"a b c d"))
    assert set(shingle_set(b"a b")) != set(shingle_set(b"a b c"))
    assert len(shingle_set(b" \n ")) == 0


def test_ids_link_nothing(spark, space):
    """Different texts without an id, or of one id, stay apart; neither they nor their copies are lost."""
    one, two, three, four = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(None, one), (None, two), (None, two), (None, three), (5, one), (9, one), (7, two), (8, four), (8, one), (8, ""), (8, ""), (None, ""), (None, "")]
    rows += [(None, three), (3, four + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_digest(docs, space).collect()
    named = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in found)
    assert named == sorted([
        (0, 26, 5, False), (5, 26, 5, True), (8, 26, 5, False), (9, 26, 5, False), (0, 26, 7, False), (0, 26, 7, False), (7, 26, 7, True),
        (0, 26, 0, True), (0, 26, 0, False), (8, 26, 3, False), (3, 27, 3, True), (8, 0, 8, True), (8, 0, 8, True), (0, 0, 0, True), (0, 0, 0, True),
    ])
    kept = sorted((r.doc_id or 0, r.text) for r in keep_one(docs, space).collect())
    assert kept == sorted([(5, one), (7, two), (0, three), (3, four + " more"), (8, ""), (0, ""), (0, "")])


def test_texts_of_one_id_that_are_alike(spark, space):
    words = [f"w{i}" for i in range(200)]
    rows = [(4, " ".join(words)), (4, " ".join(words[1:])), (4, " ".join(words)), (6, " ".join(words[2:]))]
    assert [r.doc_id for r in keep_one(spark.createDataFrame(rows, "doc_id long, text string"), space).collect()] == [4]
