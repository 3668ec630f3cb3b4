import hashlib

import numpy as np
import pytest
from odd import odd_rows
from pyspark.sql import functions as F

from matchmart.llm import queries
from matchmart.llm.fingerprints import RADIUS, block_tables, edited, fingerprint, fingerprint_digest, likeness, search_fingerprints

NO_ID = -(2**63)


def test_equals_brute_force(docs, space):
    order = sorted((NO_ID if r[0] is None else r[0], r[1] or "") for r in odd_rows())
    expected = []
    for i, (doc, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        n = len(text) // 4
        new = text[: len(text) - n] + following[:n]
        one, two, three = fingerprint(text), fingerprint(new), fingerprint(following)
        expected.append((None if doc == NO_ID else doc, len(text), hashlib.sha256(new.encode()).hexdigest(), one.hex(), two.hex(), likeness(one, two), likeness(one, three)))
    found = [tuple(r)[:7] for r in fingerprint_digest(docs.withColumns({"part": F.lit(1), "guest": F.lit(2), "at": F.lit(3)}), space).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_empty_and_single(spark, nothing, space):
    assert fingerprint_digest(nothing, space).count() == 0
    only = fingerprint_digest(spark.createDataFrame([(5, "one two three four")], "doc_id long, text string"), space).first()
    assert only.near_next == 1.0 and only.n_chars == 18
    assert only.edited_sha256 == hashlib.sha256(b"one two three one ").hexdigest()


def test_likeness_orders_texts():
    rng = np.random.Generator(np.random.PCG64(1))
    words = [f"w{i}" for i in range(500)]
    text, other = " ".join(rng.choice(words, 200)), " ".join(rng.choice(words, 200))
    assert likeness(fingerprint(text), fingerprint(text)) == 1.0
    assert likeness(fingerprint(text), fingerprint(edited(text, other))) > likeness(fingerprint(text), fingerprint(other)) + 0.2
    assert fingerprint("") != fingerprint("x") and len(fingerprint("")) == 16


@pytest.mark.parametrize("radius", [0, 3, 4, RADIUS, 21])
def test_search_finds_all_within_the_radius(spark, space, radius):
    rng = np.random.Generator(np.random.PCG64(1))
    base = [int.from_bytes(rng.bytes(16)) for _ in range(20)] + [0, 2**128 - 1]
    near = [b ^ sum(1 << int(i) for i in rng.choice(128, k, replace=False)) for b in base for k in range(25)]
    # same upper half, other lower one: the halves are joined by the upper
    near += [b ^ 0xFFFF for b in base]
    frame = spark.createDataFrame([(f"{v:032x}",) for v in base + near] + [(None,)], "fingerprint string")
    asks = spark.createDataFrame([(f"{v:032x}",) for v in base + near[-5:]], "fingerprint string")
    rows = [(r.fingerprint, r.found, r.distance) for r in search_fingerprints(frame, asks, space, radius).collect()]
    asked = {*base, *near[-5:]}
    expected = {(f"{a:032x}", f"{b:032x}", (a ^ b).bit_count()) for a in asked for b in {*base, *near} if (a ^ b).bit_count() <= radius}
    assert set(rows) == expected and len(rows) == len(expected)


def test_the_join_makes_pairs_of_the_result_only(spark, space):
    """A group of near copies shares keys in several tables; each of its pairs is made once."""
    group = spark.createDataFrame([(f"{1 << i:032x}",) for i in range(128)] + [(f"{0:032x}",)], "fingerprint string")
    text = search_fingerprints(group, group, space)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in text.splitlines() if "Join" in line]
    assert len(joins) == 1 and "held_low" in joins[0] and "shiftright(key" in joins[0]


def test_tables_cover_every_radius(spark, space, nothing):
    for radius in range(48):
        tables = block_tables(radius)
        assert sum(flips + 1 for _, _, flips in tables) >= radius + 1 and max(end - first for first, end, _ in tables) <= 32
    prints = fingerprint_digest(nothing, space)
    for radius in (-1, 48):
        with pytest.raises(ValueError, match="radius"):
            search_fingerprints(prints, prints, space, radius)


def test_near_copies_are_within_the_radius():
    """Texts of 200 words of which five are others; unrelated texts are far away."""
    rng = np.random.Generator(np.random.PCG64(3))
    words = np.array([f"w{i}" for i in range(5000)])
    near = far = 0
    for _ in range(100):
        text = rng.choice(words, 200)
        copy = text.copy()
        copy[rng.choice(200, 5, replace=False)] = rng.choice(words, 5)
        one, two, other = (int.from_bytes(fingerprint(" ".join(t))) for t in (text, copy, rng.choice(words, 200)))
        near += (one ^ two).bit_count() <= RADIUS
        far += (one ^ other).bit_count() <= RADIUS
    assert near >= 90 and far == 0


def test_query_on_given_tables(spark, small):
    rows = queries.QUERIES["op7_fingerprints"](spark, small).collect()
    prints = [int(r.fingerprint, 16) for r in rows]
    assert len(rows) == 200
    for r in rows:
        if r.doc_id % 50 == 0:
            assert r.n_within == sum((int(r.fingerprint, 16) ^ p).bit_count() <= RADIUS for p in prints)
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.97
