import math
import zlib
from collections import Counter

import numpy as np
import pytest
from odd import odd_rows, words_of
from pyspark.sql import functions as F

from matchmart.llm import queries
from matchmart.llm.class_model import ENDINGS, ClassModel, Types, best_class, language_digest, tokens_of, train


def aside(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def check_base(rows, found):
    counts = Counter()
    for r in rows:
        if not aside(r[0]):
            counts.update(words_of(r[1]))
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for r in rows:
        tokens = [*words_of(r[1]), None]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        expected[(r[0], aside(r[0]), len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == expected


def test_counts_and_base_score(docs, space):
    found = language_digest(docs.withColumns({"row": F.lit(1), "keys": F.lit("x"), "c": F.lit(2)}), space).collect()
    check_base(odd_rows(), found)
    assert all(-1e9 < r.score < 0 for r in found)


def test_empty_tables(spark, nothing, space):
    assert language_digest(nothing, space).count() == 0
    only = [i for i in range(100) if aside(i)][:2]
    found = language_digest(spark.createDataFrame([(only[0], "a b"), (only[1], None)], "doc_id long, text string"), space).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found} == {(3, 0, 0, 0.0), (1, 0, 0, 0.0)}


def test_best_class_is_the_largest_gain():
    """The move chosen is the one that brute force over all classes finds best, on counts of a small text."""
    rng = np.random.Generator(np.random.PCG64(5))
    kinds, classes = 12, np.array([0, *rng.integers(1, 5, 11)])
    pairs = rng.integers(0, 6, (kinds, kinds)).astype(float)
    np.fill_diagonal(pairs, 0)
    pairs = pairs + pairs.T  # as many tokens before as after

    def likelihood(own):
        table = np.zeros((5, 5))
        np.add.at(table, (own[:, None], own[None, :]), pairs)
        size = table.sum(axis=1)
        return sum(v * math.log(v) for v in table.flat if v) - 2 * sum(v * math.log(v) for v in size if v)

    table = np.zeros((5, 5))
    np.add.at(table, (classes[:, None], classes[None, :]), pairs)
    for kind in range(1, kinds):
        right = np.array([pairs[kind, classes == c].sum() for c in range(5)])
        left = np.array([pairs[classes == c, kind].sum() for c in range(5)])
        to = best_class(right, left, classes[kind], int(right.sum()), table, table.sum(axis=1))
        gains = {}
        for c in range(1, 5):
            own = classes.copy()
            own[kind] = c
            gains[c] = likelihood(own)
        assert gains[to] == pytest.approx(max(gains.values()))


def test_probabilities_sum_to_one(docs, space):
    """After any class: over the frequent words, and over the seen words and the unseen place of every ending."""
    model, rare = train(docs.select(F.coalesce("text", F.lit("")).alias("text")), space, rounds=2)
    assert isinstance(model, ClassModel)
    counts = {r.key: r.c for r in rare.collect()}
    by_type = Counter()
    from matchmart.llm.class_model import ending, word_hash

    words = {w for r in odd_rows() for w in tokens_of(r[1] or "")}
    for w in words:
        if word_hash(w) in counts:
            by_type[1 + ending(w)] += counts[word_hash(w)] + 1
    emission, inside = 10.0**model.emission, 10.0**model.inside
    total = np.zeros(len(model.bigrams))
    for kind, own in enumerate(model.classes):
        share = emission[kind] if kind == 0 or kind > ENDINGS else emission[kind] * (by_type[kind] + 1) / inside[kind]
        total[own] += share
    used = np.unique(model.classes)
    assert np.allclose(total[used], 1.0)
    assert np.allclose((10.0**model.transition).sum(axis=1), 1.0)


def test_types_forget_and_survive_pickling():
    import pickle

    types = pickle.loads(pickle.dumps(Types([b"the", b"of"])))
    assert types[b"the"] == 1 + ENDINGS and types.size == 3 + ENDINGS
    assert types.sequence([b"of", b"zzz", b"zzz"]).tolist() == [2 + ENDINGS, types[b"zzz"], types[b"zzz"]]


def test_better_than_the_base_on_held_out_rows(spark):
    rows = queries.QUERIES["op10_class_model"](spark, "/root/testdata/sf0.01").collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    check_base(docs, rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 0.1 * sum(r.n_tokens for r in out)
