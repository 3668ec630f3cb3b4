"""Toxicity and quality: what they match, what they learn, and how they do on held-out rows of the given tables."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchmart.llm import queries
from matchmart.llm.quality import fit, latent_space, score_quality, shape, vote
from matchmart.llm.toxicity import Lexicon, choose, fit_lexicon, fold, score_toxicity

SF = "/root/testdata/sf0.01"


def held(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def made(spark, n=400):
    """Toxic rows hold ``vile`` or a word beginning ``grub``; bad rows are marked-up; ``vile mountain`` is harmless."""
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        words = ["w" + "".join(rng.choices("abcdefgh", k=3)) for _ in range(40)]
        toxic, good = i % 5 == 0, i % 4 != 0
        if toxic:
            words[i % 40] = "vile" if i % 2 else f"grub{chr(97 + i % 20)}x"
        elif i % 24 == 1:
            words[3:5] = ["vile", "mountain"]
        rows.append((i, " ".join(w if good else f"{w}***" for w in words)))
        labels.append((i, int(good), int(toxic)))
    return (spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_folding():
    assert fold("1D1OT") == ["idiot"]
    assert fold("id1ot, ѕсum! l0$er") == ["idiot", "scum", "loser"]
    assert fold("ｉｄｉｏｔ") == ["idiot"]
    assert fold("in 2024, 3 men") == ["in", "men"]
    assert fold("") == []


def test_hits_exceptions_and_length():
    lexicon = Lexicon({" vile ": 4.0, " gru": 3.0}, [" vile mountain "])
    assert [w for *_, w in lexicon.hits(fold("a vile grub and the vile mountain"))] == [4.0, 3.0]
    assert lexicon.hits(fold("reviled ungrub")) == []
    assert lexicon.density(fold("vile")) > lexicon.density(fold("vile " + "word " * 50))
    assert lexicon.density([]) == lexicon.density(fold("clean words"))


def test_choose_needs_evidence():
    assert choose({" bad": 3}, {}, 100, 900) == {" bad": pytest.approx(math.log(3.5 / 101) - math.log(0.5 / 901))}
    assert choose({" bad": 3, **{f" x{i}": 3 for i in range(5000)}}, {f" x{i}": 0 for i in range(10)}, 100, 900) == {}
    assert list(choose({" gru": 40, " grub": 40, " grubax ": 5}, {" gru": 3}, 100, 900)) == [" grub"]


def test_toxicity_learns(spark, space):
    docs, labels = made(spark)
    lexicon = fit_lexicon(docs, labels, space)
    assert any(p.startswith(" grub") for p in lexicon.weights)
    assert " vile mountain " in lexicon.exceptions
    scores = {r.doc_id: r["__score"] for r in score_toxicity(docs, lexicon).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert all((scores[i] >= 0.5) == (truth[i] == 1) for i in scores if held(i))


def test_quality_learns(spark, space):
    docs, labels = made(spark)
    model = fit(docs, labels, space)
    scores = {r.doc_id: r["__score"] for r in score_quality(docs, model).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all((scores[i] >= 0.3) == (truth[i] == 1) for i in scores if held(i))


@pytest.mark.parametrize("name", ["op1_quality", "op3_toxicity"])
def test_odd_rows(spark, docs, nothing, space, name, tmp_path):
    """Null and empty texts and ids get a score from 0 to 1, all rows stay, and nothing is needed to be labelled."""
    from matchmart.llm.quality import quality_digest
    from matchmart.llm.toxicity import toxicity_digest

    digest = quality_digest if name == "op1_quality" else toxicity_digest
    kind = "quality int, toxic int"
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 1), (None, 1, 1), (6, 1, None), (9, 0, 1), (12, 1, 0), (60, 1, 0)], f"doc_id long, {kind}")
    wide = docs.withColumns({"score": F.lit(1), "label": F.lit("x"), "key": F.lit(0)})
    rows = digest(wide, labels, space).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (r.doc_id is not None and held(r.doc_id)) for r in rows)
    assert len({r.score for r in rows if r.doc_id == 9}) == 1
    assert digest(nothing, labels, space).count() == 0
    none = spark.createDataFrame([], f"doc_id long, {kind}")
    assert digest(docs, none, space).count() == docs.count()


@pytest.mark.parametrize(("name", "column", "least"), [("op1_quality", "quality", 0.95), ("op3_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, name, column, least):
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.QUERIES[name](spark, SF).collect()
    assert len(rows) == 1000
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in judged]) >= least


def test_vote_equals_brute_force():
    rng = np.random.Generator(np.random.PCG64(2))
    rows, voters = rng.standard_normal((700, 12)), rng.standard_normal((90, 12))
    rows, voters = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (rows, voters))
    labels = rng.integers(0, 2, 90).astype(float)
    for i, score in enumerate(vote(rows, voters, labels, 7)):
        cosines = voters @ rows[i]
        near = np.argsort(cosines)[-7:]
        weights = np.maximum(cosines[near], 0) ** 8 + 1e-12
        assert score == pytest.approx((weights * labels[near]).sum() / weights.sum())


def test_latent_space_spans_the_leading_directions():
    rng = np.random.Generator(np.random.PCG64(2))
    data = (rng.standard_normal((200, 5)) @ rng.standard_normal((5, 60))).astype(np.float32)
    basis = latent_space(data, 5)
    assert np.allclose(data @ basis @ basis.T, data, atol=1e-3)


def test_shapes():
    assert [shape(w) for w in ("Word,", "the***", "AB12c", "|", "")] == ["Xx,", "x*", "X9x", "|", ""]
