import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchmart.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """(vec_id -> (n, deviation, projections), explained) by integers and eigh."""
    kept = [(i, v) for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    ints = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in kept]
    fit = sorted({x for _, x in ints})
    n, width = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(width)]
    cross = [[sum((n * x[a] - sums[a]) * (n * x[b] - sums[b]) for x in fit) for b in range(width)] for a in range(width)]
    cov = np.array([[c / n**3 for c in row] for row in cross])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    out = []
    for i, x in ints:
        far = [n * c - s for c, s in zip(x, sums, strict=True)]
        out.append((i, n, sum(f * f for f in far), (np.array(far) / n) @ vectors / np.sqrt(values)))
    return sorted(out, key=lambda r: repr(r[:3])), values / np.trace(cov), cov


def same(spark, space, rows, close=1e-7, **extra):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = whitening.whiten(frame.withColumns(extra), space).collect()
    expected, explained, _ = plain(rows)
    k = len(explained)
    by_row = {}
    for r in found:
        by_row.setdefault((r.vec_id, r.n, r.deviation), []).append(r)
    assert len(found) == k * len(expected)
    signs = None
    for i, n, dev, projected in expected:
        copies = sorted(by_row[(i, n, dev)], key=lambda r: r.component)
        values = np.array([r.whitened for r in copies]).reshape(k, -1)
        assert [r.component for r in copies[:: len(copies) // k]] == list(range(1, k + 1))
        assert (values == values[:, :1]).all()
        signs = np.where(np.abs(projected) > 1e-3, np.sign(projected * values[:, 0]), np.nan) if signs is None else np.where(np.isnan(signs), np.where(np.abs(projected) > 1e-3, np.sign(projected * values[:, 0]), np.nan), signs)
        known = ~np.isnan(signs)
        assert np.allclose(values[known, 0], projected[known] * signs[known], rtol=close, atol=close)
        assert np.allclose([r.explained for r in copies[:: len(copies) // k]], explained, rtol=1e-6)
        assert all(r.identity_error < 1e-6 for r in copies)


def some(n, width, seed=1, scale=None):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(n, width)) @ np.diag(np.linspace(2, 0.2, width) if scale is None else scale)
    return [(i, [float(c) for c in v], 0) for i, v in enumerate(values)]


def test_equals_integers_and_eigh(spark, space):
    rows = some(300, 20)
    rows += [rows[5], (5000, rows[6][1], 1), (None, rows[7][1], None), (7001, None, 0), (7002, [0.0] * 20, 0)]
    rows += [(7003, [None, *[1.0] * 19], 0), (7004, [float("nan"), *[1.0] * 19], 0), (7005, [float("inf"), *[1.0] * 19], 0)]
    same(spark, space, rows, x=F.lit(1), width=F.lit("w"), v=F.lit(0.5), component=F.lit(3))


def test_eigenvalues_far_apart(spark, space):
    """The smallest of sixteen variances is 1e-16 of the largest; eigh alone would lose it."""
    scale = np.logspace(8, 0, 16)
    rows = some(200, 16, scale=scale)
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA), space).collect()
    assert max(r.identity_error for r in found) < 1e-6
    last = np.array([r.whitened for r in found if r.component == 12])
    assert abs(last.var() - 1) < 1e-6


def test_degenerate_tables(spark, space):
    def run(rows):
        return whitening.whiten(spark.createDataFrame(rows, SCHEMA), space).collect()

    assert run([]) == [] and run([(1, None, 0), (2, [], 0)]) == []
    one = run([(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0)])
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in sorted(one)] == [(i, c, 1, 0, None, None) for i in (1, 2) for c in (1, 2)]
    # three vectors span two dimensions, and every length stands alone
    flat = run([(1, [0.0, 0.0, 1.0], 0), (2, [1.0, 0.0, 1.0], 0), (3, [0.0, 1.0, 1.0], 0), (4, [3.0], 0), (5, [4.0], 0)])
    assert sorted(r.component for r in flat if r.vec_id == 1) == [1, 2, 3]
    assert [r.whitened is None for r in sorted(flat) if r.vec_id == 2] == [False, False, True]
    assert {r.n for r in flat if r.vec_id > 3} == {2} and {abs(r.whitened) for r in flat if r.vec_id > 3} == {1.0}


def test_planes_give_exact_products():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 2**21, size=(200, 9))
    values[:, 4] = 0
    counts = whitening.plane_products(whitening.bit_planes(values, 21))
    total = sum(counts[s].astype(object) << s for s in range(41))
    exact = values.astype(object).T @ values.astype(object)
    assert (np.triu(total) == np.triu(exact)).all()


def test_widths_in_shares(spark, space, monkeypatch):
    rows = some(60, 5) + [(1000 + i, v, 0) for i, v, _ in some(50, 3, seed=2)]
    whole = sorted(whitening.whiten(spark.createDataFrame(rows, SCHEMA), space).collect())
    monkeypatch.setattr(whitening, "MODEL_ENTRIES", 10)
    assert sorted(whitening.whiten(spark.createDataFrame(rows, SCHEMA), space).collect()) == whole


def test_deviation_beyond_64_bits(spark, space):
    rows = [(1, [1e9, 0.0], 0), (2, [0.0, 1.0], 0), (3, [0.0, 0.5], 0)]
    found = {r.vec_id: r.deviation for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA), space).collect()}
    assert found[1] is None


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_on_given_tables(spark, sf, space):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding", "label").limit(120).collect()]
    same(spark, space, rows, close=1e-6)
    assert queries.QUERIES["op13_whitening"](spark, f"/root/testdata/{sf}").count() == 500 * 16
