import numpy as np
import pytest

from matchmart.llm import queries, vector_search
from matchmart.llm.vector_search import Tree, chi_square, kd_leaves, nearest, search_digest, usable


def exact(ids, vectors, query_id, query, k=20):
    products = vectors @ query
    others = [(-p, i) for p, i in zip(products, ids, strict=True) if i != query_id]
    return [(i, -p) for p, i in sorted(others)[:k]]


def recall(rows, ids, vectors, queries_):
    found = {}
    for r in rows:
        found.setdefault(r.query_id, []).append(r)
    hits = total = 0
    for i in queries_:
        truth = exact(ids, vectors, i, vectors[ids.index(i)])
        own = sorted(found[i], key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, len(truth) + 1))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        hits += len({r.vec_id for r in own} & {i for i, _ in truth})
        total += len(truth)
    return hits / total


@pytest.mark.parametrize("lengths", [False, True])
def test_recall_and_exact_scores(spark, space, lengths, monkeypatch):
    monkeypatch.setattr(vector_search, "BLOCK", 700)
    monkeypatch.setattr(vector_search, "QUERIES", 30)
    rng = np.random.Generator(np.random.PCG64(1))
    centres = rng.standard_normal((20, 24))
    data = (centres[rng.integers(0, 20, 2000)] + 0.4 * rng.standard_normal((2000, 24))).astype(np.float32)
    data = data * rng.uniform(0.5, 2, (2000, 1)).astype(np.float32) if lengths else data / np.linalg.norm(data, axis=1, keepdims=True)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<float>")
    rows = search_digest(frame, space).collect()
    full = data.astype(np.float64)
    assert recall(rows, list(range(2000)), full, range(0, 2000, 20)) >= 0.9
    assert all(r.score == pytest.approx(float(full[r.query_id] @ full[r.vec_id]), rel=1e-12) for r in rows)


def test_stops_early():
    rng = np.random.Generator(np.random.PCG64(2))
    data = np.concatenate([rng.standard_normal((3000, 16)) * 5, rng.standard_normal((40, 16)) * 0.01 + 9])
    tree = Tree(np.arange(len(data)), data, float(np.sqrt((data**2).sum(axis=1).max())))
    seen = []
    whole, tree.vectors = tree.vectors, type("Seen", (), {"__getitem__": lambda self, rows: (seen.extend(rows), whole[rows])[1]})()
    ids, _ = tree.search(3005, data[3005], 5)
    assert set(ids) <= set(range(3000, 3040)) and len(seen) < 1500


def test_rows_that_take_no_part(spark, space):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [inf, 1.0]), (None, [1.0, 1.0]), (7, []),
            (20, [0.0, 1.0]), (8, [0.5, 0.5]), (8, [0.5, 0.5]), (40, [1.0, 0.0])]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, block int, score int")
    found = [tuple(r) for r in search_digest(frame, space).orderBy("query_id", "rank").collect()]
    assert found[:4] == [(0, 1, 40, 1.0), (0, 2, 1, 0.5), (0, 3, 8, 0.5), (0, 4, 20, 0.0)]
    assert {f[0] for f in found} == {0, 20, 40} and len(found) == 12
    assert search_digest(frame.limit(0), space).count() == 0
    none = usable(frame.where("vec_id = 1"))
    assert nearest(none, none.limit(0), space).count() == 0


@pytest.mark.parametrize("block", [16_384, 150])
def test_repeated_rows_take_one_place(spark, space, block, monkeypatch):
    """As many neighbours as without the repeated rows, the query's own copies included."""
    monkeypatch.setattr(vector_search, "BLOCK", block)
    data = np.random.Generator(np.random.PCG64(4)).standard_normal((300, 12))
    rows = [(i, v.tolist()) for i, v in enumerate(data) for _ in range(40 if i in (0, 20) else 3)]
    found = search_digest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), space).collect()
    assert recall(found, list(range(300)), data, range(0, 300, 20)) >= 0.9
    assert len(found) == 15 * 20


def test_leaves_hold_every_point_once():
    points = np.random.Generator(np.random.PCG64(3)).standard_normal((1000, 8))
    points[:300] = 1.0
    leaves = kd_leaves(points, 32)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(1000)) and max(map(len, leaves)) <= 32


def test_chi_square():
    draws = (np.random.Generator(np.random.PCG64(3)).standard_normal((200_000, 8)) ** 2).sum(axis=1)
    for x in (1.0, 5.0, 8.0, 15.0):
        assert chi_square(x) == pytest.approx((draws <= x).mean(), abs=0.01)


def test_query_on_given_tables(spark, small):
    rows = queries.QUERIES["op9_vector_search"](spark, small).collect()
    table = sorted((r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect())
    ids = [i for i, _ in table]
    assert recall(rows, ids, np.array([v for _, v in table], dtype=np.float64), [i for i in ids if i % 20 == 0]) >= 0.9


def test_every_length_is_searched_by_itself(spark, space):
    """A stray vector of another length affects only itself; each length equals brute force."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in rng.normal(size=2)]) for i in range(60)] + [(100 + i, [float(c) for c in rng.normal(size=5)]) for i in range(30)]
    rows += [(200, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in search_digest(frame, space).collect()}
    expected = {}
    for q, v in rows:
        if q % 20 == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q and len(w) == len(v))[:20]
            expected |= {(q, n + 1): (i, -s) for n, (s, i) in enumerate(near)}
    assert found.keys() == expected.keys() and len({q for q, _ in found}) == 5
    assert all(found[k][0] == expected[k][0] and abs(found[k][1] - expected[k][1]) < 1e-12 for k in expected)
