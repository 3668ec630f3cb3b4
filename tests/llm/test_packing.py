from collections import defaultdict

import numpy as np
import pytest
from odd import odd_rows, words_of
from pyspark.sql import functions as F

from matchmart.llm import queries
from matchmart.llm.packing import CLUSTER_BITS, pack_documents, pack_items


def brute(sizes, clusters, sources, capacity, per_source):
    """Best fit by looking at every bin; of equal room the one that came first among them in the order of free space."""
    bins, out = [], []
    for size, cluster, source in zip(sizes, clusters, sources, strict=True):
        fits = [b for b in bins if b["free"] >= size and cluster not in b["clusters"] and b["sources"].count(source) < per_source]
        tightest = min((b["free"] for b in fits), default=None)
        out.append(tightest)
        if tightest is None:
            bins.append({"free": capacity - size, "clusters": {cluster}, "sources": [source], "items": [len(out) - 1]})
        else:
            yield_bin = next(b for b in fits if b["free"] == tightest)
            yield_bin["free"] -= size
            yield_bin["clusters"].add(cluster)
            yield_bin["sources"].append(source)
    return out


def test_takes_the_tightest_compatible_bin():
    """Without ties in free space the choice is unique: it equals brute force item by item."""
    rng = np.random.Generator(np.random.PCG64(1))
    sizes = rng.choice(np.arange(1, 2**40, 2**27 + 1), 600, replace=False)
    sizes[::50] = 2**42
    clusters, sources = rng.integers(0, 40, 600), rng.integers(0, 3, 600)
    capacity = 2**42
    placed = pack_items(sizes, clusters, sources, capacity, 2)
    free = defaultdict(lambda: capacity)
    chosen = []
    for (number, start), size in zip(placed, sizes, strict=True):
        assert start == capacity - free[number]
        chosen.append(free[number] if number in free and free[number] < capacity else None)
        free[number] -= size
    assert chosen == brute(sizes, clusters, sources, capacity, 2)
    assert min(free.values()) >= 0


def test_more_bins_than_room_at_first():
    placed = pack_items(np.full(3000, 7), np.arange(3000) % CLUSTER_BITS, np.zeros(3000, dtype=int), 10, 4)
    assert len({b for b, _ in placed}) == 3000
    assert pack_items(np.empty(0), np.empty(0), np.empty(0)).shape == (0, 2)


def check(rows, docs, capacity, per_source):
    total, bins = defaultdict(int), defaultdict(list)
    for r in rows:
        total[r.doc_id] += r.n_tokens
        bins[r.bin_id].append(r)
        assert r.first_token == r.piece * capacity
    expected = defaultdict(int)
    for doc, text, *_ in docs:
        expected[doc] += len(words_of(text)) + 1
    assert total == expected
    texts = {d: (t or "").strip(" ").lower() for d, t, *_ in docs}
    for held in bins.values():
        held.sort(key=lambda r: r.start)
        assert [r.start for r in held] == np.cumsum([0, *(r.n_tokens for r in held)])[:-1].tolist()
        assert sum(r.n_tokens for r in held) <= capacity
        assert len({texts[r.doc_id] for r in held}) == len(held)
        assert max(sum(r.source == s for r in held) for s in {r.source for r in held}) <= per_source
    return bins


@pytest.mark.parametrize("shard", [20_000, 10])
def test_odd_rows(docs, space, nothing, shard):
    wide = docs.withColumns({"row": F.lit(1), "size": F.lit("x"), "cluster": F.lit(2), "shard": F.lit(3), "piece": F.lit(4)})
    check(pack_documents(wide, space, capacity=500, per_source=2, shard=shard).collect(), odd_rows(), 500, 2)
    assert pack_documents(nothing, space).count() == 0


def test_one_document_repeated(spark, space):
    frame = spark.createDataFrame([(1, "a b c", "s")] * 300, "doc_id long, text string, source string")
    assert pack_documents(frame, space, shard=50).select("bin_id").distinct().count() == 300


def test_query_on_given_tables(spark, small):
    rows = queries.QUERIES["op8_packing"](spark, small).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    bins = check(rows, docs, 2048, 4)
    assert sum(r.n_tokens for r in rows) / (2048 * len(bins)) > 0.85
