"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Largest inner product becomes smallest distance by one more coordinate: every
vector x gets sqrt(M^2 - |x|^2), M the largest length, and a query gets 0. The
d + 1 coordinates are projected to ``DIMENSIONS`` by independent normal factors,
a 2-stable distribution: the squared projected distance of two points is their
squared distance times a chi-square variable with ``DIMENSIONS`` degrees.

All vectors are dealt to blocks of bounded size; a block's projections are
indexed by a kd-tree of leaves with bounding boxes. A query visits the leaves of
a block in the order of their projected distance and verifies their vectors
on the original coordinates. It stops when a vector nearer than the ``k``-th best
found would by now have been met with probability ``CONFIDENCE``: when the
chi-square distribution function of (projected distance of the next leaf)^2 /
(k-th best distance)^2 reaches it. The best of all blocks are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchmart.workspace import Workspace

NEAREST = 20
DIMENSIONS = 8
CONFIDENCE = 0.95
#: vectors of a block of the index, of a leaf of its tree, and queries that meet a block together
BLOCK, LEAF, QUERIES = 16_384, 32, 1024
#: leaves verified between two tests, doubling
FIRST_LEAVES = 8
SEED = 9


def chi_square(x: np.ndarray, degrees: int = DIMENSIONS) -> np.ndarray:
    """The distribution function of chi-square with an even number of degrees."""
    half, term, total = np.asarray(x, dtype=np.float64) / 2, 1.0, 0.0
    for i in range(degrees // 2):
        total = total + term
        term = term * half / (i + 1)
    return 1.0 - np.exp(-half) * total


def projection(width: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(SEED)).standard_normal((width, DIMENSIONS))


def kd_leaves(points: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Positions by leaf: the points are halved at the median of their widest coordinate until a leaf is small."""
    open_parts, leaves = [np.arange(len(points))], []
    while open_parts:
        part = open_parts.pop()
        if len(part) <= leaf:
            leaves.append(part)
            continue
        axis = np.ptp(points[part], axis=0).argmax()
        half = len(part) // 2
        order = np.argpartition(points[part, axis], half)
        open_parts += [part[order[:half]], part[order[half:]]]
    return leaves


def best_by_id(ids: np.ndarray, products: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of (ids, products), best first, ties to the smaller id; of every id the best product counts."""
    order = np.lexsort((ids, -products))
    _, first = np.unique(ids[order], return_index=True)
    taken = order[np.sort(first)[:k]]
    return ids[taken], products[taken]


class Tree:
    """A block's vectors in leaf order, with the boxes of the leaves' projections."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float):
        lift = np.sqrt(np.maximum(largest**2 - (vectors**2).sum(axis=1), 0.0))
        points = np.column_stack([vectors, lift]) @ projection(vectors.shape[1] + 1)
        leaves = kd_leaves(points)
        order = np.concatenate(leaves)
        self.ids, self.vectors = ids[order], vectors[order]
        self.leaf = np.repeat(np.arange(len(leaves)), [len(p) for p in leaves])
        self.low = np.array([points[p].min(axis=0) for p in leaves])
        self.high = np.array([points[p].max(axis=0) for p in leaves])
        self.largest = largest
        #: rows of the most frequent id
        self.repeats = int(np.unique(ids, return_counts=True)[1].max())

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, products) of the best found, best first, ties to the smaller id; an id has one place."""
        at = np.append(query, 0.0) @ projection(len(query) + 1) if len(query) else np.zeros(DIMENSIONS)
        gaps = np.maximum(np.maximum(self.low - at, at - self.high), 0.0)
        reach = (gaps**2).sum(axis=1)
        order = np.argsort(reach, kind="stable")
        best_ids, best = np.empty(0, dtype=np.int64), np.empty(0)
        done, step = 0, FIRST_LEAVES
        length = float(query @ query)
        while done < len(order):
            opened = np.zeros(len(order), dtype=bool)
            opened[order[done : done + step]] = True
            rows = np.flatnonzero(opened[self.leaf])
            rows = rows[self.ids[rows] != query_id]
            products, ids = self.vectors[rows] @ query, self.ids[rows]
            enough = k * self.repeats
            if len(rows) > 4 * enough:
                # so many rows hold k ids at least
                likely = products >= np.partition(products, -enough)[-enough]
                products, ids = products[likely], ids[likely]
            best_ids, best = best_by_id(np.concatenate([best_ids, ids]), np.concatenate([best, products]), k)
            done, step = done + step, step * 2
            if done < len(order) and len(best) == k:
                distance = max(self.largest**2 + length - 2 * best[-1], 1e-12)
                if chi_square(reach[order[done]] / distance) >= CONFIDENCE:
                    break
        return best_ids, best


def usable(vectors: DataFrame, vector: str = "embedding", name: str = "vec_id") -> DataFrame:
    """(vec_id, v) of the vectors that take part: id and vector not null, all components finite, not all zero."""
    rows = vectors.select(F.col(name).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0.0))


def nearest(vectors: DataFrame, queries: DataFrame, space: Workspace, k: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found for every query, its own id left out.

    Both tables are ``(vec_id, v)`` as ``usable`` gives them. A query's candidates
    are the vectors of its own length; every length is searched by itself. Rows
    of one id are vectors of their own as candidates and as queries; of the same
    pair of ids the best counts once. Empty tables give an empty result.
    """
    n = vectors.count()
    square = vectors.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0]
    largest = math.sqrt(square or 0.0)
    blocks, rounds = max(1, math.ceil(n / BLOCK)), max(1, math.ceil(queries.count() / QUERIES))
    width = F.size("v").alias("width")
    index = vectors.select(width, F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), "vec_id", "v")
    asked = queries.select(width, F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(rounds)).cast("int").alias("turn"), "vec_id", "v")
    # every group of queries meets every block of the index
    index = index.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1)))).withColumn("asks", F.lit(False))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("asks", F.lit(True))

    def search(group: pd.DataFrame) -> pd.DataFrame:
        held, asks = group[~group["asks"]], group[group["asks"]]
        if held.empty or asks.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        tree = Tree(held["vec_id"].to_numpy(), np.stack(held["v"].to_numpy()), largest)
        found = []
        for query_id, query in zip(asks["vec_id"], asks["v"], strict=True):
            ids, products = tree.search(int(query_id), np.asarray(query), k)
            found.append(pd.DataFrame({"query_id": int(query_id), "vec_id": ids, "score": products}))
        return pd.concat(found)

    met = index.unionByName(asked).groupBy("width", "block", "turn").applyInPandas(search, "query_id long, vec_id long, score double")
    pairs = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def search_digest(embeddings: DataFrame, space: Workspace) -> DataFrame:
    """The neighbours of the vectors whose id is divisible by 20 among all vectors."""
    vectors = space.freeze(usable(embeddings), "vectors")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), space)
