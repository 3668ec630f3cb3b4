"""Best-fit packing of documents into sequences of fixed capacity, under conflicts.

Documents longer than the capacity are cut into whole pieces, which fill a
sequence each, and a rest. Items are dealt by hash to shards of bounded size,
each packed by itself: items go by size, the largest first. Open bins are kept
in the order of their free space, each with bitmaps of the sources and the
duplicate clusters it holds. The search starts at the first bin with enough
room and goes on to looser ones until one is compatible - the tightest
compatible bin. Without any, the item opens a bin.

A bin takes no two items of one duplicate cluster and at most ``PER_SOURCE`` of
one source: there are that many source bitmaps, and a source is full where the
last has its bit. Clusters and sources that share a bit of the bitmaps count as
one, which may cost room but never lets a conflict through.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchmart.llm.common import ascii_lower, text_or_empty, word_count
from matchmart.workspace import Workspace

CAPACITY = 2048
PER_SOURCE = 4
#: bits of the cluster bitmap (a multiple of 64) and of each source bitmap
CLUSTER_BITS, SOURCE_BITS = 256, 64
#: items of one shard, about
SHARD = 20_000
_LOOK = 256


class OpenBins:
    """Bins in ascending order of free space."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.planes = capacity, per_source
        self.n = 0
        self._grow(1024)
        self.made = 0

    def _grow(self, room: int) -> None:
        old = self.__dict__.copy()
        self.free = np.zeros(room, dtype=np.int64)
        self.bin = np.zeros(room, dtype=np.int64)
        self.clusters = np.zeros((CLUSTER_BITS // 64, room), dtype=np.uint64)
        self.sources = np.zeros((self.planes, room), dtype=np.uint64)
        if self.n:
            for name in ("free", "bin", "clusters", "sources"):
                getattr(self, name)[..., : self.n] = old[name][..., : self.n]

    def _fit(self, size: int, cluster: int, source: int) -> int:
        """Position of the tightest compatible bin, or -1."""
        word, bit = cluster // 64, np.uint64(1) << np.uint64(cluster % 64)
        mark = np.uint64(1) << np.uint64(source)
        at = int(np.searchsorted(self.free[: self.n], size))
        while at < self.n:
            end = min(at + _LOOK, self.n)
            taken = (self.clusters[word, at:end] & bit) | (self.sources[-1, at:end] & mark)
            good = np.flatnonzero(taken == 0)
            if len(good):
                return at + int(good[0])
            at = end
        return -1

    def put(self, size: int, cluster: int, source: int) -> tuple[int, int]:
        """(bin, start) of an item."""
        at = self._fit(size, cluster, source)
        if at < 0:
            free, number = self.capacity, self.made
            self.made += 1
            clusters, sources = np.zeros(len(self.clusters), np.uint64), np.zeros(self.planes, np.uint64)
        else:
            free, number = int(self.free[at]), int(self.bin[at])
            clusters, sources = self.clusters[:, at].copy(), self.sources[:, at].copy()
        start = self.capacity - free
        clusters[cluster // 64] |= np.uint64(1) << np.uint64(cluster % 64)
        mark = np.uint64(1) << np.uint64(source)
        sources[int(np.flatnonzero((sources & mark) == 0)[0])] |= mark
        self._move(at, free - size, number, clusters, sources)
        return number, start

    def _move(self, at: int, free: int, number: int, clusters: np.ndarray, sources: np.ndarray) -> None:
        """Take the bin at ``at`` (-1: none) out and put it in again by its new free space; a full bin stays out."""
        to = int(np.searchsorted(self.free[: self.n], free))
        if at < 0:
            if not free:
                return
            if self.n == len(self.free):
                self._grow(2 * self.n)
            span, shift = slice(to, self.n), slice(to + 1, self.n + 1)
            self.n += 1
        elif not free:
            span, shift = slice(at + 1, self.n), slice(at, self.n - 1)
            self.n -= 1
        else:
            span, shift = slice(to, at), slice(to + 1, at + 1)
        for kept in (self.free, self.bin, self.clusters, self.sources):
            kept[..., shift] = kept[..., span].copy()
        if free:
            self.free[to], self.bin[to] = free, number
            self.clusters[:, to], self.sources[:, to] = clusters, sources


def pack_items(sizes: np.ndarray, clusters: np.ndarray, sources: np.ndarray, capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> np.ndarray:
    """Rows (bin, start) for items in the given order; sizes are 1 to capacity."""
    bins = OpenBins(capacity, per_source)
    return np.array([bins.put(int(s), int(c), int(o)) for s, c, o in zip(sizes, clusters, sources, strict=True)], dtype=np.int64).reshape(-1, 2)


def cluster_of_text() -> Column:
    """Copies of a text, but for case and blanks at the ends, are one cluster."""
    return F.xxhash64(ascii_lower(F.trim(text_or_empty())))


PACKED = "row long, piece int, n_tokens long, bin_id long, start long"


def pack_documents(
    docs: DataFrame, space: Workspace, capacity: int = CAPACITY, per_source: int = PER_SOURCE, cluster: Column | None = None,
    shard: int = SHARD,
) -> DataFrame:
    """Per piece of every row of ``docs`` (with doc_id, text, source): doc_id, source, piece, first_token, n_tokens, bin_id, start.

    A document has as many tokens as words and one more, its end, so none is
    empty. ``cluster`` (by default copies of the text) must be a long. A null
    source is a source of its own. Rows are packed apart even if they repeat;
    their clusters keep them in different bins. An empty table gives an empty
    result.
    """
    cluster = cluster_of_text() if cluster is None else cluster
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"), (word_count() + 1).alias("size"), cluster.alias("cluster"),
    )
    rows = space.freeze(rows, "rows")
    shards = max(1, math.ceil(rows.count() / shard))
    items = rows.select(
        "row", "size",
        F.pmod("cluster", F.lit(CLUSTER_BITS)).cast("int").alias("cluster"),
        F.pmod(F.xxhash64(F.coalesce("source", F.lit("\0"))), F.lit(SOURCE_BITS)).cast("int").alias("source"),
        F.pmod(F.xxhash64("row", "doc_id"), F.lit(shards)).cast("long").alias("shard"),
    )

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        whole, rest = group["size"] // capacity, group["size"] % capacity
        parts = group[rest > 0].assign(n=rest[rest > 0], piece=whole[rest > 0]).sort_values(["n", "row"], ascending=[False, True])
        placed = pack_items(parts["n"].to_numpy(), parts["cluster"].to_numpy(), parts["source"].to_numpy(), capacity, per_source)
        bins = int(placed[:, 0].max(initial=-1)) + 1
        full = group.loc[group.index.repeat(whole)]
        pieces = np.concatenate([np.arange(w) for w in whole]) if len(full) else np.empty(0, dtype=np.int64)
        out = pd.concat([
            pd.DataFrame({"row": parts["row"], "piece": parts["piece"], "n_tokens": parts["n"], "bin_id": placed[:, 0], "start": placed[:, 1]}),
            pd.DataFrame({"row": full["row"], "piece": pieces, "n_tokens": capacity, "bin_id": bins + np.arange(len(full)), "start": 0}),
        ])
        return out.assign(bin_id=out["bin_id"] + (int(group["shard"].iloc[0]) << 32))

    packed = items.groupBy("shard").applyInPandas(pack, PACKED)
    return packed.join(rows.select("row", "doc_id", "source"), "row").select(
        "doc_id", "source", "piece", (F.col("piece") * F.lit(capacity)).cast("long").alias("first_token"), "n_tokens", "bin_id", "start"
    )
