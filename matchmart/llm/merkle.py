"""Merkle manifest of a table: ternary hash trees in van Emde Boas layout.

Every source is a tree over its documents in the order of their ids, and the
sources' roots are the leaves of one more tree. A tree is cut into aligned
subtrees of ``HEIGHT`` levels of runs. A subtree is one array of digests, laid
out by splitting it at half its height, the upper half first, then the lower
subtrees one after the other, each split in the same way; the address of a node
is arithmetic on its depth and place. The roots of the subtrees of one round are
the leaves of the next, so a tree of any size takes logarithmically many rounds,
and no task holds more than one subtree of a tree.

Sibling retrieval goes down the same rounds: what is above a subtree is found
once for it and handed to all its leaves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache, reduce
from hashlib import sha256
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchmart.workspace import Workspace

ARITY = 3
#: levels of runs in one stored subtree: at most 3**6 = 729 leaves
HEIGHT = 6
WIDTH = ARITY**HEIGHT
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# --- layout ------------------------------------------------------------------


def nodes_in(levels: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return (ARITY**levels - 1) // (ARITY - 1)


@cache
def _addresses(depth: int, levels: int) -> np.ndarray:
    return address(depth, np.arange(ARITY**depth), levels)


def address(depth: int, place: np.ndarray, levels: int) -> np.ndarray:
    """Where the nodes of a depth (the root's is 0) stand in the array of a complete tree of ``levels`` levels."""
    if levels == 1:
        return np.zeros_like(place)
    upper = levels // 2
    lower = levels - upper
    if depth < upper:
        return address(depth, place, upper)
    subtree, within = np.divmod(place, ARITY ** (depth - upper))
    return nodes_in(upper) + subtree * nodes_in(lower) + address(depth - upper, within, lower)


def digest_of(parts: list[bytes]) -> bytes:
    """The digest of digests, concatenated as lower-case hexadecimal text."""
    return sha256(b"".join(parts).hex().encode()).digest()


def subtree(leaves: list[bytes], height: int) -> np.ndarray:
    """All nodes above and including the leaves, ``height`` levels of runs high; nodes that do not exist are zeros."""
    levels = height + 1
    nodes = np.zeros((nodes_in(levels), DIGEST), dtype=np.uint8)
    row = leaves
    for depth in range(height, -1, -1):
        nodes[_addresses(depth, levels)[: len(row)]] = np.frombuffer(b"".join(row), dtype=np.uint8).reshape(-1, DIGEST)
        row = [digest_of(row[i : i + ARITY]) for i in range(0, len(row), ARITY)]
    return nodes


def siblings(nodes: np.ndarray, height: int, n_leaves: int) -> list[list[bytes]]:
    """Per leaf one step for each level, upwards: the place in the run (a byte) and the digests of the others of the run."""
    levels = height + 1
    steps: list[list[bytes]] = []
    count = n_leaves
    for depth in range(height, 0, -1):
        row = nodes[_addresses(depth, levels)[:count]].tobytes()
        own = []
        for place in range(count):
            at = place % ARITY
            start, end = DIGEST * (place - at), DIGEST * min(count, place - at + ARITY)
            own.append(bytes([at]) + row[start : DIGEST * place] + row[DIGEST * (place + 1) : end])
        steps.append(own)
        count = -(-count // ARITY)
    return [[own[leaf // ARITY**k] for k, own in enumerate(steps)] for leaf in range(n_leaves)]


def fold(leaf: bytes, path: list[bytes]) -> bytes:
    """The root that a leaf and the steps of its path give."""
    for step in path:
        at, others = step[0], step[1:]
        cut = at * DIGEST
        leaf = digest_of([others[:cut], leaf, others[cut:]])
    return leaf


# --- leaves ------------------------------------------------------------------


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(**other: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[_field(other.get(c, F.col(c))) for c in FIELDS]), 256))


def tampered(text: Column) -> Column:
    """The text that a tampered document has: without its line feeds where 2 divides the crc32 of the id's text."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(hit & text.contains("\n"), F.replace(text, F.lit("\n"), F.lit("")))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, changed): the digest of every row, and that of its tampered form where there is one.

    ``tree`` is the source; null is the first in the order of trees.
    """
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))
    other = tampered(F.col("text"))
    return docs.select(*FIELDS).select(
        tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), _leaf().alias("leaf"),
        F.when(other.isNotNull(), _leaf(text=other)).alias("changed"),
    )


# --- building ----------------------------------------------------------------


def _numbered(rows: DataFrame, order: list[str], space: Workspace) -> DataFrame:
    """``rows`` with their position ``at`` in the tree and the tree's ``total``.

    Rows are sorted into ranges over all trees, so one large tree spreads over
    many tasks; ``row`` breaks ties, so no range holds all copies of a row. Where
    a tree begins in a range is a sum over the ranges before it.
    """
    rows = space.freeze(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["tree", *order, "row"]
    ranged = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("row")
    ranged = space.freeze(ranged.withColumn("seq", F.monotonically_increasing_id()), "sorted")
    ranged = ranged.withColumn("part", F.shiftright("seq", 33))
    of_tree = Window.partitionBy("tree")
    starts = ranged.groupBy("tree", "part").agg(F.min("seq").alias("first"), F.count("*").alias("n"))
    starts = starts.select(
        "tree", "part", "first", F.sum("n").over(of_tree).alias("total"),
        F.coalesce(F.sum("n").over(of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
    )
    placed = ranged.join(space.freeze(starts, "starts"), ["tree", "part"])
    return placed.withColumn("at", F.col("seq") - F.col("first") + F.col("before")).drop("seq", "part", "first", "before")


def _runs_above(total: Column) -> Column:
    """Levels of runs over so many leaves."""
    return reduce(add, [(total > ARITY**k).cast("int") for k in range(40)])


_STORED = "tree string, block long, total long, height int, n_leaves int, nodes binary, top binary"


def _build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with ``leaves`` and ``height`` to the stored subtree and its root; payloads pass."""
    for batch in batches:
        given = batch.column("leaves").to_pylist()
        built = [subtree(row, h) for row, h in zip(given, batch.column("height").to_pylist(), strict=True)]
        columns = {c: batch.column(c) for c in ("tree", "block", "total", "height")}
        columns["n_leaves"] = pa.array([len(g) for g in given], pa.int32())
        columns["nodes"] = pa.array([b.tobytes() for b in built], pa.binary())
        columns["top"] = pa.array([b[0].tobytes() for b in built], pa.binary())  # the root is the first of the layout
        if "payload" in batch.schema.names:
            columns["payload"] = batch.column("payload")
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


@dataclass
class Forest:
    """Stored subtrees by round, the lowest first, and one root per tree."""

    rounds: list[DataFrame]
    roots: DataFrame


def plant(rows: DataFrame, space: Workspace) -> Forest:
    """The trees over ``(tree, total, at, leaf, payload)``; payloads stay beside the subtree of their leaf."""
    most = rows.agg(F.max(_runs_above(F.col("total")))).first()[0] or 0
    rounds: list[DataFrame] = []
    for done in range(0, max(1, most), HEIGHT):
        left = _runs_above(F.col("total")) - done
        carried = ["leaf", "payload"] if not done else ["leaf"]
        inside = (rows.where(left > 0) if done else rows).groupBy("tree", F.floor(F.col("at") / WIDTH).cast("long").alias("block")).agg(
            F.first("total").alias("total"), F.array_sort(F.collect_list(F.struct("at", F.struct(*carried).alias("of")))).alias("run")
        )
        inside = inside.select(
            "tree", "block", "total", F.least(F.lit(HEIGHT), left).alias("height"), F.col("run.of.leaf").alias("leaves"),
            *([] if done else [F.col("run.of.payload").alias("payload")]),
        )
        extra = "" if done else f", payload {inside.schema['payload'].dataType.simpleString()}"
        rounds.append(space.freeze(inside.mapInArrow(_build, _STORED + extra), "subtrees"))
        rows = rounds[-1].select("tree", "total", F.col("block").alias("at"), F.col("top").alias("leaf"))
    ends = [r.where(_ends_in(i)).select("tree", F.col("top").alias("root")) for i, r in enumerate(rounds)]
    return Forest(rounds, reduce(DataFrame.union, ends))


def _ends_in(i: int) -> Column:
    """Whether a tree's root is made in round ``i``."""
    height = _runs_above(F.col("total"))
    return (height <= HEIGHT * (i + 1)) & (height > HEIGHT * i if i else F.lit(True))


# --- proving -----------------------------------------------------------------


def _descend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stored subtrees with the path above them to one row per leaf with its whole path; notes and payloads pass."""
    for batch in batches:
        at, leaves, paths, of = [], [], [], []
        for i, (block, height, n, nodes, above) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("block", "height", "n_leaves", "nodes", "above")), strict=True)):
            table = np.frombuffer(nodes, dtype=np.uint8).reshape(-1, DIGEST)
            at += range(block * WIDTH, block * WIDTH + n)
            leaves += map(bytes, table[_addresses(height, height + 1)[:n]])
            paths += [own + above for own in siblings(table, height, n)]
            of += [i] * n
        columns = {c: batch.column(c).take(pa.array(of, pa.int64())) for c in ("tree", "note")}
        columns |= {"at": pa.array(at, pa.int64()), "leaf": pa.array(leaves, pa.binary()), "path": pa.array(paths, pa.list_(pa.binary()))}
        if "payload" in batch.schema.names:
            columns["payload"] = batch.column("payload").flatten()
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def descend(forest: Forest, above: DataFrame, space: Workspace) -> DataFrame:
    """(tree, note, at, leaf, path, payload) of every leaf; ``above`` has the path and a note for each tree as a whole."""
    found = None
    note = above.schema["note"].dataType.simpleString()
    for i in reversed(range(len(forest.rounds))):
        stored = forest.rounds[i].drop("top")
        over = stored.where(_ends_in(i)).join(above.select("tree", "note", F.col("path").alias("above")), "tree")
        if found is not None:
            lower = found.select("tree", F.col("at").alias("block"), "note", F.col("path").alias("above"))
            over = over.unionByName(stored.where(~_ends_in(i)).join(lower, ["tree", "block"]))
        schema = f"tree string, note {note}, at long, leaf binary, path array<binary>"
        if i == 0:
            schema += f", payload {stored.schema['payload'].dataType.elementType.simpleString()}"
        found = over.mapInArrow(_descend, schema)
        if i:
            found = space.freeze(found, "paths")
    return found


@dataclass
class Manifest:
    """One tree per source, and the tree over the sources."""

    sources: Forest
    whole: Forest


def build_manifest(docs: DataFrame, space: Workspace) -> Manifest:
    """Rows of one id are ordered by their digests; a null id is the first of its source. An empty table has no root."""
    numbered = _numbered(leaves(docs), ["doc_id", "leaf"], space)
    numbered = space.freeze(numbered.select("tree", "total", "at", "leaf", F.struct("doc_id", "changed").alias("payload")), "numbered")
    sources = plant(numbered, space)
    one = sources.roots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("root").alias("leaf"))
    top = _numbered(one, ["source"], space).select("tree", "total", "at", "leaf", F.struct("source").alias("payload"))
    return Manifest(sources, plant(space.freeze(top, "top"), space))


def prove(manifest: Manifest, space: Workspace) -> DataFrame:
    """Per row: doc_id, leaf, changed, subroot, root and ``path``, the steps from the leaf to the root.

    A step is one byte, the place in the run, and the digests of the others of the run, left to right.
    """
    start = manifest.whole.roots.select("tree", F.array().cast("array<binary>").alias("path"), F.struct("root").alias("note"))
    upper = descend(manifest.whole, start, space)
    upper = upper.select(F.col("payload.source").alias("tree"), "path", F.struct(F.col("leaf").alias("subroot"), "note.root").alias("note"))
    steps = descend(manifest.sources, space.freeze(upper, "upper"), space)
    return steps.select("payload.doc_id", "leaf", "payload.changed", "note.subroot", "note.root", "path")


_CHECKED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_TYPES = [pa.int64(), *[pa.string()] * 5, pa.bool_()]


def _check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _CHECKED.split(", ")]
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "leaf", "changed", "subroot", "root", "path")]
        out = []
        for doc, leaf, changed, subroot, root, path in zip(*columns, strict=True):
            folded = fold(changed or leaf, path)
            proof = digest_of([step[1:] for step in path])
            out.append((doc, leaf.hex(), subroot.hex(), root.hex(), proof.hex(), folded.hex(), folded == root))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)], names=names)


def manifest_digest(docs: DataFrame, space: Workspace) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256 (of the untampered table), folded_root and verified (with tampered leaves)."""
    return prove(build_manifest(docs, space), space).mapInArrow(_check, _CHECKED)
