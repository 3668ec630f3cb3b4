"""Near-duplicates by b-bit MinHash.

1. Every text becomes its shingle set, 192 minima, 38 band keys of 5 minima each,
   and a signature of the 4 low bits of every minimum.
2. Equal sets are one class, represented by its first row. All further work is
   on representatives, and ids take no part in it: a node is a class of texts.
3. Representatives that share a band key are candidates. In every band bucket all
   members are paired with the bucket's first one only, so a bucket gives as
   many pairs as members. Bit counts on the packed signatures estimate the
   similarity, corrected for low bits that agree by chance; pairs six standard
   errors below the threshold go, the rest are confirmed on full sets.
4. The links give components. A bucket whose members are all in one component
   has nothing more to tell. In the others members of different components are
   still compared with each other, in blocks of bounded size that hold the full
   sets; each block gives at most one link per member. No pair above the
   threshold that meets in a bucket is lost.
5. Components of all links, copied to the members of every class and named by
   their smallest id; null where none of their rows has one.

A pair of similarity 0.85 shares no band with probability 2.1e-10, one of 0.8 with 2.8e-7.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchmart.llm.common import NO_ID, text_or_empty
from matchmart.llm.components import components
from matchmart.llm.shingles import BITS, PLANE_LONGS, SIGNATURE, SLOTS, shingle_set, signatures
from matchmart.workspace import Workspace

#: links have 100 * intersection >= LEAST * union
LEAST = 85
_CHANCE = 0.5**BITS
#: shingles of one block of a bucket
BLOCK_SHINGLES = 1_000_000


def estimate(one: Column, other: Column) -> Column:
    """Similarity of two packed signatures: the share of equal minima, without those equal by chance."""
    differ = F.lit(0)
    for i in range(PLANE_LONGS):
        bits = F.lit(0).cast("long")
        for plane in range(BITS):
            at = plane * PLANE_LONGS + i
            bits = bits.bitwiseOR(F.get(one, F.lit(at)).bitwiseXOR(F.get(other, F.lit(at))))
        differ = differ + F.bit_count(bits)
    return ((1 - differ / F.lit(float(SLOTS))) - _CHANCE) / (1 - _CHANCE)


def lowest_estimate(least: int) -> float:
    """Six standard errors below the threshold: estimates under this are rejected."""
    agree = least / 100 + (1 - least / 100) * _CHANCE
    return least / 100 - 6 * (agree * (1 - agree) / SLOTS) ** 0.5 / (1 - _CHANCE)


def _enough(shared: Column, one: Column, other: Column, least: int) -> Column:
    return 100 * shared >= least * (one + other - shared)


def _full_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text) to (doc, shingles)."""
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            sets = [shingle_set(t.as_py()).view(np.int64) for t in part.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(sets, pa.list_(pa.int64()))], names=["doc", "shingles"])


def link_block(docs: np.ndarray, parts: np.ndarray, sets: list[np.ndarray], least: int = LEAST) -> list[tuple[int, int]]:
    """Links between documents of different components ``parts``; enough of them to connect all that are linked.

    Members of the most frequent component are not compared among themselves.
    Shared shingles are counted through an inverted list over the block.
    """
    names, part = np.unique(parts, return_inverse=True)
    root = np.arange(len(names))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    sizes = np.array([len(s) for s in sets])
    everything = np.concatenate(sets)
    order = np.argsort(everything, kind="stable")
    holders = np.repeat(np.arange(len(sets)), sizes)[order]
    values, first = np.unique(everything[order], return_index=True)
    ends = np.append(first[1:], len(order))
    largest = np.bincount(part).argmax()
    found = []
    for x in np.flatnonzero(part != largest):
        at = np.searchsorted(values, sets[x])
        shared = np.bincount(np.concatenate([holders[first[i] : ends[i]] for i in at]), minlength=len(sets))
        linked = np.flatnonzero(100 * shared >= least * (sizes[x] + sizes - shared))
        for y in linked:
            one, other = find(part[x]), find(part[y])
            if one != other:
                root[max(one, other)] = min(one, other)
                found.append((int(docs[x]), int(docs[y])))
    return found


def _open_buckets(entries: DataFrame, about: DataFrame, space: Workspace) -> DataFrame:
    """Entries ``(band, doc, n_shingles, component)`` of buckets where members of different components were not compared."""
    placed = space.freeze(entries.join(about, "doc"), "placed")
    state = placed.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"),
        F.sum("n_shingles").alias("weight"), F.sum(F.xxhash64("doc").cast("decimal(38,0)")).alias("members"),
    )
    # two members were compared as leader and member; buckets of the same members are one
    still = state.where((F.col("low") != F.col("high")) & (F.col("n") > 2))
    once = still.groupBy("members", "n").agg(F.min("band").alias("band"), F.first("weight").alias("weight"))
    return placed.join(space.freeze(once.select("band", "weight"), "open"), "band")


def _compare_rest(entries: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Links (a, b) inside open buckets, block by block."""
    blocks = F.ceil(F.col("weight") / BLOCK_SHINGLES).cast("int")
    own = F.pmod(F.xxhash64("doc", F.lit(3)), blocks).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("own", j).alias("i"), F.greatest("own", j).alias("j")))
    spread = entries.withColumn("blocks", blocks).withColumn("own", own).select("band", "doc", "component", F.explode(meets).alias("block"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc").drop_duplicates("doc")
        found = link_block(group["doc"].to_numpy(), group["component"].to_numpy(), [np.asarray(s) for s in group["shingles"]], least)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return spread.join(sets, "doc").groupBy("band", "block").applyInPandas(compare, "a long, b long")


def _print(text: Column) -> Column:
    """128 bits that tell texts apart."""
    return F.unhex(F.md5(text.cast("binary")))


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))


class Rows:
    """The rows of ``docs`` under a number of their own, ``row``.

    Whole rows move once, into a table bucketed by that number: joins with
    tables of row numbers, to pick texts or to keep rows, leave them where they
    are. Numbers are unique, so no key that many rows share gathers them.
    """

    def __init__(self, docs: DataFrame, space: Workspace):
        self.spark = docs.sparkSession
        self.columns = docs.columns
        name = f"rows_{uuid.uuid4().hex}"
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        numbered = docs.select(F.monotonically_increasing_id().alias("row"), _doc().alias("doc"), text_or_empty().alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("other"), F.col("text").isNull().alias("no_text"))
        numbered.repartition(parts, "row").write.bucketBy(parts, "row").option("path", space.path(name)).saveAsTable(name)
        self.table = self.spark.table(name)

    def without(self, gone: DataFrame) -> DataFrame:
        """The rows of ``docs`` whose number is not in ``gone``."""
        kept = self.table.join(gone, "row", "left_anti")
        text = F.when(~F.col("no_text"), F.col("text")).alias("text")
        return kept.select(*[text if c == "text" else F.col("other").getField(c).alias(c) for c in self.columns])


def link_documents(docs: DataFrame, space: Workspace, least: int = LEAST, rows: Rows | None = None) -> DataFrame:
    """(doc, print, n_shingles, row, group, component, first) for every row of ``docs``, with at least (doc_id, text).

    ``doc`` is doc_id or, for null, the smallest 64-bit integer. Rows are linked by
    their texts alone: neither a shared nor a missing id links anything. ``group``
    tells components apart, ``component`` is the smallest id of its rows (the
    smallest integer where all are null), and ``first`` its first ``row``. Texts
    without words have no shingles and no group, and their component is their own
    id. A text of fewer words than a shingle is one shingle.
    """
    texts = (rows or Rows(docs.select("doc_id", "text"), space)).table
    # everything in between is removed once the result is written
    scratch = Workspace(docs.sparkSession, space.fresh("linking"))
    signed = texts.select("row", "doc", _print(F.col("text")).alias("print"), "text").mapInArrow(signatures, SIGNATURE)
    signed = scratch.freeze(signed, "signatures")
    filled = signed.where(F.col("n_shingles") > 0)
    classes = filled.groupBy("set_key").agg(F.min("row").alias("node"), F.min(_id("doc")).alias("smallest"))
    classes = scratch.freeze(classes, "classes")
    leaders = filled.select(F.col("row").alias("doc"), "n_shingles", "bands", "planes").join(classes.select(F.col("node").alias("doc")), "doc")
    leaders = scratch.freeze(leaders, "leaders")
    entries = leaders.select(F.explode("bands").alias("band"), "doc")
    buckets = scratch.freeze(
        entries.groupBy("band").agg(F.min("doc").alias("first"), F.count("*").alias("n")).where(F.col("n") > 1).drop("n"), "buckets"
    )
    entries = scratch.freeze(entries.join(buckets, "band"), "entries")
    pairs = entries.where(F.col("doc") != F.col("first")).select("first", "doc").distinct()
    members = leaders.select("doc", "planes", F.col("n_shingles").alias("n"))
    heads = leaders.select(F.col("doc").alias("first"), F.col("planes").alias("head"), F.col("n_shingles").alias("m"))
    likely = pairs.join(members, "doc").join(heads, "first").where(estimate(F.col("planes"), F.col("head")) >= lowest_estimate(least))
    likely = scratch.freeze(likely.select("first", "doc", "n", "m"), "likely")
    wanted = scratch.freeze(entries.select(F.col("doc").alias("row")).distinct(), "wanted")
    chosen = texts.select("row", "text").join(wanted, "row").select(F.col("row").alias("doc"), "text")
    sets = scratch.freeze(chosen.mapInArrow(_full_sets, "doc long, shingles array<long>"), "sets")
    confirmed = (
        likely.join(sets, "doc")
        .join(sets.select(F.col("doc").alias("first"), F.col("shingles").alias("head")), "first")
        .where(_enough(F.size(F.array_intersect("shingles", "head")), F.col("n"), F.col("m"), least))
        .select(F.col("first").alias("a"), F.col("doc").alias("b"))
    )
    links = scratch.freeze(confirmed, "links")
    belongs = components(links, scratch)
    about = leaders.select("doc", "n_shingles").join(belongs, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    rest = scratch.freeze(_compare_rest(_open_buckets(entries.select("band", "doc"), about, scratch), sets, least), "links")
    belongs = components(links.union(rest), scratch).select(F.col("doc").alias("node"), F.col("component").alias("group"))
    groups = classes.join(belongs, "node").groupBy("group").agg(F.min("node").alias("first"), F.min("smallest").alias("least"))
    linked = scratch.freeze(belongs.join(scratch.freeze(groups, "groups"), "group"), "members")
    # classes without a link are groups of their own
    named = classes.join(linked, "node", "left").select(
        "set_key", F.coalesce("group", "node").alias("group"), F.coalesce("least", "smallest", F.lit(NO_ID)).alias("component"),
        F.coalesce("first", "node").alias("first"),
    )
    found = ["doc", "print", "n_shingles", "row", "group", "component", "first"]
    placed = filled.select("doc", "print", "n_shingles", "row", "set_key").join(scratch.freeze(named, "named"), "set_key").select(*found)
    empty = signed.where(F.col("n_shingles") == 0).withColumns({"group": F.lit(None).cast("long"), "component": F.col("doc"), "first": F.col("row")})
    result = space.freeze(placed.union(empty.select(*found)), "linked")
    space.release(scratch.root)
    return result


def _id(column: str) -> Column:
    return F.when(F.col(column) != NO_ID, F.col(column))


def near_digest(docs: DataFrame, space: Workspace, least: int = LEAST) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    Rows that hold the id of their component are kept; of a component without
    any id, the first row.
    """
    nameless = F.col("component") == NO_ID
    return link_documents(docs, space, least).select(
        _id("doc").alias("doc_id"), F.col("n_shingles").cast("long").alias("n_shingles"), _id("component").alias("component_id"),
        ((F.col("doc") == F.col("component")) & (~nameless | (F.col("row") == F.col("first")))).alias("kept"),
    )


def keep_one(docs: DataFrame, space: Workspace, least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` that stay: of every component a row of the smallest id, once.

    Rows are told apart by id and text. Of texts without words repeated rows of
    an id are dropped, and nothing else. What goes is decided on row numbers;
    whole rows do not move for it.
    """
    rows = Rows(docs, space)
    linked = link_documents(docs, space, least, rows)
    filled = linked.where(F.col("group").isNotNull())
    # of several texts of the smallest id one, and of that one the first row
    stays = filled.where(F.col("doc") == F.col("component")).groupBy("group").agg(F.min_by("row", F.struct("print", "row")).alias("row"))
    repeated = linked.where(F.col("group").isNull() & (F.col("doc") != NO_ID)).groupBy("doc", "print").agg(F.min("row").alias("row"))
    nameless = linked.where(F.col("group").isNull() & (F.col("doc") == NO_ID))
    kept = stays.select("row").union(repeated.select("row")).union(nameless.select("row"))
    gone = space.freeze(linked.select("row").join(kept, "row", "left_anti"), "gone")
    return rows.without(gone)
