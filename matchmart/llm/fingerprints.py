"""Document fingerprints by SimHash, and the search for all fingerprints within a Hamming radius.

Terms of a text are its words and its pairs of neighbouring words (with marks
at both ends); a term weighs by the logarithm of its count, pairs more than
words. Every term's hash votes with its weight for or against each of 128 bits.

The search keeps one table per block of a fingerprint, keyed by that block
(the fingerprint permuted so that the block leads). Each block tolerates some
flipped bits, and a radius is below the sum of (tolerance + 1) over the blocks:
two fingerprints within it are within the tolerance of some block, so a query
that asks every table for all keys within its tolerance misses none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchmart.llm.common import NO_ID, text_or_empty
from matchmart.workspace import Workspace

FINGERPRINT_BITS = 128
WORD_WEIGHT, PAIR_WEIGHT = 0.25, 1.0
#: fingerprints of this Hamming distance are near: term vectors of cosine 0.95 flip 13 of the 128 bits on average,
#: and 20 or fewer in 98 of 100 pairs
RADIUS = 20
#: blocks tolerate two flipped bits at most; there are 4 blocks at least and 16 at most
MOST_FLIPS, LEAST_BLOCKS, MOST_BLOCKS = 2, 4, 16
RANGES_PER_PARTITION = 3
_START, _END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_MEMORY = 400_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_HASHES = _WordHashes()


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def terms(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct term hashes and their weights; a text without words has one term, its characters."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.array([xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))], dtype=np.uint64), np.ones(1)
    if len(_HASHES) > _MEMORY:
        _HASHES.clear()
    single = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    chain = np.concatenate([[_START], single, [_END]])
    pairs = _mixed(chain[:-1] * np.uint64(3) + chain[1:] * np.uint64(5))
    words, counts = np.unique(single, return_counts=True)
    pairs, pair_counts = np.unique(pairs, return_counts=True)
    weights = np.concatenate([WORD_WEIGHT * np.log1p(counts), PAIR_WEIGHT * np.log1p(pair_counts)])
    return np.concatenate([words, pairs]), weights


def fingerprint(text: str) -> bytes:
    """128 bits: the signs of the weighted votes; a tie is 0."""
    hashes, weights = terms(text)
    halves = np.stack([_mixed(hashes), _mixed(hashes ^ _START)], axis=1)
    votes = np.zeros(FINGERPRINT_BITS)
    for start in range(0, len(hashes), 4096):
        bits = np.unpackbits(halves[start : start + 4096].view(np.uint8), axis=1)
        votes += weights[start : start + 4096].astype(np.float32) @ bits
    return np.packbits(2 * votes > weights.sum()).tobytes()


def likeness(one: bytes, other: bytes) -> float:
    """1 for equal fingerprints, 0 for half or more of the bits different: the cosine that so many bits estimate."""
    differ = (int.from_bytes(one) ^ int.from_bytes(other)).bit_count()
    return max(0.0, float(np.cos(np.pi * differ / FINGERPRINT_BITS)))


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def with_following(docs: DataFrame, space: Workspace) -> DataFrame:
    """Rows ``(part, guest, doc, text)``; in the order (guest, doc, text) each own row of a part is followed by its successor.

    Documents are dealt to ranges of ids. The first document of a range is also
    given, as a guest, to the range before it; that of the first range to the
    last. Texts move once, and only one row per range is doubled. The driver
    holds one id per range.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), text_or_empty().alias("text"))
    rows = rows.withColumn("at", F.col("doc").cast("double"))
    parts = RANGES_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(rows.approxQuantile("at", [i / parts for i in range(1, parts)], 1 / (4 * parts)))) or [0.0]
    ranges = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="at", outputCol="bucket")
    placed = ranges.transform(rows).select(F.col("bucket").cast("int").alias("part"), F.lit(False).alias("guest"), "doc", "text")
    filled = sorted(tuple(r) for r in placed.groupBy("part").agg(F.min("doc")).collect())
    goes = [(doc, filled[i - 1][0]) for i, (_, doc) in enumerate(filled)]
    guests = docs.sparkSession.createDataFrame(goes, "doc long, part int")
    # as many rows as there are ranges
    visiting = placed.drop("part").join(F.broadcast(guests), "doc").select("part", F.lit(True).alias("guest"), "doc", "text")
    return placed.union(visiting).repartition("part").sortWithinPartitions("part", "guest", "doc", "text")


RESULT = "doc long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _results(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Own rows in order, each with the row that follows it; one row is held at a time."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    held: tuple[int, int, str, bytes] | None = None
    out: list[tuple] = []
    for batch in batches:
        for part, guest, doc, text in zip(*(batch.column(c).to_pylist() for c in ("part", "guest", "doc", "text")), strict=True):
            if guest and (held is None or held[0] != part):
                continue
            own = fingerprint(text)
            if held is not None and held[0] == part:
                _, before, old, print_ = held
                new = edited(old, text)
                changed = print_ if new == old else fingerprint(new)
                digest = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
                out.append((before, len(old), digest, print_.hex(), changed.hex(), likeness(print_, changed), likeness(print_, own)))
            held = None if guest else (part, doc, text, own)
        if len(out) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)


def fingerprint_documents(docs: DataFrame, space: Workspace) -> DataFrame:
    """Per row of ``docs``: doc, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one of the next larger id, for the last the first;
    rows of one id are ordered by text, a null id is the smallest. A null text
    counts as empty, and an empty text is its own edited text. An only row is
    its own next document.
    """
    return space.freeze(with_following(docs, space).mapInArrow(_results, RESULT), "fingerprints")


def _halves(fingerprint: Column) -> list[Column]:
    """The two 64-bit halves of a hexadecimal fingerprint."""
    quarters = [F.conv(F.substring(fingerprint, at, 8), 16, 10).cast("long") for at in (1, 9, 17, 25)]
    return [F.shiftleft(quarters[i], 32).bitwiseOR(quarters[i + 1]) for i in (0, 2)]


def _hexadecimal(high: Column, low: Column) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(half), 16, "0") for half in (high, low)]))


def block_tables(radius: int) -> list[tuple[int, int, int]]:
    """(first bit, bit after the last, tolerated flips) of every table for a radius."""
    n = max(LEAST_BLOCKS, -(-(radius + 1) // (MOST_FLIPS + 1)))
    if radius < 0 or n > MOST_BLOCKS:
        raise ValueError(f"radius must be 0 to {MOST_BLOCKS * (MOST_FLIPS + 1) - 1}")
    flips = [(radius + 1 + i) // n - 1 for i in range(n)]
    cuts = [FINGERPRINT_BITS * i // n for i in range(n + 1)]
    # a block without a tolerance is not needed: the others add up to the radius without it
    return [(cuts[i], cuts[i + 1], flips[i]) for i in range(n) if flips[i] >= 0]


def _block(high: Column, low: Column, first: int, end: int) -> Column:
    """Bits ``first`` to ``end`` (excluded) of a fingerprint, the highest bit being 0; at most 32 of them."""
    mask = F.lit((1 << (end - first)) - 1)
    if end <= 64:
        return F.shiftrightunsigned(high, 64 - end).bitwiseAND(mask)
    lower = F.shiftrightunsigned(low, 128 - end)
    return (lower if first >= 64 else F.shiftleft(high, end - 64).bitwiseOR(lower)).bitwiseAND(mask)


def _masks(width: int, flips: int) -> list[int]:
    """All numbers of so many bits with at most ``flips`` of them set."""
    return [sum(1 << at for at in chosen) for k in range(flips + 1) for chosen in combinations(range(width), k)]


def search_fingerprints(prints: DataFrame, queries: DataFrame, space: Workspace, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, found, distance): all distinct fingerprints of ``prints`` within ``radius`` bits of each query's.

    ``radius`` may be 0 to 47. At 20 there are seven tables of 18 or 19 bits; a
    query asks each for the 172 or 191 keys within two bits, and about one
    fingerprint in 220 is compared with it. A pair counts in the first table
    that has it. Null fingerprints take no part.
    """
    tables = block_tables(radius)

    def distinct(rows: DataFrame, name: str) -> DataFrame:
        known = rows.where(F.col("fingerprint").isNotNull()).select("fingerprint").distinct()
        high, low = _halves(F.col("fingerprint"))
        return space.freeze(known.select(high.alias(f"{name}_high"), low.alias(f"{name}_low")), name)

    def blocks(name: str) -> list[Column]:
        return [_block(F.col(f"{name}_high"), F.col(f"{name}_low"), first, end) for first, end, _ in tables]

    def keyed(table: int, block: Column) -> Column:
        return block + F.lit(table << 32)

    held, asked = distinct(prints, "held"), distinct(queries, "asked")
    stored = held.select("held_high", "held_low", F.explode(F.array(*[keyed(i, b) for i, b in enumerate(blocks("held"))])).alias("key"))
    def within(table: int, block: Column, masks: list[int]) -> Column:
        return F.transform(F.lit(masks), lambda mask: keyed(table, block.bitwiseXOR(mask.cast("long"))))

    near_keys = [within(i, b, _masks(end - first, flips)) for i, (b, (first, end, flips)) in enumerate(zip(blocks("asked"), tables, strict=True))]
    # a row becomes more than a thousand here, so its table's few files are dealt to many tasks first
    dealt = asked.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    probes = dealt.select("asked_high", "asked_low", F.explode(F.flatten(F.array(*near_keys))).alias("key"))
    differ = [F.bit_count(F.col(f"asked_{half}").bitwiseXOR(F.col(f"held_{half}"))) for half in ("high", "low")]
    first_table = F.coalesce(*[
        F.when(F.bit_count(one.bitwiseXOR(other)) <= flips, F.lit(i))
        for i, (one, other, (_, _, flips)) in enumerate(zip(blocks("asked"), blocks("held"), tables, strict=True))
    ])
    # both sides are many times the size of their tables, which a plan does not foresee: neither is to be broadcast;
    # the join itself decides on both halves and the table, so it makes every pair of the result once and no other row
    met = probes.join(stored.hint("merge"), "key")
    near = met.where((differ[0] + differ[1] <= radius) & (F.shiftright("key", 32) == first_table))
    return near.select(
        _hexadecimal(F.col("asked_high"), F.col("asked_low")).alias("fingerprint"),
        _hexadecimal(F.col("held_high"), F.col("held_low")).alias("found"), (differ[0] + differ[1]).alias("distance"),
    ).distinct()


def fingerprint_digest(docs: DataFrame, space: Workspace) -> DataFrame:
    """Per document the columns of ``fingerprint_documents``, and n_within.

    ``n_within``: for documents whose id is divisible by 50, how many documents,
    itself included, have a fingerprint within ``RADIUS`` bits; null for others.
    """
    made = fingerprint_documents(docs, space)
    asks = made.where((F.col("doc") != NO_ID) & (F.col("doc") % 50 == 0))
    found = search_fingerprints(made, asks, space)
    holders = made.groupBy(F.col("fingerprint").alias("found")).agg(F.count("*").alias("n"))
    within = space.freeze(found.join(holders, "found").groupBy("fingerprint").agg(F.sum("n").alias("n_within")), "within")
    counted = asks.select("doc", "fingerprint").distinct().join(within, "fingerprint").select("doc", "n_within")
    counted = space.freeze(counted.groupBy("doc").agg(F.max("n_within").alias("n_within")), "counted")
    return made.join(counted, "doc", "left").select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_chars", "edited_sha256", "fingerprint",
        "edited_fingerprint", "near_edited", "near_next", "n_within",
    )
