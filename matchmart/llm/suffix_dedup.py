"""Repeated byte strings by prefix-free parsing.

A string of ``SPAN`` bytes is removed where it also starts in a document of a
smaller id. Sorting every suffix of the corpus would move each byte many times,
so suffixes are ordered through a parse:

1. A rolling hash runs over windows of ``TRIGGER`` bytes. The trigger of a string
   is the window of the least hash in it, the first of equal ones. (A hash that
   is 0 modulo a number would leave strings without any trigger, or twice as
   many triggers.) Neighbouring strings share their trigger; the stretch of
   starts with one trigger is a phrase, and the phrases are the parse of a text.
   Equal strings have equal triggers at the same distance, wherever they stand.
2. Texts are packed into chunks. A chunk sends the hashes of its triggers, each
   once, and learns which of them other documents hold too. All other phrases
   are done with; on ordinary text that is most of the corpus.
3. The dictionary holds the distinct phrases of a chunk around shared triggers,
   with the smallest id that has them. Phrases of one trigger meet, from all
   chunks. They are sorted once from the trigger backwards, which orders the
   phrases' suffixes, and once from it onwards, which orders the continuations
   of the parse, each to the depth a string can reach. A suffix of a phrase and
   what follows in the parse together make a string: strings are equal just when
   both their classes are, and the smallest id of every class is known.
4. Chunks learn which strings of their phrases have a smaller id elsewhere, and
   cut the covered bytes.

Everything but the choice of phrases in step 2 compares the bytes themselves. A
trigger with more than ``HOT`` phrases would be one task's work; its strings are
aggregated one by one instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmart.llm.common import NO_ID
from matchmart.workspace import Workspace

SPAN = 50
TRIGGER = 16
#: bytes of a string outside its trigger
REACH = SPAN - TRIGGER
#: bytes of text in a chunk
CHUNK = 4 << 20
#: triggers of a bucket, about
BUCKET = 1 << 18
#: phrases around one trigger that may meet in one task
HOT = 1 << 18
_PIECE = 1 << 16
_PLACE = np.uint64(0xFFFFFF)
_BASE = 0x9E3779B97F4A7C15
#: a phrase with its surroundings: bytes before, trigger, bytes after, and how many of those before count at most and at least
_RECORD = 88
_BEFORE, _AFTER, _MOST, _LEAST = slice(0, REACH), slice(SPAN, SPAN + REACH), SPAN + REACH, SPAN + REACH + 1


# --- parse -------------------------------------------------------------------


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    return values ^ (values >> np.uint64(29))


def _rolling(data: np.ndarray) -> np.ndarray:
    """The rolling hash of every window: twice as long windows from two halves each."""
    found = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    length = 1
    while length < TRIGGER:
        found = found[:-length] * np.uint64(pow(_BASE, length, 1 << 64)) + found[length:]
        length *= 2
    return _mixed(found)


def trigger_places(data: np.ndarray) -> np.ndarray:
    """Where the trigger of the string at every start stands."""
    starts = max(0, len(data) - SPAN + 1)
    places = np.empty(starts, dtype=np.int64)
    for begin in range(0, starts, _PIECE):
        end = min(starts, begin + _PIECE)
        least = _rolling(data[begin : end + SPAN - 1])
        # hash and place in one number: the least is the first of the least hashes
        least = (least & ~_PLACE) | np.arange(len(least), dtype=np.uint64)
        length = 1
        while 2 * length <= REACH + 1:
            least = np.minimum(least[:-length], least[length:])
            length *= 2
        rest = REACH + 1 - length
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        places[begin:end] = (least & _PLACE).astype(np.int64) + begin
    return places


@dataclass
class Parse:
    """The phrases of a chunk: the first and last start, the trigger's place and key, the document's number in the chunk."""

    data: np.ndarray
    first: np.ndarray
    last: np.ndarray
    at: np.ndarray
    doc: np.ndarray
    key: np.ndarray


def parse(text: bytes, sizes: np.ndarray) -> Parse:
    """Phrases of texts of the given sizes that stand one after the other; none crosses from one to the next."""
    data = np.frombuffer(text, dtype=np.uint8)
    places = trigger_places(data)
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    inside = doc[: len(places)] == doc[SPAN - 1 :] if len(places) else np.zeros(0, dtype=bool)
    goes_on = inside[1:] & inside[:-1] & (places[1:] == places[:-1])
    edge = np.zeros(min(1, len(places)), dtype=bool)
    first = np.flatnonzero(inside & ~np.concatenate([edge, goes_on]))
    last = np.flatnonzero(inside & ~np.concatenate([goes_on, edge]))
    at = places[first]
    windows = data[at[:, None] + np.arange(TRIGGER)].view(np.uint64)
    key = _mixed(windows[:, 0] * np.uint64(_BASE) + _mixed(windows[:, 1])) >> np.uint64(8)
    return Parse(data, first, last, at, doc[first], key)


def records(found: Parse, which: np.ndarray) -> np.ndarray:
    """The phrases ``which`` as rows of bytes; bytes that none of their strings reach are zeros."""
    at, most, least = found.at[which], found.at[which] - found.first[which], found.at[which] - found.last[which]
    padding = np.zeros(REACH, dtype=np.uint8)
    around = np.concatenate([padding, found.data, padding])
    rows = np.zeros((len(which), _RECORD), dtype=np.uint8)
    rows[:, : SPAN + REACH] = around[at[:, None] + np.arange(SPAN + REACH)]
    far = np.arange(REACH)
    rows[:, _BEFORE][far < (REACH - most)[:, None]] = 0
    rows[:, _AFTER][far >= (REACH - least)[:, None]] = 0
    rows[:, _MOST], rows[:, _LEAST] = most, least
    return rows


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of bytes, sorted, and which of them every row is."""
    width = rows.shape[1]
    found, inverse = np.unique(np.ascontiguousarray(rows).view(f"S{width}").reshape(-1), return_inverse=True)
    return found.view(np.uint8).reshape(-1, width), inverse


def _smallest(ids: np.ndarray, inverse: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(out, inverse, ids)
    return out


def strings_of(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All strings of phrases: the bytes, the phrase's number, and how many bytes stand before the trigger."""
    least, most = rows[:, _LEAST].astype(np.int64), rows[:, _MOST].astype(np.int64)
    of = np.repeat(np.arange(len(rows)), most - least + 1)
    before = np.arange(len(of)) - np.repeat(np.cumsum(most - least + 1) - (most - least + 1), most - least + 1) + least[of]
    return rows[of[:, None], (REACH - before)[:, None] + np.arange(SPAN)], of, before


# --- dictionary and parse in one order ---------------------------------------


def _sorted_by(trigger: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by trigger and part, and how many bytes each row has in common with the one before it."""
    rows = np.zeros((len(part), 56), dtype=np.uint8)
    rows[:, :TRIGGER], rows[:, TRIGGER : TRIGGER + REACH] = trigger, part
    order = np.lexsort(rows.view(">u8").T[::-1])
    rows = rows[order]
    equal = np.zeros((len(rows), 57), dtype=bool)
    equal[1:, :56] = rows[1:] == rows[:-1]
    return order, equal.argmin(axis=1)


def earlier_strings(rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Per phrase a bit mask: bit b is set if its string with b bytes before the trigger has a smaller id among the rows."""
    trigger = rows[:, REACH:SPAN]
    backwards, same_suffix = _sorted_by(trigger, rows[:, _BEFORE][:, ::-1])
    onwards, same_rest = _sorted_by(trigger, rows[:, _AFTER])
    masks = np.zeros(len(rows), dtype=np.uint64)
    suffix, rest = np.empty(len(rows), dtype=np.int64), np.empty(len(rows), dtype=np.int64)
    for before in range(REACH + 1):
        have = np.flatnonzero((rows[:, _LEAST] <= before) & (before <= rows[:, _MOST]))
        if not len(have):
            continue
        suffix[backwards] = np.cumsum(same_suffix < TRIGGER + before)
        rest[onwards] = np.cumsum(same_rest < SPAN - before)
        string = suffix[have] * (len(rows) + 1) + rest[have]
        order = np.lexsort((ids[have], string))
        string, own = string[order], ids[have][order]
        new = np.concatenate([[True], string[1:] != string[:-1]])
        later = own > own[new][np.cumsum(new) - 1]
        masks[have[order[later]]] |= np.uint64(1 << before)
    return masks


# --- tasks -------------------------------------------------------------------


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)


_CHUNKS = "chunk long, n_bytes long, ids binary, sizes binary, texts binary"


def _chunked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text) to chunks of whole texts."""
    part, number = TaskContext.get().partitionId(), 0
    ids: list[int] = []
    texts: list[bytes] = []
    held = 0

    def chunk() -> pa.RecordBatch:
        whole = b"".join(texts)
        values = [(part << 32) + number, len(whole), np.array(ids, dtype=np.int64).tobytes(), np.array([len(t) for t in texts], dtype=np.int64).tobytes()]
        return pa.RecordBatch.from_pylist([dict(zip(("chunk", "n_bytes", "ids", "sizes", "texts"), [*values, pa.compress(whole, codec="zstd", asbytes=True)], strict=True))])

    for batch in batches:
        for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text"), strict=True):
            ids.append(doc)
            texts.append(text.as_py())
            held += len(texts[-1])
            if held >= CHUNK:
                yield chunk()
                ids, texts, held, number = [], [], 0, number + 1
    if ids:
        yield chunk()


def _chunks_of(batches: Iterable[pa.RecordBatch], *more: str) -> Iterator[tuple]:
    """(chunk, ids, sizes, parse, further columns) of every chunk."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in ("chunk", "n_bytes", "ids", "sizes", "texts", *more)}
            sizes = np.frombuffer(row["sizes"], dtype=np.int64)
            text = pa.decompress(row["texts"], decompressed_size=row["n_bytes"], codec="zstd", asbytes=True) if row["n_bytes"] else b""
            yield row["chunk"], np.frombuffer(row["ids"], dtype=np.int64), sizes, parse(text, sizes), *[row[c] for c in more]


_ENTRIES = "bucket long, chunk long, entries binary"


def _entries(buckets: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The keys of a chunk's triggers by bucket; the low byte has 2 * bits of the number of phrases, and 1 for several documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, ids, _, found in _chunks_of(batches):
            if not len(found.key):
                continue
            own = ids[found.doc]
            order = np.lexsort((found.key, found.key % np.uint64(buckets)))
            key, own = found.key[order], own[order]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            counts = np.diff(np.append(starts, len(key)))
            several = np.minimum.reduceat(own, starts) != np.maximum.reduceat(own, starts)
            bits = np.floor(np.log2(counts)).astype(np.uint64) + np.uint64(1)
            entries = (key[starts] << np.uint64(8)) | (bits << np.uint64(1)) | several.astype(np.uint64)
            bucket = (key[starts] % np.uint64(buckets)).astype(np.int64)
            yield _by_bucket(bucket, chunk, {"entries": entries.view(np.uint8).reshape(-1, 8)})

    return run


def _by_bucket(bucket: np.ndarray, chunk: int, columns: dict[str, np.ndarray], pack: str = "") -> pa.RecordBatch:
    """One row per bucket of rows that are sorted by it."""
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, dtype=int)
    cuts = list(zip(starts, np.append(starts[1:], len(bucket)), strict=True)) if len(bucket) else []
    arrays = [pa.array(bucket[starts]), pa.array(np.full(len(starts), chunk))]
    arrays += [pa.array([_packed(v[a:b]) if c == pack else np.ascontiguousarray(v[a:b]).tobytes() for a, b in cuts], pa.binary()) for c, v in columns.items()]
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", "chunk", *columns])


def _whole_buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one bucket after the other; rows come sorted by bucket."""
    held: list[dict] = []
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            if held and held[0]["bucket"] != row["bucket"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


_SHARED = "chunk long, shared binary, hot long"


def _shared(hot: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Entries of a bucket to the keys that each chunk shares; the low byte is 1 for hot ones."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_buckets(batches):
            parts = [np.frombuffer(r["entries"], dtype=np.uint64) for r in rows]
            entries, source = np.concatenate(parts), np.repeat(np.arange(len(rows)), [len(p) for p in parts])
            order = np.argsort(entries >> np.uint64(8), kind="stable")
            entries, source = entries[order], source[order]
            key = entries >> np.uint64(8)
            new = np.concatenate([[True], key[1:] != key[:-1]])
            starts, group = np.flatnonzero(new), np.cumsum(new) - 1
            several = np.bitwise_or.reduceat(entries & np.uint64(1), starts) > 0
            weight = np.add.reduceat(np.left_shift(np.uint64(1), (entries & np.uint64(255)) >> np.uint64(1)), starts)
            meets = several | (np.diff(np.append(starts, len(key))) > 1)
            reply = (key << np.uint64(8)) | (weight > hot)[group].astype(np.uint64)
            keep = meets[group]
            reply, source = reply[keep], source[keep]
            back = np.argsort(source, kind="stable")
            reply, source = reply[back], source[back]
            ends = np.searchsorted(source, np.arange(len(rows) + 1))
            out = [(r["chunk"], reply[a:b]) for r, a, b in zip(rows, ends, ends[1:], strict=False) if b > a]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in out], pa.int64()), pa.array([v.tobytes() for _, v in out], pa.binary()), pa.array([int((v & np.uint64(1)).sum()) for _, v in out], pa.int64())],
                names=["chunk", "shared", "hot"],
            )

    return run


def _meeting(found: Parse, shared: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    """The phrases around shared triggers, and those around hot ones."""
    replies = np.sort(np.frombuffer(b"".join(shared or []), dtype=np.uint64))
    if not len(replies):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    keys = replies >> np.uint64(8)
    at = np.minimum(np.searchsorted(keys, found.key), len(keys) - 1)
    meets, hot = keys[at] == found.key, (replies[at] & np.uint64(1)) == 1
    return np.flatnonzero(meets & ~hot), np.flatnonzero(meets & hot)


_PHRASES = "bucket long, chunk long, which binary, ids binary, records binary"


def _phrases(buckets: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The dictionary of a chunk by bucket of the trigger: the distinct phrases with their number and smallest id."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, ids, _, found, shared in _chunks_of(batches, "shared"):
            which, _ = _meeting(found, shared)
            if not len(which):
                continue
            rows, inverse = _distinct(records(found, which))
            first = _smallest(ids[found.doc[which]], inverse, len(rows))
            key = np.zeros(len(rows), dtype=np.uint64)
            key[inverse] = found.key[which]
            bucket = (key % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            columns = {"which": order.astype(np.uint32).view(np.uint8).reshape(-1, 4), "ids": first[order].view(np.uint8).reshape(-1, 8), "records": rows[order]}
            yield _by_bucket(bucket[order], chunk, columns, pack="records")

    return run


_EARLIER = "chunk long, which binary, masks binary"


def _earlier(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases of a bucket to the masks of those with strings that a smaller id has, by chunk."""
    for rows in _whole_buckets(batches):
        which = [np.frombuffer(r["which"], dtype=np.uint32) for r in rows]
        ids = np.concatenate([np.frombuffer(r["ids"], dtype=np.int64) for r in rows])
        bytes_ = [pa.decompress(r["records"], decompressed_size=_RECORD * len(w), codec="zstd", asbytes=True) for r, w in zip(rows, which, strict=True)]
        masks = earlier_strings(np.frombuffer(b"".join(bytes_), dtype=np.uint8).reshape(-1, _RECORD), ids)
        cuts = np.cumsum([0, *[len(w) for w in which]])
        out = []
        for r, w, a, b in zip(rows, which, cuts, cuts[1:], strict=False):
            hit = masks[a:b] > 0
            if hit.any():
                out.append((r["chunk"], w[hit].tobytes(), masks[a:b][hit].tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["chunk", "which", "masks"])


_STRINGS = "string binary, chunk long, first long"


def _hot_strings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct strings of a chunk's phrases around hot triggers, with their smallest id."""
    for chunk, ids, _, found, shared in _chunks_of(batches, "shared"):
        _, hot = _meeting(found, shared)
        if len(hot):
            strings, of, _ = strings_of(records(found, hot))
            rows, inverse = _distinct(strings)
            first = _smallest(ids[found.doc[hot]][of], inverse, len(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in rows], pa.binary()), pa.array(np.full(len(rows), chunk)), pa.array(first)], names=["string", "chunk", "first"]
            )


def repeated_starts(found: Parse, ids: np.ndarray, shared: list[bytes] | None, earlier: list[dict] | None, hot_earlier: list[bytes] | None) -> np.ndarray:
    """The starts of strings that a document with a smaller id has too."""
    which, hot = _meeting(found, shared)
    starts = []
    if len(which):
        rows, inverse = _distinct(records(found, which))
        own = ids[found.doc[which]]
        masks = np.zeros(len(rows), dtype=np.uint64)
        for e in earlier or []:
            masks[np.frombuffer(e["which"], dtype=np.uint32)] = np.frombuffer(e["masks"], dtype=np.uint64)
        # a larger id than the first one with the phrase repeats all of it
        later = own > _smallest(own, inverse, len(rows))[inverse]
        mask = np.where(later, ~np.uint64(0), masks[inverse])
        some = which[mask > 0]
        sizes = found.last[some] - found.first[some] + 1
        of = np.repeat(np.arange(len(some)), sizes)
        place = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + found.first[some][of]
        bit = (mask[mask > 0][of] >> (found.at[some][of] - place).astype(np.uint64)) & np.uint64(1)
        starts.append(place[bit > 0])
    if len(hot):
        strings, of, before = strings_of(records(found, hot))
        rows, inverse = _distinct(strings)
        own = ids[found.doc[hot]][of]
        known = np.frombuffer(b"".join(hot_earlier or []), dtype=f"S{SPAN}")
        elsewhere = np.isin(rows.view(f"S{SPAN}").reshape(-1), known)
        hit = (own > _smallest(own, inverse, len(rows))[inverse]) | elsewhere[inverse]
        starts.append((found.at[hot][of] - before)[hit])
    return np.concatenate(starts) if starts else np.zeros(0, dtype=np.int64)


_CUT = "doc long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with what they learned to texts without the repeated bytes."""
    for _, ids, sizes, found, shared, earlier, hot_earlier in _chunks_of(batches, "shared", "earlier", "hot_earlier"):
        n = len(found.data)
        starts = repeated_starts(found, ids, shared, earlier, hot_earlier)
        steps = np.bincount(starts, minlength=n + 1) - np.bincount(starts + SPAN, minlength=n + 1)
        gone = np.cumsum(steps[:n]) > 0
        ends = np.cumsum(sizes)
        begins = ends - sizes
        opens = np.zeros(n + 1, dtype=bool)
        opens[begins] = True
        first = np.flatnonzero(gone & (opens[:n] | ~np.concatenate([[False], gone])[:n]))
        last = np.flatnonzero(gone & (opens[1:] | (np.arange(1, n + 1) == n) | ~np.append(gone[1:], False))) if n else first
        doc = np.searchsorted(ends, first, side="right")
        total = np.concatenate([[0], np.cumsum(gone)])
        kept_sizes = sizes - (total[ends] - total[begins])
        spans = pa.StructArray.from_arrays([pa.array(first - begins[doc]), pa.array(last + 1 - begins[doc])], names=["start", "end"])
        list_ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(sizes)))]).astype(np.int32)
        kept_ends = np.concatenate([[0], np.cumsum(kept_sizes)])
        kept = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(kept_ends.astype(np.int64)), pa.py_buffer(found.data[~gone].tobytes())])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(sizes), pa.ListArray.from_arrays(pa.array(list_ends), spans), kept.cast(pa.binary())], names=["doc", "n_bytes", "spans", "kept"]
        )


# --- the operator ------------------------------------------------------------


def remove_repeats(docs: DataFrame, space: Workspace, hot: int = HOT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, spans (start and end of the maximal removed runs) and kept (the other bytes).

    Every byte goes that a string of ``SPAN`` bytes covers which also starts in a
    document of a smaller id. Rows of one id are one document: they remove
    nothing from each other. A null id is smaller than all others. A null text is
    empty, and texts shorter than a string stay whole.

    Texts move once, into a table bucketed by chunk; what chunks learn is joined
    to them there.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"chunks_{uuid.uuid4().hex}"
    packed = rows.mapInArrow(_chunked, _CHUNKS).repartition(parts, "chunk")
    packed.write.bucketBy(parts, "chunk").option("path", space.path(name)).saveAsTable(name)
    chunks = spark.table(name)
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(8 * parts, 2 * total // (REACH + 2) // BUCKET)

    def gathered(frame: DataFrame) -> DataFrame:
        """Rows of a bucket in one task, buckets one after the other."""
        return frame.repartition(parts, "bucket").sortWithinPartitions("bucket")

    def learned(*tables: DataFrame) -> DataFrame:
        """Chunks with what is known about them; only that moves."""
        found = chunks
        for known in tables:
            found = found.join(known.hint("shuffle_hash"), "chunk", "left")
        return found

    entries = gathered(chunks.mapInArrow(_entries(buckets), _ENTRIES))
    shared = entries.mapInArrow(_shared(hot), _SHARED).groupBy("chunk").agg(F.collect_list("shared").alias("shared"), F.sum("hot").alias("hot"))
    shared = space.freeze(shared, "shared")
    phrases = gathered(learned(shared).mapInArrow(_phrases(buckets), _PHRASES))
    earlier = phrases.mapInArrow(_earlier, _EARLIER).groupBy("chunk").agg(F.collect_list(F.struct("which", "masks")).alias("earlier"))
    earlier = space.freeze(earlier, "earlier")
    if shared.agg(F.sum("hot")).first()[0]:
        strings = space.freeze(learned(shared.where("hot > 0")).mapInArrow(_hot_strings, _STRINGS), "strings")
        smallest = strings.groupBy("string").agg(F.min("first").alias("smallest"))
        met = strings.join(smallest, "string").where("smallest < first")
        hot_earlier = space.freeze(met.groupBy("chunk").agg(F.collect_list("string").alias("hot_earlier")), "hot")
    else:
        hot_earlier = spark.createDataFrame([], "chunk long, hot_earlier array<binary>")
    cut = learned(shared, earlier, hot_earlier).mapInArrow(_cut, _CUT)
    return cut.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_bytes", "spans", "kept")


def repeats_digest(docs: DataFrame, space: Workspace) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return remove_repeats(docs, space).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


#: DuckDB counterpart of ``repeats_digest``, on hexadecimal texts
REPEATS_SQL = """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS x FROM documents
), p AS (
  SELECT doc_id, r, unnest(range(0, length(x) // 2 - 49)) AS s, x FROM d
), w AS (
  SELECT doc_id, r, s, substr(x, 2 * s + 1, 100) AS y FROM p
), f AS (
  SELECT y, min(doc_id) AS first FROM w GROUP BY y HAVING min(doc_id) < max(doc_id)
), hit AS (
  SELECT w.r, w.s, max(w.s) OVER (PARTITION BY w.r ORDER BY w.s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM w JOIN f ON w.y = f.y WHERE f.first < w.doc_id
), run AS (
  SELECT r, s, sum(CASE WHEN before IS NULL OR s > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY s) AS k FROM hit
), span AS (
  SELECT r, k, min(s) AS a, max(s) + 50 AS b FROM run GROUP BY r, k
), piece AS (
  SELECT r, a, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS since, b FROM span
), kept AS (
  SELECT d.r, count(piece.a) AS n_spans, coalesce(sum(piece.b - piece.a), 0)::BIGINT AS n_removed, coalesce(max(piece.b), 0) AS upto,
         coalesce(string_agg(substr(d.x, 2 * piece.since + 1, 2 * (piece.a - piece.since)), '' ORDER BY piece.a), '') AS front
  FROM d LEFT JOIN piece ON piece.r = d.r GROUP BY d.r
)
SELECT d.doc_id, (length(d.x) // 2)::BIGINT AS n_bytes, kept.n_removed, kept.n_spans,
       sha256(unhex(kept.front || substr(d.x, 2 * kept.upto + 1))) AS kept_sha256
FROM d JOIN kept ON kept.r = d.r
"""
