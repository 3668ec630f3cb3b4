"""Shingle sets and b-bit MinHash signatures of whole texts, a record batch at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

WORDS = 5
BANDS, ROWS = 38, 5
#: minima kept; the bands take the first BANDS * ROWS of them
SLOTS = 192
#: low bits kept of every minimum, each in a plane of SLOTS bits
BITS = 4
PLANE_LONGS = SLOTS // 64
_MEMORY = 400_000
_random = np.random.Generator(np.random.PCG64(6))
_PLACES = _random.integers(1, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _random.integers(0, 2**31, SLOTS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADDENDS = _random.integers(0, 2**32, SLOTS, dtype=np.uint32)
_BAND = _random.integers(1, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_SEEDS = _random.integers(1, 2**63, BANDS, dtype=np.uint64)


class _WordHashes(dict):
    """64-bit hashes of words, computed when first met."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_HASHES = _WordHashes()


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII blanks, A-Z lower-cased."""
    return text.lower().split()


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    return values ^ (values >> np.uint64(29))


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words; of all words as one run if there are fewer."""
    parts = words_of(text)
    if not parts:
        return np.empty(0, dtype=np.uint64)
    if len(_HASHES) > _MEMORY:
        _HASHES.clear()
    hashes = np.fromiter(map(_HASHES.__getitem__, parts), dtype=np.uint64, count=len(parts))
    if len(parts) < words:
        return _mixed((hashes * _PLACES[: len(parts)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(parts)))
    runs = len(parts) - words + 1
    total = np.zeros(runs, dtype=np.uint64)
    for j in range(words):
        total += hashes[j : j + runs] * _PLACES[j]
    return np.unique(_mixed(total))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each of ``SLOTS`` hash functions over a non-empty set."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(SLOTS, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(short), 512):
        values = short[start : start + 512, None] * _FACTORS + _ADDENDS
        np.minimum(best, values.min(axis=0), out=best)
    return best


def band_keys(best: np.ndarray) -> np.ndarray:
    rows = best[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    return _mixed((rows * _BAND).sum(axis=2, dtype=np.uint64) + _BAND_SEEDS).view(np.int64)


def packed(best: np.ndarray) -> np.ndarray:
    """Per row ``BITS`` planes of ``SLOTS`` bits as 64-bit integers."""
    planes = (best[:, None, :] >> np.arange(BITS, dtype=np.uint32)[None, :, None]).astype(np.uint8) & 1
    return np.packbits(planes, axis=2).reshape(len(best), -1).view(np.int64)


def lists(values: np.ndarray) -> pa.ListArray:
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows * width + 1, width, dtype=np.int32)), pa.array(values.reshape(-1)))


SIGNATURE = "row long, doc long, print binary, n_shingles long, set_key binary, bands array<long>, planes array<long>"


def signatures(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, doc, print, text) to the size and key of the shingle set, band keys and packed minima; empty sets have no bands."""
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        known = [batch.column(c) for c in ("row", "doc", "print")]
        for start in range(0, batch.num_rows, 1000):
            some = [t.as_py() for t in texts[start : start + 1000]]
            if not some:
                continue
            best = np.zeros((len(some), SLOTS), dtype=np.uint32)
            sizes, keys = np.zeros(len(some), dtype=np.int64), []
            for i, text in enumerate(some):
                shingles = shingle_set(text)
                sizes[i] = len(shingles)
                keys.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                if len(shingles):
                    best[i] = minima(shingles)
            yield pa.RecordBatch.from_arrays(
                [*[c[start : start + 1000] for c in known], pa.array(sizes), pa.array(keys, pa.binary()), lists(band_keys(best)), lists(packed(best))],
                names=["row", "doc", "print", "n_shingles", "set_key", "bands", "planes"],
            )
