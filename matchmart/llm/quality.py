"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

Terms of a text are its words, the shapes of its words, and marks for words
repeated at once, hashed to a fixed number of columns. Inverse document
frequencies are counted over all documents. A truncated singular value
decomposition of a bounded sample gives the latent space; the vectors of a
bounded sample of labelled training rows are broadcast. Every document's cosine
products with all of them are computed in blocks, and its nearest neighbours
vote with their labels, weighted by similarity.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmart.llm.common import held_out, labelled_sample, text_or_empty, unit_draw
from matchmart.workspace import Workspace

#: columns of word terms and of shape terms
WORD_COLUMNS, SHAPE_COLUMNS = 1024, 1024
COLUMNS = WORD_COLUMNS + SHAPE_COLUMNS
#: share of a vector's squared length that words make up; shapes have the rest
WORD_SHARE = 0.2
RANK = 48
#: about so many labelled training rows at most vote, and so many of them at most fit the latent space
VOTERS, FITTING = 8_000, 3_000
NEIGHBOURS = 15
#: a neighbour's weight is its cosine to this power
SHARPNESS = 8
BLOCK = 512
_MEMORY = 400_000
_KINDS = (re.compile(r"[^\W\d_]+"), re.compile(r"\d+"))


def shape(word: str) -> str:
    """Runs of letters by case, digits, and other characters once each: ``Word,`` is ``Xx,``, ``the***`` is ``x*``."""
    out = []
    for c in word:
        kind = ("X" if c.isupper() else "x") if c.isalpha() else "9" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out[:8])


class _Terms(dict):
    """Columns of a word: ``word column << 16 | shape column``."""

    def __missing__(self, word: str) -> int:
        own = xxhash.xxh3_64_intdigest(word.lower()) % WORD_COLUMNS
        kind = xxhash.xxh3_64_intdigest(shape(word)) % (SHAPE_COLUMNS - 4)
        found = self[word] = own << 16 | kind
        return found


_TERMS = _Terms()


def frequencies(text: str) -> np.ndarray:
    """Counts of a text's terms by column; the last four columns are marks of length and repetition."""
    words = text.split()
    counts = np.zeros(COLUMNS, dtype=np.float32)
    if not words:
        return counts
    if len(_TERMS) > _MEMORY:
        _TERMS.clear()
    terms = np.fromiter(map(_TERMS.__getitem__, words), dtype=np.int64, count=len(words))
    counts[:WORD_COLUMNS] = np.bincount(terms >> 16, minlength=WORD_COLUMNS)
    counts[WORD_COLUMNS:] = np.bincount(terms & 0xFFFF, minlength=SHAPE_COLUMNS)
    again = np.count_nonzero(terms[1:] == terms[:-1])
    counts[-1], counts[-2] = again, len(words) - len(np.unique(terms)) if len(words) > 5 else 0
    return counts


def _matrix(texts: list[str]) -> np.ndarray:
    return np.stack([frequencies(t) for t in texts]) if texts else np.zeros((0, COLUMNS), dtype=np.float32)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Logarithmic frequencies times idf; words and shapes scaled to their shares of a unit vector."""
    values = np.log1p(counts) * idf
    for part, share in ((slice(0, WORD_COLUMNS), WORD_SHARE), (slice(WORD_COLUMNS, COLUMNS), 1 - WORD_SHARE)):
        length = np.sqrt((values[:, part] ** 2).sum(axis=1, keepdims=True))
        values[:, part] *= np.float32(share**0.5) / np.maximum(length, np.float32(1e-9))
    return values


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.sqrt((vectors**2).sum(axis=1, keepdims=True)), np.float32(1e-9))


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents and per column how many have it, over all rows."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(COLUMNS, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                total += frequencies(text) > 0
                n += 1
        yield pa.RecordBatch.from_pydict({"column": np.arange(-1, COLUMNS), "n": np.concatenate([[n], total])})

    rows = docs.select("text").mapInArrow(count, "column long, n long").groupBy("column").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(COLUMNS + 1, dtype=np.int64)
    for row in rows:
        found[row["column"] + 1] = row["n"]
    return int(found[0]), found[1:]


def latent_space(vectors: np.ndarray, rank: int = RANK) -> np.ndarray:
    """The ``rank`` leading right singular vectors, as columns, by randomised subspace iteration."""
    rank = min(rank, *vectors.shape)
    basis = np.random.Generator(np.random.PCG64(1)).standard_normal((vectors.shape[1], min(rank + 16, *vectors.shape))).astype(np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(vectors.T @ (vectors @ basis))
    _, _, turn = np.linalg.svd(vectors @ basis, full_matrices=False)
    return (basis @ turn.T)[:, :rank].astype(np.float32)


def vote(vectors: np.ndarray, voters: np.ndarray, labels: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """Similarity-weighted share of label 1 among the ``k`` nearest voters of every row, block by block."""
    k = min(k, len(voters))
    scores = np.empty(len(vectors))
    for start in range(0, len(vectors), BLOCK):
        products = vectors[start : start + BLOCK] @ voters.T
        nearest = np.argpartition(products, len(voters) - k, axis=1)[:, len(voters) - k :]
        weights = np.maximum(np.take_along_axis(products, nearest, axis=1), 0).astype(np.float64) ** SHARPNESS + 1e-12
        scores[start : start + BLOCK] = (weights * labels[nearest]).sum(axis=1) / weights.sum(axis=1)
    return np.clip(scores, 0.0, 1.0)


class Model:
    """What scoring needs, of fixed size: idf, latent space, voters and their labels."""

    def __init__(self, idf: np.ndarray, space: np.ndarray, voters: np.ndarray, labels: np.ndarray):
        self.idf, self.space, self.voters, self.labels = idf, space, voters, labels

    def vectors(self, texts: list[str]) -> np.ndarray:
        return _unit(weighted(_matrix(texts), self.idf) @ self.space)

    def score(self, texts: list[str]) -> np.ndarray:
        """0.5 for every text if nobody votes."""
        if not len(self.voters):
            return np.full(len(texts), 0.5)
        return vote(self.vectors(texts), self.voters, self.labels)


def fit(docs: DataFrame, labels: DataFrame, space: Workspace, voters: int = VOTERS, fitting: int = FITTING) -> Model:
    """Fit on all documents' term counts and on bounded samples of the labelled training rows."""
    texts = docs.select(text_or_empty().alias("text"))
    n, found = document_frequencies(texts)
    idf = np.log((1 + n) / (1 + found)).astype(np.float32) + np.float32(0.1)
    sample = labelled_sample(docs, labels, "quality", voters, space)
    total = sample.count()
    if not total:
        return Model(idf, np.zeros((COLUMNS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))

    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [frequencies(t).astype("<f4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"row": pa.array(rows, pa.binary())})

    few = sample.where(unit_draw(F.col("doc_id"), seed=6) <= min(1.0, fitting / total)).select("text")
    rows = few.mapInArrow(counts, "row binary").collect()
    rows = [r["row"] for r in rows] or [np.zeros(COLUMNS, "<f4").tobytes()]
    model = Model(idf, latent_space(weighted(np.frombuffer(b"".join(rows), "<f4").reshape(-1, COLUMNS).copy(), idf)), None, None)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.column("text").to_pylist()
            placed = [v.astype("<f4").tobytes() for v in model.vectors(some)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "vector": pa.array(placed, pa.binary()), "label": batch.column("label").cast(pa.int32())})

    placed = sample.mapInArrow(place, "doc_id long, vector binary, label int").orderBy("doc_id").collect()
    model.voters = np.frombuffer(b"".join(r["vector"] for r in placed), "<f4").reshape(len(placed), -1)
    model.labels = np.array([r["label"] for r in placed], dtype=np.float64)
    return model


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """All rows and columns of ``docs`` and ``__score``; a null text counts as empty and is scored like any other."""
    columns = docs.columns
    schema = docs.select("*", F.lit(0.0).alias("__score")).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                scores = shared.value.score([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=[*columns, "__score"])

    return docs.mapInArrow(score, schema)


def quality_digest(docs: DataFrame, labels: DataFrame, space: Workspace) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, space)
    scored = score_quality(docs.select("doc_id", text_or_empty().alias("text")), model).drop("text")
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= 0.3).cast("int").alias("predicted"),
    )
