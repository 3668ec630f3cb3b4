"""Language-model scores from Brown classes: exchange clustering of word types, then class bigrams.

Word types. Words that make up at least ``FREQUENT`` of all training tokens are
types of their own - at most 1 / ``FREQUENT`` of them, whatever the corpus. All
other words, seen or not, belong to a type given by their ending and kind; there
are ``ENDINGS`` of these. The document end is a type and a class of its own.

Clustering. Counts of type pairs over all training tokens are gathered by Spark
and stored by type. Classes start from frequency and are improved by exchange:
in every round each type's counts of left and right neighbours by class are
compared with the class bigram counts, and the type moves to the class where
the likelihood of the class bigrams gains most. The types of one half move at a
time, all against the counts of the round before.

Score. log10 P(text) = sum of log10 P(class | class before) + log10 P(word | class).
Class transitions are interpolated with class frequencies. A frequent word's
share of its class is its relative count; other words have their type's share,
times (c + 1) / (N_t + V_t + 1) within it: the type's tokens, its distinct
training words, and one place for all words never seen. The counts of infrequent words are
joined to the documents by word hash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmart.llm.common import held_out, text_or_empty
from matchmart.workspace import Workspace

CLASSES = 64
FREQUENT = 2e-5
ENDINGS = 2048
ROUNDS = 8
#: weight of the class bigram against the class frequency
BIGRAM_WEIGHT = 0.98
#: distinct words a task counts before it hands them on
_HELD = 500_000


def tokens_of(text: str) -> list[bytes]:
    """Words between ASCII blanks, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


def ending(word: bytes) -> int:
    """The type of an infrequent word, 0 to ENDINGS - 1: its last three bytes, and whether it is short."""
    return xxhash.xxh3_64_intdigest(word[-3:] + (b"<" if len(word) < 8 else b">")) % ENDINGS


class Types(dict):
    """Word to type: 0 is the document end, then the endings, then the frequent words. Endings are worked out when met."""

    def __init__(self, frequent: list[bytes]):
        super().__init__()
        self.frequent = frequent
        self.size = 1 + ENDINGS + len(frequent)
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.update((w, 1 + ENDINGS + i) for i, w in enumerate(self.frequent))

    def __missing__(self, word: bytes) -> int:
        if len(self) > _HELD:
            self.reset()
        found = self[word] = 1 + ending(word)
        return found

    def __reduce__(self):
        return Types, (self.frequent,)

    def sequence(self, words: list[bytes]) -> np.ndarray:
        """Types of a text's tokens, the end included."""
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


def count_words(texts: DataFrame, space: Workspace) -> DataFrame:
    """(word, c): how often every word occurs. Tasks add up what they meet before it moves."""
    def flush(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], names=["word", "n"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found.update(tokens_of(text))
                if len(found) > _HELD:
                    yield flush(found)
                    found = Counter()
        yield flush(found)

    return space.freeze(texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")), "words")


def count_pairs(texts: DataFrame, types: Types, space: Workspace) -> DataFrame:
    """(type, other, right, left): how often ``other`` follows and precedes ``type``."""
    size = types.size
    shared = texts.sparkSession.sparkContext.broadcast(types)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0

        def flush() -> pa.RecordBatch:
            codes, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])

        for batch in batches:
            for text in batch.column("text").to_pylist():
                chain = np.concatenate([[0], shared.value.sequence(tokens_of(text)), [0]])
                held.append(chain[:-1] * size + chain[1:])
                n += len(chain) - 1
                if n > 4_000_000:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()

    pairs = space.freeze(texts.mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")), "pairs")
    first, second = F.floor(F.col("code") / size).cast("int"), (F.col("code") % size).cast("int")
    right = pairs.select(first.alias("type"), second.alias("other"), F.col("n").alias("right"), F.lit(0).cast("long").alias("left"))
    left = pairs.select(second.alias("type"), first.alias("other"), F.lit(0).cast("long").alias("right"), F.col("n").alias("left"))
    return right.union(left)


def _context(pairs: DataFrame, classes: np.ndarray) -> DataFrame:
    """(type, class, right, left): neighbour counts of every type by class."""
    table = pairs.sparkSession.createDataFrame(pd.DataFrame({"other": np.arange(len(classes), dtype=np.int32), "class": classes.astype(np.int32)}))
    # at most one row per type: 1 / FREQUENT + ENDINGS + 1
    return pairs.join(F.broadcast(table), "other").groupBy("type", "class").agg(F.sum("right").alias("right"), F.sum("left").alias("left"))


def _xlogx(values: np.ndarray) -> np.ndarray:
    return np.where(values > 0, values * np.log(np.maximum(values, 1e-300)), 0.0)


def best_class(right: np.ndarray, left: np.ndarray, own: int, total: int, bigrams: np.ndarray, sizes: np.ndarray) -> int:
    """The class a type of class ``own`` should move to, from its neighbours' counts by class and the class bigram counts.

    The likelihood of the class bigrams is the sum of n(c, d) log n(c, d) minus
    twice the sum of n(c) log n(c); the change is worked out with the type taken
    out of its class.
    """
    table, size = bigrams.astype(np.float64).copy(), sizes.astype(np.float64).copy()
    table[own] -= right
    table[:, own] -= left
    np.maximum(table, 0, out=table)
    size[own] -= total
    after, before = _xlogx(table + right) - _xlogx(table), _xlogx(table.T + left) - _xlogx(table.T)
    np.fill_diagonal(after, 0.0)
    np.fill_diagonal(before, 0.0)
    inner = table.diagonal()
    gain = after.sum(axis=1) + before.sum(axis=1) + _xlogx(inner + right + left) - _xlogx(inner)
    gain -= 2 * (_xlogx(size + total) - _xlogx(np.maximum(size, 0)))
    gain[0] = -np.inf  # the end's own class
    best = int(gain.argmax())
    return best if gain[best] > gain[own] + 1e-9 else own


def _mover(classes: np.ndarray, bigrams: np.ndarray, sizes: np.ndarray):
    """From batches of types with the lists of their context to the class each moves to."""
    def move(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, to = batch.column("type").to_pylist(), []
            for kind, near in zip(kinds, batch.column("near").to_pylist(), strict=True):
                right, left = np.zeros(len(sizes)), np.zeros(len(sizes))
                for entry in near:
                    right[entry["class"]], left[entry["class"]] = entry["right"], entry["left"]
                to.append(best_class(right, left, int(classes[kind]), int(right.sum()), bigrams, sizes))
            yield pa.RecordBatch.from_arrays([batch.column("type"), pa.array(to, pa.int32())], names=["type", "to"])

    return move


def exchange(pairs: DataFrame, counts: np.ndarray, space: Workspace, n_classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Classes by type, and the class bigram counts.

    Class 0 holds the document end alone. What comes to the driver is a class
    per type and the bigram counts of the classes.
    """
    size = len(counts)
    order = np.argsort(-counts[1:], kind="stable") + 1
    classes = np.zeros(size, dtype=np.int64)
    classes[order] = 1 + np.arange(size - 1) % max(1, n_classes - 1)
    pairs = space.freeze(pairs.repartition("type"), "neighbours")

    def bigram_counts(context: DataFrame) -> np.ndarray:
        table = pairs.sparkSession.createDataFrame(pd.DataFrame({"type": np.arange(size, dtype=np.int32), "own": classes.astype(np.int32)}))
        found = np.zeros((n_classes, n_classes))
        for row in context.join(F.broadcast(table), "type").groupBy("own", "class").agg(F.sum("right").alias("n")).collect():
            found[row["own"], row["class"]] = row["n"]
        return found

    for turn in range(rounds):
        context = space.freeze(_context(pairs, classes), "context")
        bigrams = bigram_counts(context)
        sizes = np.maximum(bigrams.sum(axis=0), bigrams.sum(axis=1))
        half = context.where((F.col("type") != 0) & (F.pmod(F.xxhash64("type", F.lit(turn // 2)), F.lit(2)) == turn % 2))
        # a list has an entry per class at most
        near = half.groupBy("type").agg(F.collect_list(F.struct("class", "right", "left")).alias("near"))
        moved = near.mapInArrow(_mover(classes.copy(), bigrams, sizes), "type int, to int").collect()
        still = sum(classes[r["type"]] == r["to"] for r in moved)
        for row in moved:
            classes[row["type"]] = row["to"]
        if turn % 2 and still == len(moved):
            break
    return classes, bigram_counts(_context(pairs, classes))


@dataclass
class ClassModel:
    """The trained model; all arrays are by type or class, and so of bounded size."""

    types: Types
    counts: np.ndarray  # training tokens by type
    words: np.ndarray  # distinct training words by type
    classes: np.ndarray
    bigrams: np.ndarray

    def __post_init__(self) -> None:
        self.tokens = float(self.counts.sum())
        self.distinct = float(self.words.sum())
        sizes = self.bigrams.sum(axis=0)
        share = (sizes + 0.5) / (sizes.sum() + 0.5 * len(sizes))
        rows = self.bigrams.sum(axis=1, keepdims=True)
        follow = np.where(rows > 0, self.bigrams / np.maximum(rows, 1), share)
        self.transition = np.log10(BIGRAM_WEIGHT * follow + (1 - BIGRAM_WEIGHT) * share)
        # every type has half a token more, so that no text is impossible
        weight = self.counts + np.where(np.arange(len(self.counts)) <= ENDINGS, 0.5, 0.0)
        total = np.bincount(self.classes, weights=weight, minlength=len(sizes))
        self.emission = np.log10(weight / total[self.classes])
        #: log10 of what (c + 1) is divided by, within the type of an infrequent word
        self.inside = np.where(np.arange(len(self.counts)) <= ENDINGS, np.log10(self.counts + self.words + 1), 0.0)
        self.inside[0] = 0.0
        self.base = math.log10(self.tokens + self.distinct + 1)
        #: log10 (c + 1) of the types that are one word
        self.own = np.where(np.arange(len(self.counts)) > ENDINGS, np.log10(self.counts + 1), 0.0)
        self.own[0] = math.log10(self.counts[0] + 1)

    def parts(self, chain: np.ndarray) -> tuple[float, float, int]:
        """Score and base score without the counts of infrequent words, and the known tokens among the others."""
        classes = self.classes[chain]
        before = np.concatenate([[0], classes[:-1]])
        score = self.transition[before, classes].sum() + self.emission[chain].sum() - self.inside[chain].sum()
        single = (chain > ENDINGS) | ((chain == 0) & (self.counts[0] > 0))
        return float(score), float(self.own[chain].sum() - len(chain) * self.base), int(np.count_nonzero(single))


def train(docs: DataFrame, space: Workspace, n_classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[ClassModel, DataFrame]:
    """The model of all rows ``(text)``, and the table ``(key, c)`` of the infrequent words' counts."""
    words = count_words(docs, space)
    ends = docs.count()
    total = words.agg(F.sum("c").alias("n")).first()["n"] or 0
    n_tokens = total + ends
    least = max(1.0, n_tokens * FREQUENT)
    top = words.where(F.col("c") >= least).orderBy(F.desc("c"), "word").collect()
    types = Types([bytes(r["word"]) for r in top])
    counts, distinct = np.zeros(types.size, dtype=np.int64), np.zeros(types.size, dtype=np.int64)
    counts[0], distinct[0] = ends, int(ends > 0)
    counts[1 + ENDINGS :], distinct[1 + ENDINGS :] = [r["c"] for r in top], 1

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.column("word").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([word_hash(w) for w in some], pa.int64()), pa.array([1 + ending(w) for w in some], pa.int32()), batch.column("c")],
                names=["key", "type", "c"],
            )

    rare = space.freeze(words.where(F.col("c") < least).mapInArrow(place, "key long, type int, c long"), "rare")
    for row in rare.groupBy("type").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
        counts[row["type"]], distinct[row["type"]] = row["c"], row["v"]
    pairs = count_pairs(docs, types, space)
    classes, bigrams = exchange(pairs, counts, space, n_classes, rounds)
    return ClassModel(types, counts, distinct, classes, bigrams), rare.select("key", "c")


SCORED = "row long, doc_id long, n_tokens long, score double, base double, known long, keys array<long>, times array<int>"


def score_documents(docs: DataFrame, model: ClassModel, rare: DataFrame, space: Workspace) -> DataFrame:
    """Per row of ``(row, doc_id, text)``: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    ``row`` tells the rows apart.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                rows, keys, times = [], [], []
                for text in part.column("text").to_pylist():
                    words = tokens_of(text)
                    chain = np.append(scorer.types.sequence(words), 0)
                    known = scorer.parts(chain)
                    seldom = Counter(words[i] for i in np.flatnonzero(chain[:-1] <= ENDINGS))
                    rows.append((len(chain), *known))
                    keys.append([word_hash(w) for w in seldom])
                    times.append(list(seldom.values()))
                n, own, base, known = zip(*rows, strict=True) if rows else ([], [], [], [])
                yield pa.RecordBatch.from_arrays([
                    part.column("row"), part.column("doc_id"), pa.array(n, pa.int64()), pa.array(own, pa.float64()),
                    pa.array(base, pa.float64()), pa.array(known, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32())),
                ], names=[c.split()[0] for c in SCORED.split(", ")])

    scored = space.freeze(docs.mapInArrow(score, SCORED), "scored")
    entries = scored.select("row", F.inline(F.arrays_zip(F.col("keys").alias("key"), F.col("times").alias("n"))))
    found = entries.join(rare, "key").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.col("c") + F.lit(1.0))).alias("log"), F.sum("n").alias("n")
    )
    log, n = F.coalesce("log", F.lit(0.0)), F.coalesce("n", F.lit(0))
    return scored.drop("keys", "times").join(found, "row", "left").select(
        "row", "doc_id", "n_tokens", (F.col("known") + n).alias("n_known"), F.lit(int(model.tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + log).alias("base_score"), (F.col("score") + log).alias("score"),
    )


def language_digest(docs: DataFrame, space: Workspace) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null text counts as empty: its one token is the end. Without any training
    document all words are unknown. Repeated rows score alike and all stay.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    aside = held_out(F.col("doc_id"), 7, 2)
    model, rare = train(rows.where(~aside).select("text"), space)
    # unique, and written with the scores before it is used
    keyed = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return score_documents(keyed, model, rare, space).withColumn("held_out", aside).drop("row")
