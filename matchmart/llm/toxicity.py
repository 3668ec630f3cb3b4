"""Toxicity: a weighted lexicon matched by Aho-Corasick in folded texts.

Folding lower-cases, maps look-alike letters of other scripts to Latin, and
digits and signs that stand for letters inside a word to those letters. Every
other character becomes a blank, so patterns are anchored at word starts by a
leading blank and may end with one.

The lexicon is learned: beginnings of words and whole words that are far more
frequent in toxic training documents than chance allows. Phrases (an entry's
word with the word before or after it) that training documents use only
harmlessly are exceptions and take their hits back. Weighted hits are
normalised by length, and a logistic curve turns them into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmart.llm.common import held_out, labelled_sample, text_or_empty
from matchmart.llm.shingles import minima, shingle_set
from matchmart.workspace import Workspace

#: about so many labelled training rows at most are used to fit the lexicon
SAMPLE = 20_000
LEAST_CHARS, MOST_CHARS = 3, 9
#: an entry's least log odds, and the toxic training documents that must hold it
LEAST_WEIGHT, LEAST_DOCS = 1.5, 3
#: near-copies among training rows share one of so many pairs of shingle minima
COPY_BANDS = 8

# Look-alikes of Latin letters in Cyrillic and Greek, and digits and signs used for letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "х": "x", "ԛ": "q", "ԝ": "w",
    "α": "a", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
IN_WORD = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}

_FOLD = str.maketrans({**LOOK_ALIKES, **{chr(0xFF41 + i): chr(97 + i) for i in range(26)}})
_DIGITS = str.maketrans(IN_WORD)
#: signs or digits between letters, or before a word of more than one character
_HIDDEN = re.compile(r"(?<=[^\W\d_])[0134578@$!]+(?=[^\W\d_])|(?<![^\W_])[0134578@$]+(?=[^\W\d_][^\W_])")
_LETTERS = re.compile(r"[^\W\d_]+")


def fold(text: str) -> list[str]:
    """The words of a text, folded."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(_FOLD)
    return _LETTERS.findall(_HIDDEN.sub(lambda m: m[0].translate(_DIGITS), text))


def beginnings(word: str) -> list[str]:
    """Patterns that a word matches: its beginnings, and itself with a closing blank."""
    return [f" {word[:n]}" for n in range(LEAST_CHARS, min(len(word), MOST_CHARS) + 1)] + [f" {word} "]


@dataclass
class Lexicon:
    """Weights by pattern, exception phrases, and the curve from normalised hits to a score."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    slope: float = 2.0
    middle: float = -1.0
    _machine: ahocorasick.Automaton | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_machine": None}

    def machine(self) -> ahocorasick.Automaton | None:
        if self._machine is None and self.weights:
            machine = ahocorasick.Automaton()
            for pattern, weight in self.weights.items():
                machine.add_word(pattern, (len(pattern), weight))
            for phrase in self.exceptions:
                machine.add_word(phrase, (len(phrase), 0.0))
            machine.make_automaton()
            self._machine = machine
        return self._machine

    def hits(self, words: list[str]) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the entries in the folded text that no exception covers; the heaviest per start."""
        machine = self.machine()
        if machine is None:
            return []
        best: dict[int, tuple[int, float]] = {}
        spared: list[tuple[int, int]] = []
        for end, (length, weight) in machine.iter(f" {' '.join(words)} "):
            start = end - length + 1
            if weight == 0.0:
                spared.append((start, end))
            elif start not in best or best[start][1] < weight:
                best[start] = (end, weight)
        return [(s, e, w) for s, (e, w) in best.items() if not any(a <= s and e <= b for a, b in spared)]

    def density(self, words: list[str]) -> float:
        """Log of the weighted hits per hundred words."""
        total = sum(w for _, _, w in self.hits(words))
        return math.log(100.0 * total / max(len(words), 1) + 1e-3)

    def score(self, text: str) -> float:
        return 1.0 / (1.0 + math.exp(-self.slope * (self.density(fold(text)) - self.middle)))


def _counts(rows: DataFrame, of, least: int = 1) -> dict[str, int]:
    """Documents per key, where ``of(words)`` gives a document's keys; keys of at least ``least`` documents."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found.update(of(fold(text)))
        yield pa.RecordBatch.from_pydict({"key": list(found), "n": pa.array(list(found.values()), pa.int64())})

    partial = rows.select("text").mapInArrow(count, "key string, n long")
    total = partial.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return {r["key"]: r["n"] for r in total.collect()}


def _evidence(n: int, harmless: int, share: float) -> float:
    """Log likelihood ratio of a pattern's toxic and clean documents against the share of toxic documents."""
    total = n + harmless
    found = n * math.log(n / (total * share))
    return found + (harmless * math.log(harmless / (total * (1 - share))) if harmless else 0.0)


def choose(candidates: dict[str, int], harmless: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Weights of the entries: log odds of patterns whose evidence outweighs the number of patterns tried.

    Of patterns that begin one another the one with the largest support times
    weight is taken; of equals the longest.
    """
    share = n_toxic / (n_toxic + n_clean)
    strict = math.log(max(len(candidates), 1)) + 1.0
    weights = {}
    for pattern, n in candidates.items():
        clean = harmless.get(pattern, 0)
        weight = math.log((n + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
        if weight >= LEAST_WEIGHT and _evidence(n, clean, share) >= strict:
            weights[pattern] = weight
    taken: dict[str, float] = {}
    words: set[str] = set()
    longer: set[str] = set()
    for pattern in sorted(weights, key=lambda p: (-candidates[p] * weights[p], -len(p), p)):
        word = pattern.strip()
        own = {word[:n] for n in range(1, len(word) + 1)}
        if word not in longer and not own & words:
            taken[pattern] = weights[pattern]
            words.add(word)
            longer |= own
    return taken


def _without_near_copies(rows: DataFrame, space: Workspace) -> DataFrame:
    """Drop rows that share a pair of shingle minima with a row of smaller key; texts without words stay."""
    def bands(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column("text").cast(pa.binary()):
                shingles = shingle_set(text.as_py())
                best = minima(shingles)[: 2 * COPY_BANDS].astype(np.uint64) if len(shingles) else np.empty(0, np.uint64)
                found.append(((best[0::2] << np.uint64(32)) | best[1::2]).view(np.int64))
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "bands": pa.array(found, pa.list_(pa.int64()))})

    placed = rows.select("key", "text").mapInArrow(bands, "key long, bands array<long>")
    entries = space.freeze(placed.select("key", F.posexplode("bands").alias("at", "band")), "bands")
    first = entries.groupBy("at", "band").agg(F.min("key").alias("first"))
    copies = entries.join(first, ["at", "band"]).where(F.col("key") != F.col("first")).select("key").distinct()
    return space.freeze(rows.join(copies, "key", "left_anti"), "originals")


def fit_lexicon(docs: DataFrame, labels: DataFrame, space: Workspace, bound: int = SAMPLE) -> Lexicon:
    """Learn entries, exceptions and curve from at most about ``bound`` labelled training rows.

    Copies and near-copies of a text count once. Without toxic or without clean training rows
    the lexicon is empty and every score is low.
    """
    sample = labelled_sample(docs, labels, "toxic", bound, space)
    distinct = sample.groupBy(F.xxhash64("text").alias("key")).agg(F.first("text").alias("text"), F.max("label").alias("label"))
    distinct = _without_near_copies(space.freeze(distinct, "distinct"), space)
    toxic, clean = distinct.where(F.col("label") == 1), distinct.where(F.col("label") == 0)
    n_toxic, n_clean = toxic.count(), clean.count()
    if not n_toxic or not n_clean:
        return Lexicon({})
    candidates = _counts(toxic, lambda words: {p for w in set(words) for p in beginnings(w)}, LEAST_DOCS)
    known = frozenset(candidates)
    harmless = _counts(clean, lambda words: {p for w in set(words) for p in beginnings(w) if p in known})
    lexicon = Lexicon(choose(candidates, harmless, n_toxic, n_clean))
    lexicon.exceptions = _exceptions(lexicon, toxic, clean)
    return _curve(lexicon, distinct)


def _phrases(lexicon: Lexicon, words: list[str]) -> set[str]:
    """Each hit's word with its neighbour before, and after."""
    starts, at = {}, 0
    for i, word in enumerate(words):
        starts[at] = i
        at += len(word) + 1
    found = set()
    for start, _, _ in lexicon.hits(words):
        i = starts[start]
        found.update(f" {' '.join(pair)} " for pair in (words[max(i - 1, 0) : i + 1], words[i : i + 2]) if len(pair) == 2)
    return found


def _exceptions(lexicon: Lexicon, toxic: DataFrame, clean: DataFrame, least: int = 2) -> list[str]:
    """Phrases around hits that ``least`` clean documents and no toxic one use."""
    benign = _counts(clean, lambda words: _phrases(lexicon, words), least)
    if not benign:
        return []
    known = frozenset(benign)
    bad = _counts(toxic, lambda words: _phrases(lexicon, words) & known)
    return sorted(known - bad.keys())


def _curve(lexicon: Lexicon, sample: DataFrame) -> Lexicon:
    """Put the middle of the curve between the two kinds' densities, where fewest training rows fall on the wrong side."""
    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                "density": [lexicon.density(fold(t)) for t in batch.column("text").to_pylist()], "label": batch.column("label").cast(pa.int32()),
            })

    rows = sample.select("text", "label").mapInArrow(measure, "density double, label int").collect()
    values = np.array([r["density"] for r in rows])
    labels = np.array([r["label"] for r in rows])
    edges = np.unique(values)
    above = np.concatenate([[edges[0] - 1.0], (edges[1:] + edges[:-1]) / 2, [edges[-1] + 1.0]])
    wrong = [np.count_nonzero((values > m) != (labels == 1)) for m in above[:: max(1, len(above) // 2000)]]
    lexicon.middle = float(above[:: max(1, len(above) // 2000)][int(np.argmin(wrong))])
    return lexicon


def score_toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """All rows and columns of ``docs`` and ``__score``; a null or empty text has no hits and a low score."""
    columns = docs.columns
    schema = docs.select("*", F.lit(0.0).alias("__score")).schema
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.score(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*columns, "__score"])

    return docs.mapInArrow(score, schema)


def toxicity_digest(docs: DataFrame, labels: DataFrame, space: Workspace) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    lexicon = fit_lexicon(docs, labels, space)
    scored = score_toxicity(docs.select("doc_id", text_or_empty().alias("text")), lexicon).drop("text")
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= 0.5).cast("int").alias("predicted"),
    )
