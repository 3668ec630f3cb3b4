"""Small tables with everything awkward, and plain versions of what the operators compute."""

from __future__ import annotations

import random
from collections import defaultdict

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

COMMON = "A Common Line That Many Documents Hold, word for word"


def odd_rows() -> list[tuple]:
    """Null id, text and source, empty and blank texts, a long text, repeated rows, copies, near-copies, common lines."""
    rng = random.Random(4)
    words = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(400)]
    long = " ".join(rng.choices(words, k=6000))
    base = rng.choices(words, k=500)
    texts: list[str | None] = [None, "", "  \t ", "one", "Two Words\n", "three little words", long, long, "Éa ÀB\n" + COMMON, "İstanbul ΑΣ ﬁ"]
    texts += [COMMON.upper() + f" \n{i}\n{COMMON}" if i % 2 else f"{i}\n  {COMMON}\t" for i in range(8)]
    for i in range(12):
        copy = list(base)
        for _ in range(i):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        texts.append(" ".join(copy))
    texts += [" ".join(rng.choices(words, k=rng.randrange(1, 200))) for _ in range(20)]
    rows = [(i * 3, t, "en", f"s{i % 4}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[6], rows[20]]
    rows.append((None, "a text without an id", None, "s1", None))
    rng.shuffle(rows)
    return rows


def odd_docs(spark, parts: int = 3):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(parts)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def key_of(line: str) -> str:
    return line.strip(BLANKS).translate(LOWER)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles_of(text: str | None) -> set:
    words = words_of(text)
    if not words:
        return set()
    return set(zip(*[words[i:] for i in range(5)], strict=False)) if len(words) >= 5 else {tuple(words)}


def components_of(rows, least: int) -> dict:
    """Smallest reachable id by id (null as -2**63), by comparing all pairs."""
    sets = [(-(2**63) if r[0] is None else r[0], shingles_of(r[1])) for r in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (a, one) in enumerate(sets):
        for b, other in sets[:n]:
            if one and other and 100 * len(one & other) >= least * len(one | other):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def kept_text(rows, least_chars: int = 40, least_docs: int = 5) -> dict:
    holders = defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= least_chars:
                holders[key_of(line)].add(-(2**63) if i is None else i)
    top = {k: max(v) for k, v in holders.items() if len(v) >= least_docs}
    out = {}
    for i, text, *_ in rows:
        own = -(2**63) if i is None else i
        lines = (text or "").split("\n")
        kept = [line for line in lines if top.get(key_of(line), own) == own]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out
