import hashlib
import random

import duckdb
import numpy as np
import pytest
from odd import SCHEMA, odd_rows
from pyspark.sql import functions as F

from matchmart.llm import queries, suffix_dedup

NO_ID = -(2**63)


def plain(rows):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) by a dictionary of all strings."""
    texts = [(NO_ID if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    first = {}
    for doc, text in texts:
        for s in range(len(text) - 49):
            string = text[s : s + 50]
            first[string] = min(doc, first.get(string, doc))
    out = []
    for doc, text in texts:
        gone = bytearray(len(text))
        for s in range(len(text) - 49):
            if first[text[s : s + 50]] < doc:
                gone[s : s + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((None if doc == NO_ID else doc, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages(n=120, seed=2):
    """Texts with shared passages of 40 to 300 bytes cut at odd places, runs of one byte, periodic and binary-like texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    shared = [" ".join(rng.choices(words, k=80)) for _ in range(6)]
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(words, k=rng.randrange(0, 60)))
        for _ in range(rng.randrange(3)):
            at, size = rng.randrange(100), rng.choice([40, 49, 50, 51, 60, 90, 300])
            passage = rng.choice(shared)[at : at + size]
            cut = rng.randrange(len(text) + 1)
            text = text[:cut] + passage + text[cut:]
        if i % 10 == 0:
            text += "a" * rng.randrange(45, 200)
        if i % 10 == 1:
            text += "abcdefg" * rng.randrange(5, 40) + "\x00" * rng.randrange(80)
        rows.append((i, text, "en", "s", len(text)))
    return rows


def run(spark, space, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns({"chunk": F.lit(1), "doc": F.lit(2), "kept": F.lit("x")})
    found = suffix_dedup.remove_repeats(frame, space, **options)
    out = []
    for r in found.collect():
        assert sum(e - s for s, e in r.spans) == r.n_bytes - len(r.kept) and all(a.end < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))
        out.append((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()))
    return sorted(out, key=repr)


def test_equals_brute_force(spark, space):
    assert run(spark, space, odd_rows()) == plain(odd_rows())


def test_passages(spark, space):
    rows = passages() + [(200, None, None, None, None), (3, passages()[5][1], "en", "s", 0), (None, passages()[7][1], "en", "s", 0)]
    expected = plain(rows)
    assert sum(r[2] for r in expected) > 2000
    assert run(spark, space, rows) == expected


def test_small_chunks_and_hot_triggers(spark, space, monkeypatch):
    """The strings of triggers with many phrases are aggregated one by one; the result is the same."""
    rows = passages(60, seed=5)
    assert run(spark, space, rows, hot=0) == plain(rows)
    assert run(spark, space, rows, hot=6) == plain(rows)


def test_empty(spark, nothing, space):
    assert suffix_dedup.repeats_digest(nothing, space).count() == 0
    assert run(spark, space, [(1, None, None, None, None), (2, "", None, None, None)]) == plain([(1, ""), (2, "")])


def test_triggers_depend_on_the_string_alone():
    rng = np.random.default_rng(1)
    for low in (2, 4, 256):
        string = rng.integers(0, low, 50, dtype=np.uint8)
        places = set()
        for _ in range(20):
            before, after = rng.integers(0, low, int(rng.integers(0, 300)), dtype=np.uint8), rng.integers(0, low, 70, dtype=np.uint8)
            places.add(int(suffix_dedup.trigger_places(np.concatenate([before, string, after]))[len(before)]) - len(before))
        assert len(places) == 1 and 0 <= places.pop() <= 34


def test_pieces_line_up(monkeypatch):
    data = np.random.default_rng(4).integers(0, 3, 5000, dtype=np.uint8)
    whole = suffix_dedup.trigger_places(data)
    monkeypatch.setattr(suffix_dedup, "_PIECE", 77)
    assert (suffix_dedup.trigger_places(data) == whole).all()


def test_order_of_dictionary_and_parse_equals_comparing_strings():
    rng = random.Random(3)
    texts = [bytes(rng.choices(b"ab", k=20)) + b"".join(rng.choices([b"the same words here ", b"and there, ", b"x"], k=30)) for _ in range(40)]
    sizes = np.array([len(t) for t in texts])
    found = suffix_dedup.parse(b"".join(texts), sizes)
    rows = suffix_dedup.records(found, np.arange(len(found.at)))
    ids = found.doc.astype(np.int64)
    masks = suffix_dedup.earlier_strings(rows, ids)
    strings, of, before = suffix_dedup.strings_of(rows)
    first = {}
    for s, o in zip(strings, of, strict=True):
        first[s.tobytes()] = min(ids[o], first.get(s.tobytes(), ids[o]))
    expected = np.zeros(len(rows), dtype=np.uint64)
    for s, o, b in zip(strings, of, before, strict=True):
        if first[s.tobytes()] < ids[o]:
            expected[o] |= np.uint64(1 << int(b))
    assert (masks == expected).all() and masks.any()


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_equals_sql(spark, sf):
    found = sorted(tuple(r) for r in queries.QUERIES["op11_suffix_dedup"](spark, f"/root/testdata/{sf}").collect())
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS SELECT * FROM '/root/testdata/{sf}/documents.parquet{'/*' if __import__('os').path.isdir(f'/root/testdata/{sf}/documents.parquet') else ''}'")
        assert found == sorted(db.sql(queries.ORACLES["op11_suffix_dedup"]).fetchall())
