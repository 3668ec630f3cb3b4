import binascii
import hashlib
from collections import defaultdict

import numpy as np
import pytest
from odd import SCHEMA, odd_rows
from pyspark.sql import functions as F

from matchmart.llm import merkle, queries


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    doc, text, lang, source, n = row
    fields = [None if v is None else str(v) for v in (doc, source, lang, n, text)]
    return h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in fields])


def tree_of(row):
    levels = [row]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def path_of(levels, at):
    """Per level the place in the run and the run without it."""
    out = []
    for row in levels[:-1]:
        run = row[at // 3 * 3 : at // 3 * 3 + 3]
        out.append((at % 3, run[: at % 3] + run[at % 3 + 1 :]))
        at //= 3
    return out


def expected(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append((-(2**63) if r[0] is None else r[0], leaf_of(r), r))
    trees = {s: (sorted(v), tree_of([x[1] for x in sorted(v)])) for s, v in by.items()}
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    top = tree_of([trees[s][1][-1][0] for s in names])
    out = []
    for place, s in enumerate(names):
        ordered, levels = trees[s]
        for at, (_, leaf, row) in enumerate(ordered):
            path = path_of(levels, at) + path_of(top, place)
            folded = leaf
            if row[0] is not None and binascii.crc32(str(row[0]).encode()) % 2 == 0 and row[1] is not None:
                folded = leaf_of((row[0], row[1].replace("\n", ""), *row[2:]))
            for k, others in path:
                folded = h(*others[:k], folded, *others[k:])
            out.append((row[0], leaf, levels[-1][0], top[-1][0], h(*[x for _, others in path for x in others]), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def test_equals_brute_force(docs, space):
    found = [tuple(r) for r in merkle.manifest_digest(docs.withColumns({"tree": F.lit(1), "leaf": F.lit(2), "at": F.lit(3)}), space).collect()]
    assert sorted(found, key=repr) == expected(odd_rows())
    assert {r[-1] for r in found} == {True, False}


def test_empty_and_single(spark, nothing, space):
    assert merkle.manifest_digest(nothing, space).count() == 0
    row = (7, "a\nb", None, None, 3)
    assert [tuple(r) for r in merkle.manifest_digest(spark.createDataFrame([row], SCHEMA), space).collect()] == expected([row])


@pytest.mark.parametrize("n", [730, 2500])
def test_several_rounds(spark, space, n):
    """Trees of one, two and more subtrees, one source with most rows, many sources with one."""
    rows = [(i, f"text {i}\n{i % 7}", "en", f"s{i}" if i % 2 else "hot", i) for i in range(n)]
    rows += [(i, "more\n", "de", "hot", None) for i in range(n, n + 800)] + [(5, "same", "en", "hot", 1)] * 40
    found = [tuple(r) for r in merkle.manifest_digest(spark.createDataFrame(rows, SCHEMA).repartition(5), space).collect()]
    assert sorted(found, key=repr) == expected(rows)


@pytest.mark.parametrize("levels", range(1, 8))
def test_layout_is_a_permutation_of_aligned_subtrees(levels):
    spots = [merkle.address(d, np.arange(3**d), levels) for d in range(levels)]
    assert sorted(np.concatenate(spots)) == list(range(merkle.nodes_in(levels)))
    # the upper half comes first, and each lower subtree stands together
    upper = max(1, levels // 2)
    assert max(s.max() for s in spots[:upper]) == merkle.nodes_in(upper) - 1 or levels == 1
    size = merkle.nodes_in(levels - upper)
    for top in range(3**upper if levels > 1 else 0):
        inside = np.concatenate([spots[d][top * 3 ** (d - upper) : (top + 1) * 3 ** (d - upper)] for d in range(upper, levels)])
        assert inside.max() - inside.min() == size - 1


def test_query_on_given_tables(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    found = [tuple(r) for r in queries.QUERIES["op12_manifest"](spark, small).collect()]
    assert sorted(found, key=repr) == expected([tuple(r) for r in docs.collect()])
