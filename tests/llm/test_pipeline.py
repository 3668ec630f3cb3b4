from collections import Counter

import pytest
from odd import components_of, kept_text

import __spark_entry__ as contract
import corpus_pipeline
from matchmart.llm.common import table, workspace

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered_once_per_operator():
    names = [n for n in contract.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]


@pytest.fixture(scope="module")
def stages(spark, small):
    """Rows before the first stage and after each."""
    space = workspace(spark)
    docs = table(spark, small, "documents")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = space.freeze(stage(spark, docs, small), name)
        found.append(docs)
    return found


def rows(frame):
    return [tuple(r) for r in frame.select(*COLUMNS).collect()]


def test_all_but_the_last_return_documents(stages):
    assert all(f.columns == COLUMNS for f in stages[:-1])


def test_toxicity_rejects_and_keeps(spark, small, stages):
    before, after = Counter(rows(stages[0])), Counter(rows(stages[1]))
    assert not after - before
    gone = {r[0] for r in before - after}
    labels = {r.doc_id: r.toxic for r in table(spark, small, "labels").collect()}
    clean = [i for i, toxic in labels.items() if toxic == 0]
    assert sum(i in gone for i in clean) <= 0.05 * len(clean)


def test_lines_and_near_copies(stages):
    before, after = rows(stages[1]), rows(stages[2])
    expected = kept_text(before)
    assert {r[0]: r[1] for r in after} == {i: t for i, (_, _, t) in expected.items()}
    assert all(r[4] == len(r[1]) for r in after if expected[r[0]][1])
    components = components_of(after, corpus_pipeline.NEAR)
    assert Counter(rows(stages[3])) == Counter(r for r in after if components[r[0]] == r[0])


def test_mixing_and_packing(stages):
    before, after = Counter(rows(stages[3])), Counter(rows(stages[4]))
    assert after.keys() <= before.keys() and max(after.values()) <= 3
    packed = Counter()
    for r in stages[5].collect():
        packed[r.doc_id] += r.n_tokens
    expected = Counter()
    for (doc, text, *_), n in after.items():
        expected[doc] += n * (len((text or "").encode().split()) + 1)
    assert packed == expected


def test_stages_on_an_empty_table(spark, small):
    docs = table(spark, small, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small).count() == 0
