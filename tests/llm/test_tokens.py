import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import odd_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from matchmart.llm import queries
from matchmart.llm.token_files import ChunkEncoder, read_token_files, token_digest, write_token_files

PATH = public_tokenizers.path(queries.VOCABULARY)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def expected(tokenizer, rows):
    at, out = 0, []
    for doc, text in sorted(rows, key=lambda r: (-(2**63) if r[0] is None else r[0], r[1])):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        out.append((doc, at, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_files_hold_what_the_tokenizer_says(docs, space, tokenizer):
    found = {tuple(r) for r in token_digest(docs, space, PATH).collect()}
    assert found == set(expected(tokenizer, [(r[0], r[1] or "") for r in odd_rows()]))


def test_bases_are_prefix_sums(spark, docs, space):
    manifest = write_token_files(docs, space, PATH)
    rows = sorted(manifest.collect())
    at = docs_before = 0
    for r in rows:
        assert (r.first_token, r.first_doc) == (at, docs_before)
        at, docs_before = at + r.n_tokens, docs_before + r.n_docs
    assert docs_before == len(odd_rows())
    assert read_token_files(manifest, 2).agg(F.sum("n_tokens")).first()[0] == at


def test_empty_table_and_other_columns(spark, nothing, docs, space):
    assert token_digest(nothing, space, PATH).count() == 0
    assert token_digest(docs.withColumns({"start": F.lit(1), "part": F.lit("x")}), space, PATH).count() == len(odd_rows())


CODER = ChunkEncoder(PATH, memory=50)
WHOLE = Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcXYZ .,'\n\t É́ßſİΣςﬁ１²<|>s"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_chunks_equal_the_whole(text):
    for own in (text, text + "<|endoftext|> don't <|startoftext|>x 's"):
        ids = np.frombuffer(next(CODER.encode([own])), CODER.dtype).tolist()
        assert ids == WHOLE.encode(own, add_special_tokens=False).ids


def test_query_on_given_tables(spark, small, tokenizer):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert {tuple(r) for r in queries.QUERIES["op2_token_files"](spark, small).collect()} == set(expected(tokenizer, rows))
