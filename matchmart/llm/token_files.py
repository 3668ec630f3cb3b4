"""Token-id files: flat unsigned integers and 64-bit document offsets, written and memory-mapped per partition.

Documents are sorted by id in ranges. The task of a range writes three files:
``.bin`` with the ids of its documents one after another as little-endian
unsigned integers (16 bits if the vocabulary allows, else 32), ``.idx`` with
the unsigned 64-bit offset of each document's first id within the range and the
end, ``.doc`` with the document ids as signed 64-bit integers. The manifest has
one row per range; prefix sums over it give the base of a range, which added to
its offsets makes them offsets of the whole corpus.

Files are written in the shared folder under names of one attempt, and only an
attempt whose row reaches the manifest counts, so lost executors and repeated
tasks leave no trace in the result.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchmart.llm.common import NO_ID, text_or_empty
from matchmart.workspace import Workspace

END_ID = 1
#: entries of a worker's memory of encoded chunks before it starts anew
MEMORY = 300_000
#: letters that lower-case to one letter and have one normal form, then punctuation that forms one run
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?%&*#$|]*)")
_ACCENTED = [chr(c) for c in range(0xC0, 0x100) if chr(c).isalpha()]
MANIFEST = "part int, name string, n_docs long, n_tokens long, width int"


class ChunkEncoder:
    """Whole texts to id bytes, remembering the ids of each chunk between spaces and line feeds.

    The vocabulary drops white space and never joins across it, so a text's ids
    are those of its chunks. Chunks of plain letters with trailing punctuation
    are encoded by word, straight by the vocabulary's model.
    """

    def __init__(self, path: str, memory: int = MEMORY):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.kind = "H" if self.dtype.itemsize == 2 else "I"
        self.model = self.tokenizer.model
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.alphabet = {ord(c): spell(c)[0][0] for c in _ACCENTED}
        self.memory = memory
        self.chunks: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {"": b""}

    def _bytes(self, ids: list[int]) -> bytes:
        return array(self.kind, ids).tobytes()

    def _one_by_one(self, chunks: list[str]) -> list[bytes]:
        return [self._bytes(e.ids) for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        """One run of letters or of punctuation is one unit of the vocabulary's model, given in its byte alphabet."""
        spelt = word if word.isascii() else word.translate(self.alphabet)
        return self._bytes([t.id for t in self.model.tokenize(spelt)])

    def _learn(self, chunks: set[str]) -> None:
        plain: list[tuple[str, str, str]] = []
        rest: list[str] = []
        for chunk in chunks:
            found = _PLAIN.fullmatch(chunk)
            if found:
                plain.append((chunk, found[1].lower(), found[2]))
            else:
                rest.append(chunk)
        if len(self.words) > self.memory:
            self.words = {"": b""}
        words = self.words
        for word in {w for _, word, mark in plain for w in (word, mark) if w not in words}:
            words[word] = self._word(word)
        self.chunks.update((chunk, words[word] + words[mark]) for chunk, word, mark in plain)
        if rest:
            self.chunks.update(zip(rest, self._one_by_one(rest), strict=True))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            parts = text.replace("\n", " ").split(" ")
            missing = {c for c in parts if c not in self.chunks}
            if missing:
                if len(self.chunks) > self.memory:
                    self.chunks = {"": b""}
                    missing = {c for c in parts if c not in self.chunks}
                self._learn(missing)
            yield b"".join(map(self.chunks.__getitem__, parts))


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def _locate(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _mapped(uri: str, dtype: str) -> np.ndarray:
    """The file as an array: memory-mapped where it is a local or mounted file, else read."""
    place, path = _locate(uri)
    if place.get_file_info(path).size == 0:
        return np.empty(0, dtype=dtype)
    if isinstance(place, arrow_fs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r")
    with place.open_input_file(path) as source:
        return np.frombuffer(source.read_buffer(), dtype=dtype)


def write_token_files(docs: DataFrame, space: Workspace, vocabulary: str, end_id: int = END_ID, folder: str | None = None) -> DataFrame:
    """Write the files; return the manifest ``(part, name, n_docs, n_tokens, width, first_doc, first_token)``.

    Documents go in ascending id order, a null id first, rows of one id by
    text. A null text counts as empty; every document ends with ``end_id``. An
    empty table gives an empty manifest. In ``.doc`` the smallest 64-bit
    integer stands for null.
    """
    spark = docs.sparkSession
    folder = folder or space.fresh("tokens")
    remover = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    remover.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(remover)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        end = np.asarray([end_id], dtype=coder.dtype).tobytes()
        name = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        place, path = _locate(name)
        n_docs, at, opened = 0, 0, []
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if not opened:
                    opened = [place.open_output_stream(path + kind) for kind in (".bin", ".idx", ".doc")]
                lengths = np.empty(batch.num_rows, dtype="<i8")
                for i, ids in enumerate(coder.encode(batch.column("text").to_pylist())):
                    opened[0].write(ids + end)
                    lengths[i] = len(ids) // coder.dtype.itemsize + 1
                offsets = at + np.cumsum(lengths)
                opened[1].write(np.concatenate([[at], offsets[:-1]]).astype("<u8").tobytes())
                opened[2].write(np.asarray(batch.column("doc_id").fill_null(NO_ID)).astype("<i8").tobytes())
                at, n_docs = int(offsets[-1]), n_docs + batch.num_rows
            if opened:
                opened[1].write(np.asarray([at], dtype="<u8").tobytes())
        finally:
            for stream in opened:
                stream.close()
        if opened:
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "name": [name], "n_docs": [n_docs],
                 "n_tokens": [at], "width": pa.array([coder.dtype.itemsize], pa.int32())}
            )

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    )
    manifest = space.freeze(ordered.mapInArrow(write, MANIFEST), "manifest")
    # one row per file: a short table
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return space.freeze(manifest.withColumns({
        "first_doc": F.coalesce(F.sum("n_docs").over(before), F.lit(0)),
        "first_token": F.coalesce(F.sum("n_tokens").over(before), F.lit(0)),
    }), "bases")


def read_token_files(manifest: DataFrame, files: int) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 of the ids as 32-bit integers."""
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            offsets, ids = _mapped(row["name"] + ".idx", "<u8"), _mapped(row["name"] + ".doc", "<i8")
            tokens = _mapped(row["name"] + ".bin", f"<u{row['width']}")
            for first in range(0, row["n_docs"], 5000):
                last = min(first + 5000, row["n_docs"])
                edges = offsets[first : last + 1].astype("i8")
                sums = [zlib.crc32(tokens[a:b].astype("<u4").tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                own = np.asarray(ids[first:last])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(own, mask=own == NO_ID), "start": edges[:-1] + row["first_token"],
                    "n_tokens": np.diff(edges), "ids_crc32": pa.array(sums, pa.int64()),
                })

    spread = manifest.repartition(max(1, files), "part")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digest(docs: DataFrame, space: Workspace, vocabulary: str) -> DataFrame:
    """Write the token files of ``docs`` and return what they hold per document."""
    manifest = write_token_files(docs, space, vocabulary)
    return read_token_files(manifest, manifest.count())
