"""Token ids in Arrow files of fixed-size-list batches.

Documents are dealt by range of their ids, so every task writes one file and the files follow each other in id order.  A file
holds the task's ids as one stream cut into sequences of equal length with a mask of real ids (the last sequence is filled up),
and its documents' first places and lengths.  Readers map a file and slice any sequence or document without copying.
"""

from __future__ import annotations

import os
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.ipc as ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stagewatch.functions.scratch import new_path, stored
from stagewatch.llm.common import as_bytes, filesystem

SEQUENCE = 1024
#: Sequences in one record batch of a file.
BATCH_SEQUENCES = 256
END_ID = 1
#: Words whose ids a worker remembers, twice: when so many are new, what was remembered before the last such time goes.
REMEMBERED = 450_000


def _byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level vocabularies use for each byte, as a table for str.translate."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class WordEncoder(dict):
    """Ids of words, as bytes of the narrowest unsigned type; encodes a word that is asked for the first time.

    No token of a tokenizer that drops white space spans two words, so a text's ids are its words' ids in order.  In the same
    way a word of Latin letters with punctuation behind it is two pre-tokens: the letters, in lower case, and the marks.
    """

    LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ")
    MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, tokenizer_file: str) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = self.tokenizer.model
        self.alphabet = _byte_alphabet()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.older: dict[bytes, bytes] = {}

    def _packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes() if sys.byteorder == "little" else np.array(ids, dtype=self.dtype).tobytes()

    def _whole(self, word: bytes) -> bytes:
        return self._packed(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)

    def _letters(self, word: bytes) -> bytes | None:
        """Ids of a word of Latin letters, straight from the merges; None for any other word."""
        if word.isalpha():
            coded = word.lower().decode()
        else:
            text = word.decode()
            if not self.LETTERS.issuperset(text):
                return None
            coded = text.lower().encode().decode("latin-1").translate(self.alphabet)
        return self._packed([t.id for t in self.model.tokenize(coded)])

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None and b"<|" not in word:
            stem = word.rstrip(self.MARKS)
            if stem and stem != word and (stem[-1:].isalnum() or stem[-2:].decode(errors="replace") in self.LETTERS):
                seen = stem in self
                ids = self[stem] + self[word[len(stem):]]
                if not seen:  # remember only what is likely to come again
                    return ids
        if ids is None:
            ids = self._letters(word)
        if ids is None:
            ids = self._whole(word)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


_encoders: dict[str, WordEncoder] = {}


def encoder(tokenizer_file: str) -> WordEncoder:
    """This worker's encoder; it outlives a task, so later tasks find its words."""
    if tokenizer_file not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[tokenizer_file] = WordEncoder(tokenizer_file)
    return _encoders[tokenizer_file]


class SequenceWriter:
    """Writes a stream of ids as fixed-size-list batches of ``length`` ids and masks."""

    def __init__(self, sink: pa.NativeFile, dtype: np.dtype, length: int) -> None:
        self.length, self.dtype = length, dtype
        self.ids = pa.list_(pa.from_numpy_dtype(dtype), length)
        self.schema = pa.schema([("ids", self.ids), ("mask", pa.list_(pa.bool_(), length))])
        self.writer = ipc.new_file(sink, self.schema)
        self.parts: list[bytes] = []
        self.size = 0

    def add(self, ids: bytes) -> None:
        self.parts.append(ids)
        self.size += len(ids)
        whole = self.length * self.dtype.itemsize * BATCH_SEQUENCES
        if self.size >= whole:
            held = b"".join(self.parts)
            cut = len(held) // whole * whole
            for at in range(0, cut, whole):
                self._write(held[at:at + whole])
            self.parts, self.size = [held[cut:]], len(held) - cut

    def _write(self, ids: bytes) -> None:
        width = self.length * self.dtype.itemsize
        n, missing = len(ids) // self.dtype.itemsize, -len(ids) % width
        values = np.frombuffer(ids + bytes(missing), dtype=self.dtype)
        mask = np.arange(len(values)) < n
        self.writer.write_batch(pa.RecordBatch.from_arrays([
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.length), pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
        ], schema=self.schema))

    def close(self) -> None:
        if self.size:
            self._write(b"".join(self.parts))
        self.writer.close()


def write_token_files(
    docs: DataFrame, tokenizer_file: str, folder: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID,
    length: int = SEQUENCE,
) -> DataFrame:
    """Write ``docs`` below ``folder``; returns the manifest: part, path, docs_path, documents, ids (one row per file).

    A task's attempt writes files with names of its own; only those in the manifest count, so a task that runs again leaves
    files that nobody reads, never a wrong result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.xxhash64(text).alias("tie"),
                       F.monotonically_increasing_id().alias("row"))
    # Equal rows, however many, are told apart by their place in the input, so that no range must hold them all.
    order = ("doc_id", "tie", "row")
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_file)
        end = np.array([end_id], dtype=words.dtype).tobytes()
        part = TaskContext.get().partitionId()
        system, root = filesystem(folder)
        path, docs_path = (f"{root}/part-{part:06d}-{uuid.uuid4().hex}.{kind}.arrow" for kind in ("ids", "docs"))
        sink = writer = docs_sink = docs_writer = None
        at = documents = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                system.create_dir(root, recursive=True)
                sink, docs_sink = system.open_output_stream(path), system.open_output_stream(docs_path)
                writer = SequenceWriter(sink, words.dtype, length)
                schema = pa.schema([("doc_id", batch.column(0).type), ("first", pa.int64()), ("n_tokens", pa.int64())])
                docs_writer = ipc.new_file(docs_sink, schema)
            first, sizes = [], []
            for text in as_bytes(batch.column(1)):
                ids = words.encode(text or b"") + end
                writer.add(ids)
                first.append(at)
                sizes.append(len(ids) // words.dtype.itemsize)
                at += sizes[-1]
            documents += batch.num_rows
            docs_writer.write_batch(pa.RecordBatch.from_arrays([batch.column(0), pa.array(first), pa.array(sizes)], schema=schema))
        if writer is not None:
            writer.close()
            docs_writer.close()
            sink.close()
            docs_sink.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([path]), pa.array([docs_path]), pa.array([documents]), pa.array([at])],
                ["part", "path", "docs_path", "documents", "ids"],
            )

    manifest = ordered.mapInArrow(write, "part bigint, path string, docs_path string, documents bigint, ids bigint")
    return stored(manifest, "token-manifest")


def _open(system: pafs.FileSystem, path: str) -> ipc.RecordBatchFileReader:
    local = isinstance(system, pafs.LocalFileSystem)
    return ipc.open_file(pa.memory_map(path) if local else system.open_input_file(path))


class TokenFile:
    """Random access to one file's sequences and documents."""

    def __init__(self, folder: str, path: str) -> None:
        system, _ = filesystem(folder)
        self.reader = _open(system, path)
        self.length = self.reader.schema.field("ids").type.list_size

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of one sequence."""
        batch, row = divmod(number, BATCH_SEQUENCES)
        record = self.reader.get_batch(batch)
        return record.column(0)[row].values.to_numpy(), record.column(1)[row].values.to_numpy(zero_copy_only=False)

    def ids(self, first: int, n: int) -> Iterator[np.ndarray]:
        """The stream's ids from ``first`` on, as views of the file's batches."""
        per_batch = self.length * BATCH_SEQUENCES
        while n > 0:
            batch, at = divmod(first, per_batch)
            values = self.reader.get_batch(batch).column(0).values.to_numpy()
            part = values[at:at + n]
            yield part
            first, n = first + len(part), n - len(part)


def read_documents(manifest: DataFrame, folder: str, doc_id_type: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 of every document, from the files of the manifest."""
    # One row per file: as many as the writing job had tasks.
    running = F.expr("sum(ids) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    files = stored(manifest.withColumn("before", F.coalesce(running, F.lit(0))), "token-files")
    spread = files.repartition(max(1, files.count()), "part").select("path", "docs_path", "before")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, docs_path, before in zip(*[c.to_pylist() for c in batch.columns]):
                system, _ = filesystem(folder)
                tokens, documents = TokenFile(folder, path), _open(system, docs_path)
                for i in range(documents.num_record_batches):
                    listed = documents.get_batch(i)
                    firsts, sizes = listed.column(1).to_numpy(), listed.column(2).to_numpy()
                    sums = []
                    for first, n in zip(firsts.tolist(), sizes.tolist()):
                        crc = 0
                        for part in tokens.ids(first, n):
                            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                        sums.append(crc)
                    yield pa.RecordBatch.from_arrays(
                        [listed.column(0), pa.array(firsts + before), pa.array(sizes), pa.array(sums, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return spread.mapInArrow(read, f"doc_id {doc_id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_file_report(docs: DataFrame, tokenizer_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the documents' ids (each with the end id) into files in ascending id order and read them back.

    A null or empty text is the end id alone.  A null id sorts first; rows of one id follow each other by a hash of their text.
    No rows in, no files and no rows out.
    """
    folder = new_path(docs.sparkSession, "token-ids")
    manifest = write_token_files(docs, tokenizer_file, folder, doc_id, text)
    return read_documents(manifest, folder, dict(docs.dtypes)[doc_id])
