"""Substring dedup by seeds that are extended: words inside a window of words that an earlier document also has go.

Seeds.  Every window of ``length`` words picks the smallest hash among its ``anchor``-word sequences (winnowing), so equal
windows pick the same anchor at the same place.  A run is the stretch of neighbouring windows that picked one anchor; a
text has about one run per sixteen words.  Documents meet on the anchors of their runs, and anchors of one document drop out.

Extension.  Runs with one anchor are first compared over their whole span: of equal spans only the one of the smallest id
goes on, for all its windows the others are repeats.  Spans that differ are extended window by window: from the anchor up
to ``length - anchor`` words to either side, and the smallest id is found for each window.  Groups are never paired up:
each step is a minimum per key.  Neighbouring windows that are repeats join into maximal stretches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewatch.functions.scratch import stored
from stagewatch.llm.common import as_bytes, row_key

LENGTH = 50
ANCHOR = 20
FACTOR = 0x9E3779B97F4A7C15 | 5
CACHED_WORDS = 500_000

RUN = "doc_id {kind}, row bigint, start int, n int, offset int, anchor bigint, span bigint"


def order_id(docs: DataFrame, doc_id: str) -> Column:
    """The id as a long or string that is never null: rows without an id come after all others."""
    if dict(docs.dtypes)[doc_id] in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(F.col(doc_id).cast("bigint"), F.lit((1 << 63) - 1))
    return F.coalesce(F.col(doc_id).cast("string"), F.lit("\U0010ffff"))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 7)
        return value


def word_hashes(words: list[bytes], cache: _WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of FACTOR and of its inverse modulo 2 ** 64, for 0 .. n."""
    inverse = pow(FACTOR, -1, 1 << 64)
    out = []
    for base in (FACTOR, inverse):
        row = np.full(n + 1, base, dtype=np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


class SequenceHashes:
    """Hash of any stretch of words of one text, from prefix sums of a polynomial modulo 2 ** 64."""

    def __init__(self, hashes: np.ndarray, powers: tuple[np.ndarray, np.ndarray]) -> None:
        self.up, inverse = powers
        self.sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * inverse[: len(hashes)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        value = (self.sums[stop] - self.sums[start]) * self.up[start]
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        return value ^ (value >> np.uint64(32))


def runs_of(sequences: SequenceHashes, n_words: int, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Per run: first window, number of windows, anchor's word place, hash of the anchor and of the run's span."""
    grams = np.arange(n_words - anchor + 1)
    keys = sequences.of(grams, grams + anchor)
    wide = length - anchor + 1
    windows = n_words - length + 1
    chosen = np.empty(windows, dtype=np.int64)
    for at in range(0, windows, 1 << 14):
        part = keys[at:at + (1 << 14) + wide - 1]
        picked = np.lib.stride_tricks.sliding_window_view(part, wide)[: min(1 << 14, windows - at)].argmin(axis=1)
        chosen[at:at + len(picked)] = picked + np.arange(at, at + len(picked))
    start = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    count = np.diff(np.append(start, windows))
    place = chosen[start]
    return start, count, place, keys[place], sequences.of(start, start + count + length - 1)


def runs(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """One row per run of the documents' texts (columns doc_id, row, text); ``offset`` is the anchor's distance from start."""
    kind = dict(docs.dtypes)["doc_id"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, powers = _WordHashes(), _powers(1 << 12)
        for batch in batches:
            taken, parts = [], []
            for i, text in enumerate(as_bytes(batch.column(2))):
                words = (text or b"").split()
                if len(words) < length:
                    continue
                if len(words) >= len(powers[0]):
                    powers = _powers(2 * len(words))
                start, count, place, key, span = runs_of(
                    SequenceHashes(word_hashes(words, cache), powers), len(words), length, anchor
                )
                taken.append(np.full(len(start), i))
                parts.append((start, count, place - start, key, span))
            if taken:
                columns = [np.concatenate(c) for c in zip(*parts)]
                at = pa.array(np.concatenate(taken))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), *[pa.array(c, pa.int32()) for c in columns[:3]],
                     *[pa.array(c.view(np.int64)) for c in columns[3:]]],
                    ["doc_id", "row", "start", "n", "offset", "anchor", "span"],
                )

    return docs.mapInArrow(scan, RUN.format(kind=kind))


def _windows(docs: DataFrame, length: int) -> DataFrame:
    """One row per window of the runs listed in ``picked`` (start, n, offset, anchor): its place from the anchor and hash."""
    kind = dict(docs.dtypes)["doc_id"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, powers = _WordHashes(), _powers(1 << 12)
        for batch in batches:
            for i, text in enumerate(as_bytes(batch.column(2))):
                words = text.split()
                if len(words) >= len(powers[0]):
                    powers = _powers(2 * len(words))
                sequences = SequenceHashes(word_hashes(words, cache), powers)
                listed = pa.RecordBatch.from_struct_array(batch.column(3)[i].values)
                start, n, offset, anchor = [c.to_numpy() for c in listed.columns]
                first = np.concatenate([[0], np.cumsum(n)[:-1]])
                step = np.arange(n.sum()) - np.repeat(first, n)
                place = np.repeat(start, n) + step
                at = pa.array(np.full(len(place), i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(place, pa.int32()),
                     pa.array(np.repeat(offset, n) - step, pa.int32()), pa.array(np.repeat(anchor, n)),
                     pa.array(sequences.of(place, place + length).view(np.int64))],
                    ["doc_id", "row", "place", "offset", "anchor", "window"],
                )

    return docs.mapInArrow(scan, f"doc_id {kind}, row bigint, place int, offset int, anchor bigint, window bigint")


def repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, row and ``repeated``: arrays of (start, n) of neighbouring windows that an earlier document also has.

    ``docs`` has the columns doc_id (see :func:`order_id`), row (see :func:`common.row_key`) and text.
    """
    found = stored(runs(docs, length, anchor), "runs")
    same_span = ["anchor", "span", "offset", "n"]
    spans = stored(found.groupBy(*same_span).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")), "spans")
    # Spans that several documents have: every later document's run is a repeat as a whole.
    whole = found.join(spans.filter("least < most").drop("most"), same_span).filter("doc_id > least")
    # Anchors that lie in spans that differ, of more than one document: extend the first document's run of each span.
    seeds = spans.groupBy("anchor").agg(F.min("least").alias("a"), F.max("most").alias("z"), F.count(F.lit(1)).alias("k"))
    seeds = seeds.filter("k > 1 AND a < z").select("anchor")
    first = found.join(spans.join(seeds, "anchor", "left_semi").drop("most"), same_span).filter("doc_id = least")
    picked = first.groupBy("doc_id", "row").agg(
        F.collect_set(F.struct("start", "n", "offset", "anchor")).alias("picked")
    )  # bounded by one text's length
    windows = stored(_windows(
        docs.join(stored(picked, "picked"), ["doc_id", "row"]).select("doc_id", "row", F.coalesce("text", F.lit("")).alias("text"), "picked"),
        length,
    ), "windows")
    same_window = ["anchor", "offset", "window"]
    least = windows.groupBy(*same_window).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    single = windows.join(least.drop("most"), same_window).filter("doc_id > least")
    places = whole.select("doc_id", "row", "start", "n").unionByName(
        single.select("doc_id", "row", F.col("place").alias("start"), F.lit(1).cast("int").alias("n"))
    )
    return places.groupBy("doc_id", "row").agg(F.collect_set(F.struct("start", "n")).alias("repeated"))


def _covered(n_words: int, stretches: pa.RecordBatch, length: int) -> np.ndarray:
    start, n = [c.to_numpy() for c in stretches.columns]
    edges = np.zeros(n_words + 1, dtype=np.int32)
    np.add.at(edges, start, 1)
    np.add.at(edges, start + n + length - 1, -1)
    return np.cumsum(edges[:-1]) > 0


def _with_repeats(docs: DataFrame, doc_id: str, text: str, length: int, anchor: int) -> DataFrame:
    keyed = docs.select(order_id(docs, doc_id).alias("doc_id"), row_key(doc_id, text).alias("row"), F.col(text).alias("text"))
    found = stored(repeats(keyed, length, anchor), "repeats")
    named = docs.select(F.col(doc_id).alias("id"), order_id(docs, doc_id).alias("doc_id"), row_key(doc_id, text).alias("row"),
                        F.col(text).alias("text"))
    return named.join(found, ["doc_id", "row"], "left").select(F.col("id").alias("doc_id"), "text", "repeated")


def dedup_substrings(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR
) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one space) and its sha256, per row.

    Words are runs of anything but ASCII white space.  A word goes if it lies in a window of ``length`` words that also
    starts in a document with a smaller id; the input is judged, not what is left of it.  Null and empty texts have no
    words.  Rows with one id don't repeat each other.  Rows without an id come after all that have one and don't repeat each
    other either.
    """
    rows = _with_repeats(docs, doc_id, text, length, anchor)
    kind = dict(rows.dtypes)["doc_id"]

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, texts, digests = [], [], [], []
            for i, text in enumerate(as_bytes(batch.column(1))):
                words = (text or b"").split()
                stretches = batch.column(2)[i]
                gone = 0
                if stretches.is_valid:
                    cover = _covered(len(words), pa.RecordBatch.from_struct_array(stretches.values), length)
                    gone = int(cover.sum())
                kept = b" ".join(words if not gone else [w for w, c in zip(words, cover.tolist()) if not c])
                counts.append(len(words))
                removed.append(gone)
                texts.append(kept)
                digests.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(texts, pa.binary()).cast(pa.string()), pa.array(digests, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    return rows.mapInArrow(strip, f"doc_id {kind}, n_words bigint, n_removed bigint, kept string, kept_sha256 string")
