"""Alignment of two tokenizers' ids over the same texts.

Where a token of A and a token of B end at one byte, both id lists are cut: the ends of each list are the keys of a dictionary,
and the keys that both dictionaries have are the cuts.  Inside such a group every pair of tokens whose bytes overlap is a link.
Unit ends (see ``pretokens``) are cuts in any text, so a unit is aligned once and remembered.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewatch.functions.scratch import stored
from stagewatch.llm.common import as_bytes
from stagewatch.llm.pretokens import MARKS, ByteLevel, spelled, stem_and_marks, units

SPACE_MARK = "▁"
#: Bytes of text whose distinct units and id pairs are counted together.
CHUNK_BYTES = 8 << 20
#: Units a worker remembers, twice; each comes with its groups and links.
REMEMBERED = 250_000
PAIR_SHIFT = 32


class Pieces:
    """A piece model: ids of units as they are inside a text, and the bytes of each id."""

    def __init__(self, model_file: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.id_bytes = [
            bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace(SPACE_MARK, " ").encode() for i, n in enumerate(names)
        ]
        ordinary = [n for i, n in enumerate(names) if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        if any("\n" in n or SPACE_MARK in n.lstrip(SPACE_MARK) for n in ordinary):
            raise ValueError("pieces that go across words cannot be aligned unit by unit")
        #: Characters that some piece joins with a mark behind them.
        self.before_marks = {a for n in ordinary for a, b in zip(n, n[1:]) if b in MARKS and a not in MARKS}

    def ids(self, text: str) -> list[int]:
        """Ids of a stretch of text as it is inside a longer one: of a unit as spelled, or of marks behind a letter."""
        if text[0] == " ":
            return self.model.encode(text[1:])
        if text[0] == "\n":
            return self.model.encode(text)[1:]  # without the mark of the word that the model puts in front
        return self.model.encode("\n" + text)[2:]


def align(a: list[int], b: list[int], a_sizes: list[int], b_sizes: list[int]) -> list[tuple[list[int], list[int], list[tuple[int, int]]]]:
    """Groups (ids of A, ids of B, links) of two id lists over the same bytes; sizes are bytes per id."""
    ends_a = dict(zip(accumulate(map(a_sizes.__getitem__, a)), range(1, len(a) + 1)))
    ends_b = dict(zip(accumulate(map(b_sizes.__getitem__, b)), range(1, len(b) + 1)))
    groups = []
    from_a = from_b = start = 0
    for cut in sorted(ends_a.keys() & ends_b.keys()):
        to_a, to_b = ends_a[cut], ends_b[cut]
        if to_a - from_a == 1:
            links = [(a[from_a], y) for y in b[from_b:to_b]]
        elif to_b - from_b == 1:
            links = [(x, b[from_b]) for x in a[from_a:to_a]]
        else:
            links, i, j = [], from_a, from_b
            at_a = at_b = start
            while i < to_a and j < to_b:
                links.append((a[i], b[j]))
                end_a, end_b = at_a + a_sizes[a[i]], at_b + b_sizes[b[j]]
                if end_a <= end_b:  # both at once only at the group's end
                    i, at_a = i + 1, end_a
                if end_b <= end_a:
                    j, at_b = j + 1, end_b
        groups.append((a[from_a:to_a], b[from_b:to_b], links))
        from_a, from_b, start = to_a, to_b, cut
    return groups


#: A unit whose bytes a tokenizer does not give back.
NOT_GIVEN_BACK: tuple[str, int, int, int, list[int]] = ("", -1, -1, -1, [])


class UnitAligner(dict):
    """Numbers of units, and by number their group text, counts and id pairs; a new unit is aligned."""

    def __init__(self, a_file: str, b_file: str) -> None:
        super().__init__()
        self.a, self.b = ByteLevel(a_file, plain=True), Pieces(b_file)
        self.a_bytes, self.b_bytes = self.a.id_bytes(), self.b.id_bytes
        self.a_sizes, self.b_sizes = [len(x) for x in self.a_bytes], [len(x) for x in self.b_bytes]
        self.names = [str(i) for i in range(max(len(self.a_sizes), len(self.b_sizes)))]
        self._start()
        self.forget()

    def forget(self) -> None:
        """Start numbering anew; what is known now is looked up instead of aligned until the next time."""
        self.older = (dict(self), self.groups, self.n_a, self.n_b, self.n_groups, self.pairs, self.pair_ends)
        self.clear()
        self._start()

    def _start(self) -> None:
        self.marks: dict[str, tuple[str, int, int, int, list[int]]] = {}
        self.groups: list[str] = []
        #: Per unit: tokens of A and of B, groups.
        self.n_a, self.n_b, self.n_groups = array("q"), array("q"), array("q")
        self.pairs, self.pair_ends = array("q"), array("q", [0])

    def _append(self, unit: str, text: str, n_a: int, n_b: int, n_groups: int, pairs: list[int] | array) -> int:
        self[unit] = number = len(self.groups)
        self.groups.append(text)
        self.n_a.append(n_a)
        self.n_b.append(n_b)
        self.n_groups.append(n_groups)
        self.pairs.extend(pairs)
        self.pair_ends.append(len(self.pairs))
        return number

    def __missing__(self, unit: str) -> int:
        old, groups, n_a, n_b, n_groups, pairs, ends = self.older
        k = old.get(unit)
        if k is not None:
            return self._append(unit, groups[k], n_a[k], n_b[k], n_groups[k], pairs[ends[k]:ends[k + 1]])
        stem, rest = stem_and_marks(unit)
        if not stem or stem[-1] in self.b.before_marks:
            return self._append(unit, *self._aligned(spelled(unit)))
        s = self[stem]
        if rest not in self.marks:
            self.marks[rest] = self._aligned(rest)
        text, n_a, n_b, n_groups, pairs = self.marks[rest]
        if self.n_a[s] < 0 or n_a < 0:
            return self._append(unit, *NOT_GIVEN_BACK)
        return self._append(
            unit, f"{self.groups[s]};{text}", self.n_a[s] + n_a, self.n_b[s] + n_b, self.n_groups[s] + n_groups,
            self.pairs[self.pair_ends[s]:self.pair_ends[s + 1]] + array("q", pairs),
        )

    def _aligned(self, text: str) -> tuple[str, int, int, int, list[int]]:
        a, b, raw = self.a.ids(text), self.b.ids(text), text.encode()
        if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
            return NOT_GIVEN_BACK
        groups = align(a, b, self.a_sizes, self.b_sizes)
        names = self.names
        shown = [f"{','.join([names[i] for i in x])}|{','.join([names[i] for i in y])}" for x, y, _ in groups]
        return ";".join(shown), len(a), len(b), len(groups), [x << PAIR_SHIFT | y for _, _, links in groups for x, y in links]

    def numbers(self, text: str) -> np.ndarray:
        """The units of a blank and ``text``."""
        first, *others = units(text)
        if not first or first[0] in " \n":
            first = " " + first
        return np.fromiter(map(self.__getitem__, [first, *others]), dtype=np.int64)


_aligners: dict[tuple[str, str], UnitAligner] = {}


def unit_aligner(a_file: str, b_file: str) -> UnitAligner:
    """This worker's aligner; it outlives a task, so later tasks find its units."""
    if (a_file, b_file) not in _aligners:
        _aligners[a_file, b_file] = UnitAligner(a_file, b_file)
    return _aligners[a_file, b_file]


CELLS = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = (
    "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, chunk bigint, units binary, "
    "pairs array<bigint>, times array<bigint>"
)


def aligned(docs: DataFrame, a_file: str, b_file: str, doc_id: str, text: str, keep_groups: bool = False) -> DataFrame:
    """One row per document (counts, digest of its groups, its units) and one per chunk (``pairs`` not null).

    A chunk is the documents of some MB of text that a task meets in a row.  ``units`` of a document are places in its
    chunk's list of distinct units; ``units`` of a chunk says which of its ``pairs`` each of them has.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = unit_aligner(a_file, b_file)
        chunk, id_type = TaskContext.get().partitionId() << 32, None
        held: list[tuple] = []  # doc_id, unit numbers or None
        size = 0
        for batch in batches:
            id_type = batch.column(0).type
            for one, raw in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                numbers, plain = None, (raw or b"").decode(errors="replace")
                if raw and plain.encode() == raw:  # not of bytes that are no UTF-8
                    numbers = aligner.numbers(plain)
                held.append((one, numbers))
                size += len(raw or b"")
                if size >= CHUNK_BYTES:
                    yield _chunk(held, aligner, chunk, id_type, keep_groups)
                    held, size, chunk = [], 0, chunk + 1
                    if len(aligner) > REMEMBERED:
                        aligner.forget()
        if held:
            yield _chunk(held, aligner, chunk, id_type, keep_groups)

    return rows.mapInArrow(run, f"doc_id {kind}, {ALIGNED}" + (", groups string" if keep_groups else ""))


def _chunk(held: list[tuple], aligner: UnitAligner, chunk: int, id_type: pa.DataType, keep_groups: bool) -> pa.RecordBatch:
    per_unit = {n: np.frombuffer(getattr(aligner, n), dtype=np.int64) for n in CELLS[:3]}
    ends = np.frombuffer(aligner.pair_ends, dtype=np.int64)
    per_unit["n_links"] = np.diff(ends)
    good = [
        None if numbers is None or (per_unit["n_a"][numbers] < 0).any() else numbers for _, numbers in held
    ]
    used = np.bincount(np.concatenate([g for g in good if g is not None] or [np.empty(0, np.int64)]), minlength=len(aligner))
    present = np.flatnonzero(used)
    local = np.zeros(len(used), dtype=np.uint32)
    local[present] = np.arange(len(present), dtype=np.uint32)
    # The pairs of the units that occur, unit by unit, and how often each unit occurs.
    n_links = per_unit["n_links"][present]
    stops = np.cumsum(n_links)
    places = np.arange(stops[-1] if len(stops) else 0) + np.repeat(ends[present] - (stops - n_links), n_links)
    pairs, which = np.unique(np.frombuffer(aligner.pairs, dtype=np.int64)[places], return_inverse=True)
    times = np.bincount(which, weights=np.repeat(used[present], n_links), minlength=len(pairs)).astype(np.int64)
    table = np.concatenate([np.array([len(present)]), n_links, which]).astype("<u4").tobytes()
    columns: dict[str, list] = {n: [] for n in ("doc_id", *CELLS, "groups_sha256", "chunk", "units", "pairs", "times", "groups")}

    def add(**cells: object) -> None:
        for name, column in columns.items():
            column.append(cells.get(name))

    for (one, _), numbers in zip(held, good):
        if numbers is None:
            add(doc_id=one, n_a=0, n_b=0, n_groups=0, n_links=0, groups_sha256="", groups="")
            continue
        groups = ";".join([aligner.groups[i] for i in numbers.tolist()])
        add(
            doc_id=one, **{n: int(per_unit[n][numbers].sum()) for n in CELLS}, groups_sha256=hashlib.sha256(groups.encode()).hexdigest(),
            chunk=chunk, units=local[numbers].astype("<u4").tobytes(), groups=groups,
        )
    if len(present):
        add(chunk=chunk, units=table, pairs=pairs, times=times)
    whole = pa.int64()
    kinds = {"doc_id": id_type, "groups_sha256": pa.string(), "groups": pa.string(), "units": pa.binary(),
             "pairs": pa.list_(whole), "times": pa.list_(whole)}
    names = [n for n in columns if n != "groups" or keep_groups]
    return pa.RecordBatch.from_arrays([pa.array(columns[n], kinds.get(n, whole)) for n in names], names)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """pair, n (links corpus-wide), best (whether no other pair of its B id has more), from ``aligned``'s chunk rows."""
    counts = stored(
        chunks.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).groupBy(F.col("p.pairs").alias("pair"))
        .agg(F.sum("p.times").alias("n")), "pair-counts",
    ).withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << PAIR_SHIFT) - 1)))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    # One row per id of B: the size of its vocabulary bounds it.
    return counts.join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _sums(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of a chunk with n_best and count_sum; ``right`` has place, n, best of the chunk's pairs."""
    table, documents = None, []
    for i, pairs in enumerate(left.column("is_chunk").to_pylist()):
        if pairs:
            table = np.frombuffer(left.column("units")[i].as_buffer(), dtype="<u4").astype(np.int64)
        else:
            documents.append(i)
    size = int(table[0])
    n_links, which = table[1:1 + size], table[1 + size:]
    first = np.cumsum(n_links) - n_links
    place = right.column("place").to_numpy()
    n, best = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=np.int64)
    n[place] = right.column("n").to_numpy()
    best[place] = right.column("best").to_numpy(zero_copy_only=False)
    per_unit = np.add.reduceat(best[which], first), np.add.reduceat(n[which], first)
    rows = left.take(pa.array(documents, pa.int64()))
    units_of = [np.frombuffer(b.as_buffer(), dtype="<u4") for b in rows.column("units").combine_chunks()]
    names = ["doc_id", *CELLS]
    sums = [pa.array([int(s[u].sum()) for u in units_of], pa.int64()) for s in per_unit]
    return pa.table([*[rows.column(c) for c in names], *sums, rows.column("groups_sha256")], [*names, "n_best", "count_sum", "groups_sha256"])


def alignment_report(docs: DataFrame, a_file: str, b_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document.

    ``a_file`` is a byte-level tokenizer file, ``b_file`` a piece model that puts a word mark in front.  A null or empty text,
    and one that a tokenizer does not give back byte by byte, has zeros and an empty digest.  Null and repeated ids are
    documents like any other.  No rows in, no rows out.

    What the corpus knows about a pair comes back to the documents by chunk: a chunk's distinct pairs are joined with the
    counts, so neither the counts nor any document's links are held whole anywhere.
    """
    kind = dict(docs.dtypes)[doc_id]
    made = stored(aligned(docs, a_file, b_file, doc_id, text), "aligned")
    chunks = made.where(F.col("pairs").isNotNull())
    known = pair_counts(chunks)
    asked = (
        chunks.select(F.col("chunk").alias("of_chunk"), F.posexplode("pairs").alias("place", "pair")).join(known, "pair")
        .select("of_chunk", "place", "n", "best")
    )
    out = f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    linked = made.where(F.col("chunk").isNotNull()).withColumn("is_chunk", F.col("pairs").isNotNull()).drop("pairs", "times")
    none = made.where(F.col("chunk").isNull()).select(
        "doc_id", *CELLS, F.lit(0).cast("bigint").alias("n_best"), F.lit(0).cast("bigint").alias("count_sum"), "groups_sha256",
    )
    return linked.groupBy("chunk").cogroup(asked.groupBy("of_chunk")).applyInArrow(_sums, out).unionByName(none)


def alignments(docs: DataFrame, a_file: str, b_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, groups (``a1,a2|b1;a3|b2``, empty without tokens) of every document."""
    return aligned(docs, a_file, b_file, doc_id, text, keep_groups=True).where(F.col("pairs").isNull()).select("doc_id", "groups")
