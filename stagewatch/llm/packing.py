"""Packing of tokenized documents into sequences: minimum bin slack over a histogram of lengths.

A sequence's content is a combination of piece lengths, and there are at most as many lengths as a sequence has places.  So
the histogram of lengths is enough to choose the combinations: the longest piece left and the fullest feasible combination
beside it, found by a subset-sum table held as a bit set, are taken out together, as often as the counts allow.  What is
planned has a bounded size at every input size; the pieces then find their places by their rank among those of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewatch.functions.scratch import stored
from stagewatch.llm.common import as_bytes
from stagewatch.llm.pretokens import packed_ids

CAPACITY = 2048
END_ID = 0
EMIT_BYTES = 8 << 20


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths, as often as given, of the combination of available pieces that fills ``room`` best; long pieces first.

    Bit n of the set says that n places can be filled.  Copies of a length join in doubling steps.  The lengths come longest
    first and the table ends as soon as the room can be filled; going back, a step is only used where it is needed.
    """
    reach, mask = 1, (1 << room + 1) - 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted(counts, reverse=True):
        left, step = min(counts[length], room // length), 1
        while left:
            step = min(step, left)
            steps.append((length, step, reach))
            reach |= reach << length * step & mask
            left, step = left - step, 2 * step
        if reach >> room & 1:
            break
    filled, chosen = reach.bit_length() - 1, {}
    for length, step, before in reversed(steps):
        if not before >> filled & 1:
            chosen[length] = chosen.get(length, 0) + step
            filled -= length * step
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: pieces}) until no piece is left: combinations and how many sequences have each."""
    left, out = {length: n for length, n in histogram.items() if n}, []
    while left:
        seed = max(left)
        rest = {length: n - (length == seed) for length, n in left.items() if n > (length == seed)}
        combination = fullest(rest, capacity - seed)
        combination[seed] = combination.get(seed, 0) + 1
        times = min(left[length] // n for length, n in combination.items())
        for length, n in combination.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
        out.append((times, combination))
    return out


def slots(planned: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length, first rank, pieces a sequence, first sequence, first place) by length and rank.

    Pieces of a length, by rank, fill the combinations that hold the length in the order of the plan.
    """
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for times, combination in planned:
        place = 0
        for length in sorted(combination, reverse=True):
            n = combination[length]
            rows.append((length, taken.get(length, 0), n, sequence, place))
            taken[length] = taken.get(length, 0) + n * times
            place += n * length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pieces(
    docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """The documents' ids, each with the end id, cut into pieces of at most ``capacity`` (only the first may be shorter).

    Columns doc_id, piece, start, length, ids_crc32, and part and at: the writing task and the piece's rank among those of
    its length in that task; with ``with_ids`` also ids, as little-endian unsigned 32-bit integers.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    end = np.array([end_id], dtype="<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "at", *(["ids"] if with_ids else [])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = packed_ids(tokenizer_file), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            held: list[tuple] = []
            size = 0
            for i, raw in enumerate(as_bytes(batch.column(1))):
                ids = encoder.encode((raw or b"").decode(errors="replace")) + end
                n, start, number = len(ids) // 4, 0, 0
                while start < n:
                    length = (n - start) % capacity or capacity
                    piece = ids[4 * start:4 * (start + length)]
                    held.append((i, number, start, length, zlib.crc32(piece), part, seen[length], *([piece] if with_ids else [])))
                    seen[length] += 1
                    start, number = start + length, number + 1
                    size += len(piece) if with_ids else 64
                if size > EMIT_BYTES:
                    yield _piece_batch(batch.column(0), held, names)
                    held, size = [], 0
            if held:
                yield _piece_batch(batch.column(0), held, names)

    kind = dict(rows.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, at bigint"
    return rows.mapInArrow(cut, schema + (", ids binary" if with_ids else ""))


def _piece_batch(ids: pa.Array, held: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = (None, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
    columns = list(zip(*held))
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(columns[0])), *[pa.array(c, t) for c, t in zip(columns[1:], kinds[1:])]], names,
    )


def placed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (stored pieces, see ``pieces``) with sequence_id and offset.

    Ranks are dealt by (task, length): counts per task and length, summed over earlier tasks within a length.  Only the
    histogram, at most ``capacity`` rows, reaches the driver, and only the plan's slots go back: a length occurs in as many
    combinations as are planned, and each combination uses up at least half of some length's pieces.
    """
    spark = cut.sparkSession
    counts = stored(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    earlier = F.expr("sum(n) OVER (PARTITION BY length ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    bases = counts.select("part", "length", F.coalesce(earlier, F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(plan(histogram, capacity)))
    ranked = cut.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("at")).drop("part", "at", "base")
    names = [n for n in ranked.columns if n != "rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table.value
        starts = np.searchsorted(known[:, 0], np.arange(capacity + 2))
        for batch in batches:
            lengths, ranks = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("length", "rank"))
            row = np.empty(len(ranks), dtype=np.int64)
            for length in np.unique(lengths):
                mine = lengths == length
                first, stop = starts[length], starts[length + 1]
                row[mine] = first + np.searchsorted(known[first:stop, 1], ranks[mine], side="right") - 1
            _, first_rank, per_sequence, sequence, place = known[row].T
            behind = ranks - first_rank
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(n)) for n in names], pa.array(sequence + behind // per_sequence),
                 pa.array(place + behind % per_sequence * lengths)],
                [*names, "sequence_id", "offset"],
            )

    schema = ", ".join(f"{n} {t}" for n, t in ranked.dtypes if n != "rank")
    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def pack(
    docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (, ids), sequence_id, offset of every piece of every document.

    A null or empty text is the end id alone.  Null ids, repeated ids and repeated rows are documents like any other; columns
    beside the two named are not looked at.  No rows in, no rows out.
    """
    cut = stored(pieces(docs, tokenizer_file, capacity, end_id, doc_id, text, with_ids), "pieces")
    out = placed(cut, capacity)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []), "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids (binary, little-endian unsigned 32-bit), starts (offsets of its pieces), from ``pack`` with ids.

    A group is one sequence, so it holds at most ``capacity`` ids.
    """
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), inside.alias("p")).select(
        "sequence_id", "n_tokens", F.expr("aggregate(p, cast('' AS binary), (all, x) -> concat(all, x.ids))").alias("ids"),
        F.expr("transform(p, x -> x.offset)").alias("starts"),
    )


def pack_report(docs: DataFrame, tokenizer_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return pack(docs, tokenizer_file, doc_id=doc_id, text=text)
