"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' words go into one suffix automaton.  A document's words are streamed through it; the automaton holds the longest
run of words that ends here and stands in some item.  Where that run reaches the window length, or a whole item that is
shorter, the words are hit.  Items come in blocks of bounded size, so an automaton has a bound whatever the number of items;
each is built in a task and written to the shared folder, and every document is streamed through all of them in one pass.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewatch.functions.scratch import new_path, stored
from stagewatch.llm.common import PLAIN, as_bytes, filesystem, fresh

WINDOW = 10
#: Words of items in one automaton; it has at most twice as many states (about 1 kB of memory a word, build included).
BLOCK_WORDS = 100_000
#: Bytes of text that a task takes through one automaton after the other.
GROUP_BYTES = 32 << 20
#: Words of one piece of an item; pieces overlap by a window less one word, so no window is lost.
PIECE_WORDS = 20_000


class SuffixAutomaton:
    """Suffix automaton of several word sequences, with the items that a state's window or whole text belongs to."""

    def __init__(self, items: list[tuple[str | None, list[bytes], bool]], window: int) -> None:
        """``items``: (id, words, whole); ``whole`` is false for pieces of a longer item."""
        self.window = window
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.word: dict[bytes, int] = {}
        coded = [(name, [self.word.setdefault(w, len(self.word)) for w in words], whole) for name, words, whole in items]
        for _, codes, _ in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        # State of the window-long (or whole short) match at each state, and the items there.
        self.items: dict[int, set] = {}
        self.short: dict[int, int] = {}
        for name, codes, whole in coded:
            if len(codes) < window and whole:
                state = self._walk(codes)
                self.short[state] = len(codes)
                self.items.setdefault(state, set()).add(name)
            state, run = 0, 0
            for c in codes:
                state, run = self.step[state][c], run + 1
                if run >= window:
                    self.items.setdefault(self._up(state), set()).add(name)
        self.full = [self._up(s) if n >= window else -1 for s, n in enumerate(self.length)]
        self.near_short = self._short_above()

    def _walk(self, codes: list[int]) -> int:
        state = 0
        for c in codes:
            state = self.step[state][c]
        return state

    def _up(self, state: int) -> int:
        """The state that holds the last ``window`` words of a match at ``state``."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _short_above(self) -> list[int]:
        """Per state, the longest whole short item that ends every match there, as a state (-1: none)."""
        out = [-1] * len(self.step)
        for state in sorted(range(len(self.step)), key=self.length.__getitem__):
            out[state] = state if state in self.short else out[self.link[state]] if self.link[state] >= 0 else -1
        return out

    def _extend(self, last: int, c: int) -> int:
        step, link, length = self.step, self.link, self.length
        if c in step[last]:
            q = step[last][c]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, c, q)
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return new

    def _clone(self, p: int, c: int, q: int) -> int:
        copy = len(self.step)
        self.step.append(dict(self.step[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = copy
        while p >= 0 and self.step[p].get(c) == q:
            self.step[p][c] = copy
            p = self.link[p]
        return copy

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set, int]:
        """Hit stretches (start, stop), the items hit, and the longest match in words."""
        step, link, length, full, near_short, short = self.step, self.link, self.length, self.full, self.near_short, self.short
        hits: list[tuple[int, int]] = []
        states: set[int] = set()
        window, longest, state, run = self.window, 0, 0, 0
        for i, c in enumerate(map(self.word.get, words)):
            if c is None:
                state = run = 0
                continue
            while c not in step[state] and state:
                state = link[state]
                run = length[state]
            if c not in step[state]:
                continue
            state, run = step[state][c], run + 1
            if run > longest:
                longest = run
            if run >= window:
                # The state may hold longer matches than this one; its window is what counts.
                states.add(full[state])
                hits.append((i + 1 - window, i + 1))
            if short:
                at = near_short[state]
                if at >= 0 and short[at] > run:
                    at = near_short[link[at]]
                if at >= 0:
                    hits.append((i + 1 - short[at], i + 1))
                while at >= 0:
                    states.add(at)
                    at = near_short[link[at]]
        return hits, set().union(*[self.items[s] for s in states if s >= 0]), longest


def joined(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(stretches):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def item_pieces(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """block, item (its id as a string, null if it has none), words (joined by spaces), whole: the items in pieces."""
    named = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, pieces, whole, counts = [], [], [], []
            for name, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                words = (text or b"").translate(PLAIN).split()
                for at in range(0, max(1, len(words) - window + 1), PIECE_WORDS):
                    part = words[at:at + PIECE_WORDS + window - 1]
                    if part:
                        names.append(name)
                        pieces.append(b" ".join(part))
                        whole.append(len(part) == len(words))
                        counts.append(len(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(pieces, pa.binary()).cast(pa.string()), pa.array(whole, pa.bool_()),
                 pa.array(counts, pa.int64())], ["item", "words", "whole", "n"],
            )

    return named.mapInArrow(cut, "item string, words string, whole boolean, n bigint")


def automata(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> tuple[str, list[int]]:
    """Build one automaton per block of items, each in a task, and write them; returns their folder and the blocks' numbers."""
    spark = benchmark.sparkSession
    pieces = stored(item_pieces(benchmark, item_id, text, window).distinct(), "items")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // (BLOCK_WORDS // 2)))

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        items = sorted(zip(rows.column("item").to_pylist(), rows.column("words").to_pylist(), rows.column("whole").to_pylist()),
                       key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
        made = SuffixAutomaton([(name, words.encode().split(), whole) for name, words, whole in items], window)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "automaton": pa.array([pickle.dumps(made)], pa.binary())})

    block = F.pmod(F.xxhash64("item", "words"), F.lit(blocks)).cast("int")
    folder = new_path(spark, "automata")
    built = pieces.withColumn("block", block).groupBy("block").applyInArrow(build, "block int, automaton binary")
    built.write.partitionBy("block").parquet(folder)
    return folder, [r["block"] for r in spark.read.schema("automaton binary, block int").parquet(folder).select("block").orderBy("block").collect()]


_held: dict[tuple[str, int], SuffixAutomaton] = {}


def automaton_of(folder: str, block: int) -> SuffixAutomaton:
    """A block's automaton; a worker holds one at a time and keeps it for later tasks."""
    if (folder, block) not in _held:
        _held.clear()
        system, root = filesystem(folder)
        column = pq.read_table(f"{root}/block={block}", filesystem=system, columns=["automaton"], partitioning=None).column("automaton")
        _held[folder, block] = pickle.loads(column[0].as_py())
    return _held[folder, block]


N_WORDS, HITS, ITEMS, LONGEST = "__dc_words", "__dc_hits", "__dc_items", "__dc_longest"
SPAN = pa.struct([("start", pa.int32()), ("stop", pa.int32())])


def grouped(batches: Iterator[pa.RecordBatch], at: int, most: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches whose column ``at`` has some ``most`` bytes together."""
    group, size = [], 0
    for batch in batches:
        group.append(batch)
        size += batch.column(at).nbytes
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def scanned(
    docs: DataFrame, text: str, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text", window: int = WINDOW
) -> DataFrame:
    """``docs`` with what was found in each text: words, hit stretches, sorted items and the longest match, in four last columns.

    One pass over the documents whatever the number of automata: a task takes some MB of text through one automaton after
    the other, and holds one of them at a time.
    """
    folder, blocks = automata(benchmark, item_id, item_text, window)
    names = [*docs.columns, *fresh(docs, N_WORDS, HITS, ITEMS, LONGEST)]
    kinds = ("bigint", "array<struct<start: int, stop: int>>", "array<string>", "bigint")
    nothing = docs.withColumns({n: F.lit(None).cast(k) for n, k in zip(names[len(docs.columns):], kinds)})
    at = docs.columns.index(text)
    most = GROUP_BYTES if len(blocks) > 1 else 0

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, at, most):
            texts = [as_bytes(batch.column(at)) for batch in group]
            counts = [[0] * len(t) for t in texts]
            hits, items, longest = ([[make() for _ in t] for t in texts] for make in (list, set, int))
            for block in blocks or [None]:
                automaton = SuffixAutomaton([], window) if block is None else automaton_of(folder, block)
                for b, raws in enumerate(texts):
                    for i, raw in enumerate(raws):
                        words = (raw or b"").translate(PLAIN).split()
                        counts[b][i] = len(words)
                        spans, more, n = automaton.scan(words)
                        hits[b][i] += spans
                        items[b][i] |= more
                        longest[b][i] = max(n, longest[b][i])
            for b, batch in enumerate(group):
                found = (
                    pa.array(counts[b], pa.int64()),
                    pa.array([[{"start": x, "stop": y} for x, y in joined(h)] for h in hits[b]], pa.list_(SPAN)),
                    pa.array([sorted(i for i in found if i is not None) for found in items[b]], pa.list_(pa.string())),
                    pa.array(longest[b], pa.int64()),
                )
                yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=names)

    return docs.mapInArrow(scan, nothing.schema)


def contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items (sorted ids), items_sha256, longest_match, contaminated.

    Words are runs of ASCII letters (lower-cased), digits and characters beyond ASCII.  A null or empty text has no words and
    isn't hit; an item without words has no windows; items without an id hit words but are not listed.  Without items no
    row is hit.  Repeated rows and items count as they stand.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    # These rows have no column of the scratch names, so those are as they stand.
    n_hit = F.aggregate(HITS, F.lit(0).cast("bigint"), lambda n, s: n + (s["stop"] - s["start"]))
    return scanned(rows, "text", benchmark, item_id, item_text, window).select(
        "doc_id", F.col(N_WORDS).alias("n_words"), n_hit.alias("n_hit"), F.size(ITEMS).cast("bigint").alias("n_items"),
        F.col(ITEMS).alias("items"), F.sha2(F.array_join(ITEMS, ","), 256).alias("items_sha256"),
        F.col(LONGEST).alias("longest_match"), (F.size(HITS) > 0).alias("contaminated"),
    )


def _char_spans(text: bytes) -> list[tuple[int, int]]:
    """Byte spans of the normalised words in the original text."""
    plain = text.translate(PLAIN)
    spans, at = [], 0
    for word in plain.split():
        at = plain.index(word, at)
        spans.append((at, at + len(word)))
        at += len(word)
    return spans


def cleaned(text: bytes, stretches: list[tuple[int, int]], n_words: int, max_span: int, max_cover: float) -> bytes | None:
    """The text without hit stretches longer than ``max_span`` words; None if hits cover more than ``max_cover`` of it."""
    if n_words and sum(b - a for a, b in stretches) / n_words > max_cover:
        return None
    gone = [(a, b) for a, b in stretches if b - a > max_span]
    if not gone:
        return text
    spans = _char_spans(text)
    parts, at = [], 0
    for a, b in gone:
        parts.append(text[at:spans[a][0]])
        at = spans[b - 1][1]
    return b"".join([*parts, text[at:]])


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, max_span: int = 0, max_cover: float = 0.5,
) -> DataFrame:
    """The documents without contaminated spans, columns as in the input.

    Hit spans longer than ``max_span`` words are cut out of the text; a document of which hits cover more than ``max_cover``
    goes as a whole.  Texts without hits, null and empty ones stay as they are.
    """
    found = scanned(docs, text, benchmark, item_id, item_text, window)
    names = docs.columns
    at, words_at = docs.columns.index(text), len(names)
    hits_at = words_at + 1

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[bytes | None] = []
            keep: list[bool] = []
            found_here = zip(as_bytes(batch.column(at)), batch.column(hits_at).to_pylist(), batch.column(words_at).to_pylist())
            for raw, spans, n_words in found_here:
                stretches = [(s["start"], s["stop"]) for s in spans]
                left = cleaned(raw, stretches, n_words, max_span, max_cover) if stretches else raw
                keep.append(left is not None or raw is None)
                texts.append(left)
            columns = list(batch.columns[: len(names)])
            columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep, pa.bool_()))

    return found.mapInArrow(clean, docs.schema)
