"""Structure repair of conversations: the cheapest edits that make the roles alternate.

Every row of a conversation is kept, given another role or deleted, and rows may be inserted, until the roles' initials read
``(s?(ua)+)?``.  The edits of a conversation are paths through a lattice of (rows consumed, last role kept); a Dijkstra search
runs from its start and one from its end, and they go on after they met until no crossing of equal cost can be missing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stagewatch.functions.scratch import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
USER, ASSISTANT = "user", "assistant"
#: ASCII white space, as the word pattern of the other operators has it.
BLANKS = "\x20\x09\x0A\x0B\x0C\x0D"
#: Of a row: its role's initial in the low two bits (0 stands for any other), then whether it ends mid-sentence, must go.
OTHER, SYSTEM, ENDS_EARLY, MUST_GO = 0, 1, 4, 8
INITIALS = {"s": SYSTEM, "u": 2, "a": 3}
#: Of the lattice: the role last kept (0: none yet).  What may follow, and what it may follow.
START, AFTER_USER, AFTER_ASSISTANT = 0, 2, 3
FOLLOWS = ((2, SYSTEM), (2,), (3,), (2,))
PRECEDES: tuple[tuple[int, ...], ...] = ((), (START,), (START, SYSTEM, AFTER_ASSISTANT), (AFTER_USER,))


def _forward(codes: bytes, node: int) -> Iterator[tuple[int, int, str]]:
    """Edges out of a lattice node: (node, cost, letter).  No two have one letter."""
    row, last = divmod(node, 4)
    turn = 3 if last == AFTER_USER else 2
    if row < len(codes):
        code = codes[row]
        yield node + 4, DELETE, "D"
        if not code & MUST_GO:
            late = TRUNCATED if code & ENDS_EARLY else 0
            if code & 3 and code & 3 in FOLLOWS[last]:
                yield 4 * (row + 1) + (code & 3), KEEP + late, "K"
            yield 4 * (row + 1) + turn, REROLE + late, "R"
    yield 4 * row + turn, INSERT, "I"


def _backward(codes: bytes, node: int) -> Iterator[tuple[int, int]]:
    """Edges into a lattice node: (node, cost)."""
    row, last = divmod(node, 4)
    if row:
        code = codes[row - 1]
        yield node - 4, DELETE
        if not code & MUST_GO:
            late = TRUNCATED if code & ENDS_EARLY else 0
            for before in PRECEDES[last]:
                if code & 3 == last:
                    yield 4 * (row - 1) + before, KEEP + late
                if last != SYSTEM:
                    yield 4 * (row - 1) + before, REROLE + late
    if last != SYSTEM:
        for before in PRECEDES[last]:
            yield 4 * row + before, INSERT


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and audit (K, R, D and I in order) of the cheapest repair; of equally cheap ones the audit least in ASCII.

    Both searches hold one cost per lattice node, so memory grows with the rows; the least audit is read off edge by edge
    instead of carrying texts along.  No cheapest audit begins another (its letters fix its cost), so the least letter at
    each step gives the least audit.
    """
    end = 4 * len(codes)
    ahead: dict[int, int] = {START: 0}
    behind: dict[int, int] = {end + START: 0, end + AFTER_ASSISTANT: 0}
    fronts = [[(0, START)], [(0, end + START), (0, end + AFTER_ASSISTANT)]]
    best = None if codes else 0
    crossings = set() if codes else {START}
    while best is None or fronts[0] and fronts[1] and fronts[0][0][0] + fronts[1][0][0] <= best:
        side = 0 if fronts[0] and (not fronts[1] or fronts[0][0][0] <= fronts[1][0][0]) else 1
        mine, other = (ahead, behind) if side == 0 else (behind, ahead)
        cost, node = heappop(fronts[side])
        if cost > mine[node]:
            continue
        for edge in _forward(codes, node) if side == 0 else _backward(codes, node):
            to, total = edge[0], cost + edge[1]
            if to not in mine or total < mine[to]:
                mine[to] = total
                heappush(fronts[side], (total, to))
                if to in other:
                    whole = total + other[to]
                    if best is None or whole < best:
                        best, crossings = whole, {to}
                    elif whole == best:
                        crossings.add(to)
    # Nodes of the forward side from which a crossing is reached at the best cost.
    useful, open_nodes = set(crossings), list(crossings)
    while open_nodes:
        node = open_nodes.pop()
        for before, cost in _backward(codes, node):
            if before in ahead and before not in useful and ahead[before] + cost == ahead[node]:
                useful.add(before)
                open_nodes.append(before)
    node, spent, audit = START, 0, []
    while node < end or spent < best:
        letter, to, cost = min(
            (letter, to, cost) for to, cost, letter in _forward(codes, node)
            if to in behind and spent + cost + behind[to] == best or to in useful and ahead[to] == spent + cost
        )
        audit.append(letter)
        node, spent = to, spent + cost
    return best, "".join(audit)


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows of ``rows`` with known faults put in: conv_id, turn, role, text, dropped.

    The CRC-32 of ``conv_id:turn`` modulo 20 decides: 0 drops the row (``dropped``; its conversation stays known), 1 empties
    the text, 2 takes ``.!?`` out of it, 3 repeats the row, 4 makes the role ``user``.  A null stands as one space, in the
    checksum too, but a null conversation or turn is returned as null.
    """
    known = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(known(conv_id), F.lit(":"), known(turn)).cast("binary")) % 20
    times = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.when(fault == 4, F.lit(USER)).otherwise(known(role)).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(known(text), ".!?", "")).otherwise(known(text)).alias("text"),
        (fault == 0).alias("dropped"), F.explode(times).alias("copy"),
    ).drop("copy")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, tuple]]:
    """(conv_id, other columns) of every row."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        yield from zip(columns[0], zip(*columns[1:]))


def _emitter(kinds: list[tuple[str, pa.DataType]]) -> tuple[list[tuple], Callable[[], pa.RecordBatch]]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*held)) or [()] * len(kinds)
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], [n for n, _ in kinds])
        held.clear()
        return out

    return held, batch


EMIT_ROWS = 2_000
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
FACTS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


class _Facts:
    """What one conversation's rows, seen in order, amount to."""

    def __init__(self) -> None:
        self.codes = bytearray()
        self.lowest = self.highest = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before = None

    def add(self, turn: int | None, initial: str, blank: bool, repeated: bool, early: bool) -> None:
        if turn is not None:
            self.lowest = turn if self.lowest is None else self.lowest
            self.turns += turn != self.highest
            self.highest = turn
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        self.blank += blank
        self.duplicate += repeated and not blank
        early = early and not blank and not repeated
        self.truncated += early
        self.codes.append(INITIALS.get(initial, OTHER) | (ENDS_EARLY if early else 0) | (MUST_GO if blank or repeated else 0))

    def row(self) -> tuple:
        gaps = 0 if self.lowest is None else self.highest - self.lowest + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, *cheapest_edits(bytes(self.codes))


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit per conversation of ``damage``'s columns.

    Only flags and a digest of each text are shuffled.  A conversation's rows are streamed in order; a task holds a byte a row.
    """
    kind = dict(rows.dtypes)["conv_id"]
    digest = F.sha2("text", 256)
    flags = rows.select(
        "conv_id", "turn", "role", "dropped", digest.alias("digest"), F.substring("role", 1, 1).alias("initial"),
        (~F.col("text").rlike("[^\\x20\\x09-\\x0D]")).alias("blank"),
        (~F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1).isin(".", "!", "?")).alias("early"),
    )
    same = Window.partitionBy("conv_id", "dropped", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    ordered = (
        flags.repartition("conv_id").withColumn("repeated", F.row_number().over(same) > 1)
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "digest")
        .select("conv_id", "dropped", "turn", "initial", "blank", "repeated", "early")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = emit = facts = current = None
        for conv, (dropped, turn, initial, blank, repeated, early) in _conversations(typed := _Typed(batches)):
            if emit is None:
                held, emit = _emitter([("conv_id", typed.kind), *[(n, pa.int64()) for n in COUNTS], ("audit", pa.string())])
            if facts is None or conv != current:
                if facts is not None:
                    held.append((current, *facts.row()))
                if len(held) >= EMIT_ROWS:
                    yield emit()
                facts, current = _Facts(), conv
            if not dropped:
                facts.add(turn, initial, blank, repeated, early)
        if facts is not None:
            held.append((current, *facts.row()))
            yield emit()

    return ordered.mapInArrow(search, f"conv_id {kind}, {FACTS}")


class _Typed:
    """Batches, and the type of their first column."""

    def __init__(self, batches: Iterator[pa.RecordBatch]) -> None:
        self.batches, self.kind = batches, pa.null()

    def __iter__(self) -> Iterator[pa.RecordBatch]:
        for batch in self.batches:
            self.kind = batch.column(0).type
            yield batch


class Editor:
    """Applies an audit to rows given one by one; yields the repaired (role, text)."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.last = audit, 0, START

    def _put(self) -> str:
        self.last = AFTER_ASSISTANT if self.last == AFTER_USER else AFTER_USER
        return USER if self.last == AFTER_USER else ASSISTANT

    def inserted(self) -> Iterator[tuple[str, str]]:
        """Rows inserted at this place."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._put(), ""

    def apply(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.last = INITIALS[role[0]]
            yield role, text
        elif letter == "R":
            yield self._put(), text


def _with_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Every conversation's audit row, then its rows in order (columns of both; ``row`` 0 and 1)."""
    texts = rows.where(~F.col("dropped")).select("conv_id", F.lit(1).alias("row"), "turn", "role", "text", F.sha2("text", 256).alias("digest"))
    return (
        found.withColumn("row", F.lit(0)).unionByName(texts, allowMissingColumns=True).repartition("conv_id")
        .sortWithinPartitions("conv_id", "row", F.col("turn").asc_nulls_first(), "role", "digest")
    )


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, position (from 0), role, text of the repaired conversations, from rows with ``damage``'s columns."""
    kind = dict(rows.dtypes)["conv_id"]
    ordered = _with_audits(rows, stored(audits(rows), "audits")).select("conv_id", "row", "audit", "role", "text")

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = emit = editor = current = None
        position = 0
        for conv, (row, audit, role, text) in _conversations(typed := _Typed(batches)):
            if emit is None:
                held, emit = _emitter([("conv_id", typed.kind), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])
            if not row:
                if editor is not None:
                    held.extend((current, at, *made) for at, made in enumerate(editor.inserted(), position))
                editor, current, position = Editor(audit), conv, 0
                continue
            for made in editor.apply(role, text):
                held.append((conv, position, *made))
                position += 1
            if len(held) >= EMIT_ROWS:
                yield emit()
        if editor is not None:
            held.extend((current, at, *made) for at, made in enumerate(editor.inserted(), position))
            yield emit()

    return ordered.mapInArrow(edit, f"conv_id {kind}, position bigint, role string, text string")


def repair_report(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """Damage ``conversations``, repair them and return one row per conversation with a digest of the repaired rows.

    Rows of a conversation go by turn, nulls first; rows of one turn by role and a digest of the text.  A null conversation is
    one like any other.  Other roles than those that begin with s, u or a (an empty one too) are never kept as they are.  A
    conversation without rows after damage has zeros, an empty audit and the digest of nothing; no rows in, no rows out.

    The digest runs over a conversation's rows one after the other, so one task streams them; it holds the audit, not the rows.
    """
    rows = damage(conversations, conv_id, turn, role, text)
    kind = dict(rows.dtypes)["conv_id"]
    names = [*COUNTS, "audit"]
    ordered = _with_audits(rows, stored(audits(rows), "audits")).select("conv_id", "row", "role", "text", *names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = emit = editor = None
        facts: tuple = ()
        running, first = hashlib.sha256(), True

        def take(made: Iterator[tuple[str, str]]) -> None:
            nonlocal first
            for role, text in made:
                running.update((f"{role}:{text}" if first else f"\n{role}:{text}").encode())
                first = False

        for conv, (row, role, text, *found) in _conversations(typed := _Typed(batches)):
            if emit is None:
                kinds = [("conv_id", typed.kind), *[(n, pa.int64()) for n in COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())]
                held, emit = _emitter(kinds)
            if not row:
                if editor is not None:
                    take(editor.inserted())
                    held.append((*facts, running.hexdigest()))
                if len(held) >= EMIT_ROWS:
                    yield emit()
                editor, facts, running, first = Editor(found[-1]), (conv, *found), hashlib.sha256(), True
            else:
                take(editor.apply(role, text))
        if editor is not None:
            take(editor.inserted())
            held.append((*facts, running.hexdigest()))
            yield emit()

    return ordered.mapInArrow(digest, f"conv_id {kind}, {FACTS}, repaired_sha256 string")
