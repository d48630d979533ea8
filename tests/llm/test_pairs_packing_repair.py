"""Alignment of tokenizers, packing and conversation repair, against brute force."""

import bisect
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from test_text_operators import edge_rows
from tokenizers import Tokenizer

from stagewatch.llm import alignment, conversations, packing, pretokens, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, kept string"
A_FILE, B_FILE = (queries.tokenizer_path(n) for n in (queries.BYTE_TOKENIZER, queries.PIECE_MODEL))
ODD_TEXTS = [
    " ", "  two  blanks ", "\n\nlines\n \nand\r\nmore\t\ttabs \x0b", "a\n b \n c　d\xa0e", "x<|endoftext|> y<s> </s><unk> <0x0A>",
    "mark ▁ inside", "don't I'll 'quoted' (x), y²; «z», …end.", "ﬁne ﬃ é é ́x", "emoji 👩‍👩‍👧 漢字かな, Ünï.", "\x00\x01 \x1c\x1fa \x85b", "." * 70,
    "12,345.67 a1b2 3rd", "tail \n", "\n", "\nx", "word" * 300, " lead", "a " * 40, "﻿bom  line",
]


@pytest.fixture(scope="module")
def edges(spark):
    odd = [(100 + i, t, "en", "o", 1, 1, "k") for i, t in enumerate(ODD_TEXTS)]
    return spark.createDataFrame(edge_rows() + odd, SCHEMA)


@pytest.fixture(scope="module")
def byte_level():
    return Tokenizer.from_file(A_FILE)


# Units


def random_texts(n, seed=5):
    r = random.Random(seed)
    parts = [" ", " ", "\n", "  ", "\t", "\r\n", "the", "Word", "ing", ",", ".", "'s", "'", "²", "é", "ß", "9", "42", "<|endoftext|>", "▁", "　", "(", "…", "x"]
    return ["".join(r.choices(parts, k=r.randrange(1, 30))) for _ in range(n)]


def test_units_join_to_the_text_and_encode_alone(byte_level):
    packed = pretokens.PackedIds(A_FILE)
    for text in ODD_TEXTS + random_texts(3000):
        first, *others = pretokens.units(text)
        assert first + "".join(map(pretokens.spelled, others)) == text
        expected = byte_level.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed.encode(text), "<u4").tolist() == expected, text


# Alignment


def ids_and_bytes(byte_level, model, text):
    plain = Tokenizer.from_file(A_FILE) if byte_level is None else byte_level
    plain.encode_special_tokens = True
    a = plain.encode(" " + text, add_special_tokens=False).ids
    plain.encode_special_tokens = False
    b = model.encode(text)
    back = {ord(c): x for x, c in pretokens.byte_alphabet().items()}
    a_bytes = [bytes(back[ord(c)] for c in plain.id_to_token(i)) for i in a]
    names = [model.id_to_piece(i) for i in b]
    b_bytes = [bytes([int(n[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", n) else n.replace("▁", " ").encode() for n in names]
    return a, b, a_bytes, b_bytes


def alignment_brute(rows, byte_level):
    model = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    out, links_of, pair_count = [], [], Counter()
    for doc_id, text in rows:
        links, groups = [], []
        a = b = []
        if text:
            a, b, a_bytes, b_bytes = ids_and_bytes(byte_level, model, text)
            if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
                a = b = []
            else:
                spans = []
                for parts in (a_bytes, b_bytes):
                    ends = list(itertools.accumulate(map(len, parts)))
                    spans.append(list(zip([0, *ends], ends)))
                covers = [defaultdict(list), defaultdict(list)]
                for cover, side in zip(covers, spans):
                    for i, (lo, hi) in enumerate(side):
                        for at in range(lo, hi):
                            cover[at].append(i)
                links = sorted({(i, j) for at in covers[0] for i in covers[0][at] for j in covers[1][at]})
                cuts = sorted({hi for _, hi in spans[0]} & {hi for _, hi in spans[1]})
                sides = []
                for ids, side in ((a, spans[0]), (b, spans[1])):
                    parts = defaultdict(list)
                    for t, (lo, _) in zip(ids, side):
                        parts[bisect.bisect_right(cuts, lo)].append(str(t))
                    sides.append(parts)
                groups = ["|".join(",".join(parts[i]) for parts in sides) for i in range(len(cuts))]
        links = [(a[i], b[j]) for i, j in links]
        pair_count.update(links)
        links_of.append(links)
        out.append([doc_id, len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""])
    most = defaultdict(int)
    for (_, b), n in pair_count.items():
        most[b] = max(most[b], n)
    return Counter((*o[:5], sum(pair_count[x] == most[x[1]] for x in ls), sum(pair_count[x] for x in ls), o[5]) for o, ls in zip(out, links_of))


def alignment_rows(df):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return Counter(tuple(r[n] for n in names) for r in df.collect())


def test_alignment_of_the_table(spark, byte_level):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert alignment_rows(queries.op11_alignment(spark, SF)) == alignment_brute(rows, byte_level)


@pytest.mark.parametrize("chunk", [1, 500, 8 << 20])
def test_alignment_edges(spark, edges, byte_level, monkeypatch, chunk):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", chunk)
    docs = edges.unionByName(spark.createDataFrame([(1000 + i, t, "", "", 0, 0, "") for i, t in enumerate(random_texts(200))], SCHEMA))
    docs = docs.withColumnsRenamed({"n_chars": "chunk", "size": "pairs", "kept": "n_best"})
    got = alignment_rows(alignment.alignment_report(docs.repartition(3), A_FILE, B_FILE))
    assert got == alignment_brute([(r.doc_id, r.text) for r in docs.collect()], byte_level)


def test_alignment_of_nothing(spark, edges):
    assert alignment.alignment_report(edges.limit(0), A_FILE, B_FILE).collect() == []
    blank = edges.where("text IS NULL OR text = ''")
    assert {(r.n_a, r.count_sum, r.groups_sha256) for r in alignment.alignment_report(blank, A_FILE, B_FILE).collect()} == {(0, 0, "")}


def test_groups_are_whole_texts(spark, edges):
    found = {r.doc_id: r.groups for r in alignment.alignments(edges, A_FILE, B_FILE).collect() if r.doc_id is not None}
    digests = {r.doc_id: r.groups_sha256 for r in alignment.alignment_report(edges, A_FILE, B_FILE).collect()}
    assert {k: hashlib.sha256(g.encode()).hexdigest() if g else "" for k, g in found.items()} == {k: v for k, v in digests.items() if k is not None}


# Packing


def fullest_brute(pieces, room):
    return max(s for n in range(len(pieces) + 1) for c in itertools.combinations(pieces, n) if (s := sum(c)) <= room)


@pytest.mark.parametrize("seed", range(60))
def test_fullest_combination(seed):
    r = random.Random(seed)
    pieces, room = [r.randrange(1, 25) for _ in range(r.randrange(0, 11))], r.randrange(0, 70)
    chosen = packing.fullest(Counter(pieces), room)
    assert all(n <= Counter(pieces)[length] for length, n in chosen.items())
    assert sum(length * n for length, n in chosen.items()) == fullest_brute(pieces, room)


@pytest.mark.parametrize("seed", range(40))
def test_plan_takes_the_fullest_sequence_each_time(seed):
    """The plan by counts equals packing one sequence after the other."""
    r = random.Random(seed)
    pieces = [r.choice([1, 2, 3, 5, 7, 8, 11, 13, 16]) for _ in range(r.randrange(0, 40))]
    left, sequences = Counter(pieces), []
    while +left:
        one = [max(+left)]
        left[one[0]] -= 1
        beside = packing.fullest(dict(+left), 16 - one[0])
        left -= Counter(beside)
        sequences.append(one[0] + sum(k * n for k, n in beside.items()))
        assert sequences[-1] <= 16
    planned = packing.plan(Counter(pieces), 16)
    assert sum(times for times, _ in planned) == len(sequences)
    assert sum((Counter({k: n * times for k, n in c.items()}) for times, c in planned), Counter()) == Counter(pieces)


def test_plan_of_many_lengths_is_near_the_bound():
    r = random.Random(3)
    counts = Counter(min(2048, int(r.expovariate(1 / 700)) + 1) for _ in range(200_000))
    planned = packing.plan(counts)
    bound = -(-sum(k * n for k, n in counts.items()) // 2048)
    assert bound <= sum(t for t, _ in planned) <= bound * 1.002 and len(planned) < 4 * 2048


def check_packing(rows, packed, byte_level, capacity=2048):
    expected = Counter()
    for doc_id, text in rows:
        ids = [*byte_level.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids), capacity), len(ids)]
        for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            expected[doc_id, i, lo, hi - lo, zlib.crc32(np.array(ids[lo:hi], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == expected
    by_sequence = defaultdict(list)
    for r in packed:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), sum(r.length for r in packed)


def test_packing_of_the_table(spark, byte_level):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    n, tokens = check_packing(rows, queries.op13_packing(spark, SF).collect(), byte_level)
    assert n <= -(-tokens // 2048) + 1


def test_packing_edges(spark, edges, byte_level):
    docs = edges.withColumnsRenamed({"n_chars": "piece", "size": "part", "kept": "rank"}).unionAll(edges).repartition(5)
    packed = packing.pack(docs, A_FILE, capacity=64, with_ids=True)
    check_packing([(r.doc_id, r.text) for r in docs.collect()], packed.collect(), byte_level, 64)
    made = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        whole = made[r.sequence_id]
        assert bytes(whole.ids)[4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids) and r.offset in whole.starts
    assert packing.pack(docs.limit(0), A_FILE).collect() == []


# Conversations


def damage_brute(rows):
    """Rows after damage in order, per conversation."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        kept = out[conv]
        named = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{named(conv)}:{named(turn)}".encode()) % 20
        role, text = named(role), named(text)
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        kept += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    for conv, kept in out.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
    return out


def faults_brute(rows):
    seen, out = set(), []
    for _, role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


ORDERLY = re.compile("(s?(ua)+)?")


def cheapest_brute(rows, faults):
    """Every row's edits one after the other, with the cheapest, then least, (cost, audit, rows) of each unfinished pattern."""
    states = {"": (0, "", [])}

    def put(found, initials, entry):
        key = initials[-1:] if initials else ""
        if key not in found or entry[:2] < found[key][:2]:
            found[key] = entry

    def allowed(key, initial):
        return initial in {"": "su", "s": "u", "u": "a", "a": "u"}[key]

    def inserted(states):
        for _ in range(2):
            for key, (cost, audit, made) in list(states.items()):
                for role in ("user", "assistant"):
                    if allowed(key, role[0]):
                        put(states, role[0], (cost + 5, audit + "I", [*made, (role, "")]))
        return states

    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for key, (cost, audit, made) in inserted(states).items():
            put(after, key, (cost + 2, audit + "D", made))
            if fault in ("blank", "duplicate"):
                continue
            late = 5 if fault == "truncated" else 0
            if role and allowed(key, role[0]):
                put(after, role[0], (cost + late, audit + "K", [*made, (role, text)]))
            for other in ("user", "assistant"):
                if allowed(key, other[0]):
                    put(after, other[0], (cost + 1 + late, audit + "R", [*made, (other, text)]))
        states = after
    return min(states[k] for k in inserted(states) if k in ("", "a"))


def repair_brute(rows):
    out = {}
    for conv, kept in damage_brute(rows).items():
        faults = faults_brute(kept)
        cost, audit, made = cheapest_brute(kept, faults)
        assert ORDERLY.fullmatch("".join(r[:1] for r, _ in made))
        turns = {t for t, _, _ in kept if t is not None}
        initials = [r[:1] for _, r, _ in kept]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),
        )
    return out


def repaired(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    found = df.collect()
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: tuple(r[n] for n in names) for r in found}


def random_conversations(n, seed, longest):
    r = random.Random(seed)
    roles = ["user", "user", "assistant", "assistant", "assistant", "system", "tool", "", None, "User", "sup"]
    texts = ["Yes.", "No", "", "  \t", "a?", "b!\n", "c\x0b.", None, "…", "x. y", ".\x85"]
    rows = []
    for conv in range(n):
        for turn in range(r.randrange(1, longest)):
            role = ("user", "assistant")[turn % 2] if r.random() < 0.6 else r.choice(roles)
            text = r.choice(texts) if r.random() < 0.5 else f"text {r.randrange(8)}."
            rows.append((conv if conv else None, r.choice([turn, turn, turn, None, turn // 2, turn * 3]), role, text))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_audits_by_both_searches(seed):
    for conv, kept in damage_brute(random_conversations(150, seed, 14)).items():
        faults = faults_brute(kept)
        codes = bytes(
            conversations.INITIALS.get(r[:1], 0) | (conversations.ENDS_EARLY if f == "truncated" else 0)
            | (conversations.MUST_GO if f in ("blank", "duplicate") else 0) for (_, r, _), f in zip(kept, faults)
        )
        assert conversations.cheapest_edits(codes) == cheapest_brute(kept, faults)[:2]


def test_repair_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert repaired(queries.op12_conversation_repair(spark, SF)) == repair_brute(rows)


def test_repair_edges(spark):
    rows = random_conversations(300, 9, 20) + [(7, 3, "user", "again.")] * 5
    schema = "conv_id bigint, turn bigint, role string, text string, row int, audit string, dropped boolean"
    df = spark.createDataFrame([(*r, 1, "x", None) for r in rows], schema).repartition(4)
    assert repaired(conversations.repair_report(df)) == repair_brute(rows)
    assert conversations.repair_report(df.limit(0)).collect() == []


def test_repaired_rows(spark):
    rows = random_conversations(60, 4, 9)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    made = defaultdict(list)
    for r in sorted(conversations.repair(conversations.damage(df)).collect(), key=lambda r: (r.conv_id or -1, r.position)):
        assert r.position == len(made[r.conv_id])
        made[r.conv_id].append(f"{r.role}:{r.text}")
    for conv, expected in repair_brute(rows).items():
        assert hashlib.sha256("\n".join(made[conv]).encode()).hexdigest() == expected[-1]


def test_long_conversation():
    """Costs and letters of a long conversation without a text per lattice node."""
    codes = bytes(random.Random(1).choices([2, 3, 1, 0, 2 | 4, 3 | 4, 8], k=40_000))
    cost, audit = conversations.cheapest_edits(codes)
    assert len(audit.replace("I", "")) == len(codes)
