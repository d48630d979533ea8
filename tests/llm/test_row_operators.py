"""Operators on pairs, mixtures, places and tokens, and the pipeline, against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from test_text_operators import decontamination_brute, edge_rows, plain_words, quality_brute, words_of

import corpus_pipeline
from stagewatch.llm import components, mixing, neardup, quality, queries, sharding, token_counts, token_files

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, kept string"


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


# Near duplicates


def fingerprint_brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words_of(low)
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def groups_brute(prints, radius=3):
    """Smallest index reachable per index."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_near_duplicates_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect())
    prints = [fingerprint_brute(r.text) for r in rows]
    expected = {r.doc_id: (f"{p:016x}", rows[g].doc_id) for r, p, g in zip(rows, prints, groups_brute(prints))}
    got = queries.op2_simhash(spark, SF).collect()
    assert len(got) == len(rows) and {r.doc_id: (r.fingerprint, r.component_id) for r in got} == expected


def test_near_duplicates_edges(spark, edges):
    got = neardup.near_duplicates(edges).collect()
    rows = edge_rows()
    assert Counter((r.doc_id, r.fp & (2**64 - 1)) for r in got) == Counter((r[0], fingerprint_brute(r[1])) for r in rows)
    assert {r.component_id for r in got if r.fp == 0} == {1}
    assert neardup.near_duplicates(edges.limit(0)).collect() == []
    kept = neardup.drop_near_duplicates(edges)
    ids = [r.doc_id for r in kept.collect()]
    # One of the empty texts, one of the repeated rows; of the rows without an id the one that is near no other.
    assert kept.columns == edges.columns and ids.count(8) == 1 and 1 in ids and 2 not in ids and 7 not in ids
    roots = {r.component_id for r in got}
    assert len(ids) == len(roots) + sum(r.doc_id is None and r.component_id is None for r in got) - (None in roots)
    assert neardup.drop_near_duplicates(edges.limit(0)).collect() == []


def test_a_near_copy_without_an_id_goes_and_columns_of_any_name_stay(spark):
    words = [f"w{i * i % 389}" for i in range(400)]
    near = " ".join([*words[:-1], "other"])
    table = spark.createDataFrame([(None, near, "a", "b"), (3, " ".join(words), "c", "d"), (None, near, "e", "f")],
                                  "doc_id bigint, text string, `__key` string, `row` string")
    prints = [fingerprint_brute(t) for t in (near, " ".join(words))]
    assert prints[0] != prints[1] and bin(prints[0] ^ prints[1]).count("1") <= 3
    assert [tuple(r) for r in neardup.drop_near_duplicates(table).collect()] == [(3, " ".join(words), "c", "d")]


def test_one_row_of_each_component_stays_whatever_its_id(spark):
    def prose(k):
        return " ".join(f"t{k}.{i * i % 89}" for i in range(60))

    rows = [(0, prose(1)), (0, prose(2)), (0, prose(3)), (0, prose(3)), (None, prose(4)), (None, prose(4)), (None, prose(1)),
            (None, prose(5)), (7, prose(5)), (None, prose(6)), (5, prose(7)), (6, prose(7))]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = neardup.drop_near_duplicates(table).collect()
    expected = [(0, prose(1)), (0, prose(2)), (0, prose(3)), (None, prose(4)), (7, prose(5)), (None, prose(6)), (5, prose(7))]
    assert Counter(map(tuple, got)) == Counter(expected)


@pytest.mark.parametrize("block", [8, 4096])
def test_links_of_fingerprints_need_no_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(block)
    prints = {0, 2**64 - 1}
    for _ in range(60):
        prints.add(rng.getrandbits(64))
    for _ in range(5):  # chains and balls around a centre
        centre = chain = rng.getrandbits(64)
        for _ in range(40):
            prints.add(centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
            chain ^= sum(1 << b for b in rng.sample(range(64), 3))
            prints.add(chain)
    prints = sorted(prints)
    table = spark.createDataFrame([(neardup._signed(p),) for p in prints], "fp bigint")
    links = neardup.fingerprint_links(table)
    root = list(range(len(prints)))
    place = {neardup._signed(p): i for i, p in enumerate(prints)}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    found = links.collect()
    for a, b in found:
        assert bin((a ^ b) & (2**64 - 1)).count("1") >= 1
        x, y = find(place[a]), find(place[b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(prints))] == groups_brute(prints)


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 120)] + [(500, k) for k in range(501, 700)] + [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)]
    got = dict(components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    root = {}

    def find(i):
        while root.get(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    nodes = {n for e in edges for n in e}
    assert got == {n: find(n) for n in nodes if find(n) != n}


# Mixture


def mix_brute(rows, weights=(3, 1, 2)):
    """rows: (doc_id, size, source); words taken by row index, with targets by repeated resharing."""
    sizes = defaultdict(int)
    for _, n, s in rows:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, free, budget = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        level = budget / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            budget -= target[s]
        free -= full
    return sizes, target


@pytest.mark.parametrize("seed", range(2))
def test_mixture(spark, seed):
    rng = random.Random(seed)
    rows = [(i, " ".join("w" * rng.randrange(1, 60)), rng.choice(["a", "b", "b", "b", "c", "Z", "é", None, ""])) for i in range(600)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix_report(table).collect()
    sizes, target = mix_brute([(i, len(words_of(t)), s) for i, t, s in rows])
    source = {i: s for i, _, s in rows}
    taken = Counter()
    for r in got:
        s = source[r.doc_id]
        taken[s] += r.taken
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s]) and r.taken <= 2 * r.size and r.taken % r.size == 0
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 30
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix_report(table.repartition(7)).collect()))
    mixed = Counter(r.doc_id for r in mixing.mix(table).collect())
    assert mixed == Counter({r.doc_id: r.taken // r.size for r in got if r.taken})


def test_mixture_edges(spark, edges):
    report = mixing.mix_report(edges)
    assert report.count() == len(edge_rows()) and {r.taken for r in report.collect() if r.doc_id in (1, 2)} == {0}
    assert mixing.mix(edges.withColumnsRenamed({"size": "target", "kept": "source_size"})).columns[-2:] == ["target", "source_size"]
    assert mixing.mix_report(edges.limit(0)).collect() == [] and mixing.mix(edges.limit(0)).collect() == []


# Shards


@pytest.mark.parametrize("total", [1, 2, 3, 5, 8, 17, 100, 1000, 4097])
def test_permutation(total):
    assert sorted(sharding.permuted(np.arange(total), total)) == list(range(total))


def test_permutation_shuffles():
    places = sharding.permuted(np.arange(10_000), 10_000)
    assert abs(np.corrcoef(np.arange(10_000), places)[0, 1]) < 0.05
    assert [sharding.shard_of(i, 10_000, 8) for i in range(50)] == [(p % 8, p // 8) for p in places[:50].tolist()]
    assert (sharding.permuted(np.arange(100), 100, seed=2) != sharding.permuted(np.arange(100), 100, seed=1)).any()


def shards_are_right(got, rows):
    expected = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == expected
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[k]) for k in range(8)]
    assert max(counts) - min(counts) <= 1


def test_shards(spark, edges):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op3_shards(spark, SF).collect()
    shards_are_right(got, [(r.doc_id, r.text) for r in docs.collect()])
    again = sharding.shard_report(docs.repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    order = sorted(got, key=lambda r: r.doc_id)
    assert [(r.shard, r.slot) for r in order] == [sharding.shard_of(i, len(order), 8) for i in range(len(order))]
    shards_are_right(sharding.shard_report(edges).collect(), [(r[0], r[1]) for r in edge_rows()])
    assert sharding.shard_report(edges.limit(0)).collect() == []


# Tokens


def test_token_counts_equal_a_plain_viterbi_search(spark, edges):
    from tokenizers import Tokenizer, models

    scores = token_counts.zipf_scores(queries.tokenizer_path(queries.PIECE_MODEL))
    unigram = Tokenizer(models.Unigram([("<unk>", min(scores.values())), *scores.items()], 0, False))

    def best(word):
        known = [(0.0, 0)]
        for n in range(1, len(word) + 1):
            options = [(known[k][0] + scores[word[k:n]], -known[k][1] - 1) for k in range(n) if word[k:n] in scores]
            if word[n - 1] not in scores:
                options.append((known[-1][0] + min(scores.values()) - 10, -known[-1][1] - len(word[n - 1].encode())))
            top = max(options)
            known.append((top[0], -top[1]))
        return known[-1]

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).unionByName(
        edges.filter("doc_id <> 8").selectExpr("doc_id + 1000000", "text").toDF("doc_id", "text")).unionByName(
        spark.createDataFrame([(-1, "日本語 ಕ\U0001F600 a b")], "doc_id bigint, text string"))
    table = {i: t for i, t in docs.collect() if i is not None}
    remembered = {}
    for r in token_counts.token_report(docs, queries.tokenizer_path(queries.PIECE_MODEL)).filter("doc_id is not null").collect():
        words = ["▁" + w for w in words_of(table[r.doc_id])]
        found = [remembered[w] if w in remembered else remembered.setdefault(w, best(w)) for w in words]
        assert (r.n_words, r.n_tokens) == (len(words), sum(n for _, n in found)) and r.score == pytest.approx(math.fsum(s for s, _ in found))
    for word in list(remembered)[:2000]:
        ids = unigram.encode(word, add_special_tokens=False).ids
        assert 0 in ids or len(ids) == remembered[word][1]
    assert token_counts.token_report(docs.limit(0), queries.tokenizer_path(queries.PIECE_MODEL)).collect() == []


STRANGE = ["It's 3.5%, isn't it?", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "ÉTÉ ÀÉ… naïve,", "Σας ΣΑΣ", "éa á, ́ b", "a b　c",
           "don't, we'll'", "x!!", "!!x!!", "日本。語,", "'s 's, 't", "A.B.C.", "ǅungla İstanbul", "1st,2nd; 3rd", "word'", "…,", "ß,SS", "a\x00b \x1f"]


def test_words_encode_as_texts_do():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path(queries.WORD_TOKENIZER)
    words, whole = token_files.WordEncoder(path), Tokenizer.from_file(path)
    for text in STRANGE * 2:
        assert np.frombuffer(words.encode(text.encode()), words.dtype).tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_token_files_round_trip(spark, edges, monkeypatch, tmp_path):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path(queries.WORD_TOKENIZER)
    whole = Tokenizer.from_file(path)
    extra = spark.createDataFrame(list(enumerate(STRANGE, 10**6)), "doc_id bigint, text string")
    for docs in (spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(extra), edges.select("doc_id", "text")):
        got = token_files.token_file_report(docs, path).collect()
        rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
        expected, start = Counter(), defaultdict(set)
        at = 0
        for r in rows:
            ids = np.array(whole.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
            expected[r.doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
            at += len(ids)
        assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
        ordered = sorted(got, key=lambda r: r.start)
        assert [r.doc_id for r in ordered] == [r.doc_id for r in rows] and sum(r.n_tokens for r in got) == at
        assert [r.start for r in ordered] == [0, *np.cumsum([r.n_tokens for r in ordered])[:-1].tolist()]
    assert token_files.token_file_report(docs.limit(0), path).collect() == []


def test_sequences_have_equal_length_and_a_mask(spark, tmp_path):
    docs = spark.createDataFrame([(i, "word " * (i % 50)) for i in range(300)], "doc_id bigint, text string").coalesce(1)
    manifest = token_files.write_token_files(docs, queries.tokenizer_path(queries.WORD_TOKENIZER), str(tmp_path), length=16).collect()
    for row in manifest:
        file = token_files.TokenFile(str(tmp_path), row.path)
        n = -(-row.ids // 16)
        stream = np.concatenate([file.sequence(k)[0][file.sequence(k)[1]] for k in range(n)])
        assert len(stream) == row.ids and (stream == np.concatenate(list(file.ids(0, row.ids)))).all()
        assert all(len(file.sequence(k)[0]) == 16 for k in range(n)) and file.sequence(0)[1].all()


# Pipeline


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    names, stages = zip(*corpus_pipeline.STAGES)
    good = stages[0](spark, docs, SF)
    verdict = {r.doc_id: r.kept for r in quality.quality_report(docs).collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, k in verdict.items() if k}
    assert not any(verdict[i] for i, r in rows.items() if quality_brute(r.text)[5])

    one = stages[1](spark, good, SF)
    ids = sorted(r.doc_id for r in good.collect())
    groups = groups_brute([fingerprint_brute(rows[i].text) for i in ids])
    assert sorted(r.doc_id for r in one.collect()) == sorted(ids[g] for g in set(groups))

    clean = stages[2](spark, one, SF)
    left = {r.doc_id: r.text for r in clean.collect()}
    for r in one.collect():
        n, hit, *_ = decontamination_brute(r.text, items)
        if hit * 2 > n:
            assert r.doc_id not in left
        elif not hit:
            assert left[r.doc_id] == r.text
        else:
            assert len(plain_words(left[r.doc_id])) == n - hit

    mixture = stages[3](spark, clean, SF)
    sizes, target = mix_brute([(r.doc_id, len(words_of(r.text)), r.source) for r in clean.collect()])
    taken, largest = Counter(), Counter()
    for r in mixture.collect():
        taken[r.source] += len(words_of(r.text))
    for r in clean.collect():
        largest[r.source] = max(largest[r.source], len(words_of(r.text)))
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)

    shards = stages[4](spark, mixture, SF)
    shards_are_right(shards.collect(), [(r.doc_id, r.text) for r in mixture.collect()])
    assert all(s(spark, docs, SF).columns == docs.columns for s in stages[:-1])
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == Counter(map(tuple, shards.collect()))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    from compare import difference, duck, duck_rows, spark_rows

    assert difference(spark_rows(queries.QUERIES[name](spark, SF)), duck_rows(duck(SF), queries.ORACLE[name])) is None


def test_digest_of_no_items():
    assert decontamination_brute("a b", [])[3] == hashlib.sha256(b"").hexdigest()
