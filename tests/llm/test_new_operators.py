"""Token alignment, collocations and packing against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tests.llm import brute, data

from tidemark.llm import alignment, collocations, frames, packing, vocabulary
from tidemark.llm import words as w

# What tokenizers may stumble over.
ODD_TEXTS = [
    "don't  stop\t\tnow \n\n next", "  two blanks first", "trailing  ", " \n ", "a b  c d   e", "<|endoftext|> <s> </s>",
    "x <|startoftext|>y <unk>", "U+2581 ▁ lost", "café café ́x Å ﬁ Ǆ ß İ", "日本語 テキスト 🙂🙂 👩‍👩‍👧", "\x00 \x01 a\x01b \x1c\x1d \x85",
    "1234567 3.14 x=1;y=2", "'s 't 'LL I'm", "İstanbul ΣΑΣ", "a" * 3000, "tab\tnew\nline\r\nend \x0b\x0c x", "\x7f \x7f\x80 end",
]


def token_rows():
    rows = [(d, t, s) for d, t, s in data.edge_rows() if len(t or "") < 50_000]
    return rows + [(1000 + i, t, "a") for i, t in enumerate(ODD_TEXTS)] + [(2000, "same words here", "b")] * 7


def long_row(words=60_000):
    return (3000, data.sentence(random.Random(1), words), "c")


# ------------------------------------------------------------------ alignment


def check_alignment(spark, rows):
    docs = data.documents(spark, rows)
    found, pairs = alignment.align(docs, groups=True)
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "groups_sha256")
    expected, counts = brute.aligned([(d, t) for d, t, _ in rows])
    got = Counter(tuple(r) for r in found.select(*columns).collect())
    assert got == Counter((*x, brute.sha(x[-1]) if x[-1] else "") for x in expected)
    assert {(r["id_a"], r["id_b"]): r["n_links"] for r in pairs.collect()} == dict(counts)
    return pairs


def test_alignment_of_awkward_rows(spark):
    check_alignment(spark, [*token_rows(), long_row(20_000)])


@pytest.mark.parametrize("listed, entries, chunks", [(1, 0, 50), (3, 10**6, 10**6)])
def test_alignment_in_small_blocks(spark, monkeypatch, listed, entries, chunks):
    monkeypatch.setattr(alignment, "LISTED", listed)
    monkeypatch.setattr(alignment, "BLOCK_ENTRIES", entries)
    monkeypatch.setattr(alignment, "OPEN_BLOCKS", 2)
    monkeypatch.setattr(w, "PIECE_ROWS", 5)
    monkeypatch.setattr(vocabulary, "MEMO_CHUNKS", chunks)
    monkeypatch.setattr(vocabulary, "LOOKUP", 40)
    pairs = check_alignment(spark, token_rows())
    most = pairs.orderBy("n_docs", ascending=False).first()
    assert 1 < most["n_docs"] <= most["n_links"]


def test_documents_of_a_pair(spark):
    pairs = alignment.align(data.documents(spark, [(1, "the the the", "a"), (2, "the", "a"), (2, "the", "a"), (3, None, "a")])).pairs
    assert [(r["n_docs"], r["n_links"], r["best"]) for r in pairs.collect()] == [(3, 5, True)]


def test_alignment_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(alignment, "broadcast_if_small", lambda df, rows: df)
    check_alignment(spark, token_rows()[:40])


# ------------------------------------------------------------------ collocations


def phrase_rows(seed=4):
    rng = random.Random(seed)
    vocabulary_ = ["new", "York", "city", "of", "the", "United", "states", "x", "é", "a\x00b"]
    out = []
    for i in range(300):
        words = [rng.choice(vocabulary_) for _ in range(rng.randrange(0, 30))]
        text = "".join(x + rng.choice([" ", " ", "\t", "  ", ", ", ".", "\n", " ! "]) for x in words)
        out.append((i % 250, rng.choice([text, text.upper(), None if i % 40 == 0 else text]), rng.choice(["en", "de", None])))
    return out + [(900, "new york city " * 3000, "en"), (None, "", "fr"), (901, "lone words only", "it")]


def phrase_docs(spark, rows):
    return spark.createDataFrame(
        [(d, t, s, "x", 1) for d, t, s in rows], "doc_id long, text string, lang string, phrase string, hash long"
    )


@pytest.mark.parametrize("shards, slots, threshold", [(4, 1 << 16, 10), (1, 1 << 16, 3), (5, 64, 6)])
def test_collocations(spark, monkeypatch, shards, slots, threshold):
    monkeypatch.setattr(collocations, "SHARDS", shards)
    monkeypatch.setattr(collocations, "LEAST_SLOTS", slots)
    monkeypatch.setattr(collocations, "MOST_SLOTS", slots)
    monkeypatch.setattr(w, "PIECE_ROWS", 20)
    rows = phrase_rows()
    spec = collocations.Spec(threshold=threshold, top=30)
    docs = phrase_docs(spark, rows).repartition(3)
    found = collocations.collocations(docs, spec)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert Counter(tuple(r) for r in found.collect()) == Counter(brute.phrases([(s, t) for _, t, s in rows], threshold, 50, 30))


def test_cycles_count_in_full(spark, monkeypatch):
    """Counts under hashes, cut off after a cycle, equal counts under texts."""
    monkeypatch.setattr(collocations, "SHARDS", 3)
    rows = phrase_rows()
    texts = collocations.corpus(phrase_docs(spark, rows).repartition(4))
    spec = collocations.Spec(threshold=4)
    _, frequent = collocations.count(texts, spec, 1 << 16)
    spelled = collocations.spell(texts, frequent, 1 << 16)
    assert frequent.count() == spelled.count() > 50
    expected = Counter()
    for lang, _, phrase, a, *_ in brute.phrases([(s, t) for _, t, s in rows], 4, 10**9, 10**6):
        expected[lang, phrase] = a
    assert {(r["lang"], r["phrase"]): r["a"] for r in spelled.collect()} == dict(expected)


def test_counts_travel_as_blocks(spark, monkeypatch):
    """Between rounds there are some rows per length and round, not one per phrase."""
    held = []

    def staged(df, label, **more):
        out = frames.staged(df, label, **more)
        if label in ("phrases-counts", "phrases-words"):
            held.append(out.count())
        return out

    monkeypatch.setattr(collocations, "staged", staged)
    texts = collocations.corpus(phrase_docs(spark, phrase_rows()).repartition(3))
    _, frequent = collocations.count(texts, collocations.Spec(threshold=4), 1 << 16)
    assert frequent.count() > 200
    assert 0 < max(held) <= 20


def test_collocations_in_many_small_blocks(spark, monkeypatch):
    for name, value in (("PART_BYTES", 512), ("BLOCK", 7), ("BLOCKS_AT_ONCE", 2), ("GATHERED", 64), ("MOST_BITS", 64)):
        monkeypatch.setattr(collocations, name, value)
    monkeypatch.setattr(w, "PIECE_BYTES", 400)
    rng = random.Random(8)
    long = ["a", "a\x00", "abcdefgh", "abcdefgh\x00", "abcdefghi", "ABCDEFGHI", "x" * 64, "x" * 65, "X" * 66, "y" + "é" * 300]
    rows = phrase_rows()[:120] + [(i, " ".join(rng.choices(long, k=40)), "en") for i in range(60)] + [(99, "of the " * 300, None)]
    found = collocations.collocations(phrase_docs(spark, rows).repartition(3), collocations.Spec(threshold=5, top=200))
    assert Counter(tuple(r) for r in found.collect()) == Counter(brute.phrases([(s, t) for _, t, s in rows], 5, 50, 200))


def test_hashes_of_words():
    """Words differ by each byte and by length, not by case or by where they stand."""
    texts = ["a", "a\x00", "b", "a" * 8, "a" * 9, "a" * 8 + "b", "a" * 16, "a" * 17, "a" * 64, "a" * 65, "a" * 64 + "b", "ü" * 40]
    texts = [*texts, *(x.upper() for x in texts if x.isascii()), *texts, "", " . "]
    data, offsets = w.text_buffer(pa.array(texts))
    of = {}
    for word, h in zip(texts, collocations.Phrases(data, offsets, np.zeros(len(texts), dtype=w.U)).one, strict=False):
        assert of.setdefault(word.lower() if word.isascii() else word, h) == h
    assert len(set(of.values())) == len(of) == 12


def test_collocations_of_large_counts(spark):
    """Products beyond 64 bits."""
    row = spark.range(1).selectExpr("9000000000000000 a", "9000000000000001 l", "9000000000000003 r")
    found = row.select(collocations._score("a", "l", "r").alias("s")).first()["s"]
    assert found == 1_000_000 * 9000000000000000**2 // (9000000000000001 * 9000000000000003)


# ------------------------------------------------------------------ packing


def check_packing(spark, rows, spec):
    docs = data.documents(spark, rows)
    packed = packing.pack(docs, spec, ids=True)
    given = Counter((d, tuple(brute.tokenized(t, spec.vocabulary, spec.end))) for d, t, _ in rows)
    pieces = Counter()
    for (d, ids), n in given.items():
        for i, start in enumerate(range(0, len(ids), spec.room)):
            part = ids[start : start + spec.room]
            pieces[d, i, start, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()), part] += n
    found = packed.collect()
    assert Counter((*r[:5], tuple(r["ids"])) for r in found) == pieces
    placed = defaultdict(list)
    for r in found:
        placed[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= spec.room
    assert len(placed) == brute.best_fit([r["length"] for r in found], spec.room)
    whole = packing.sequences(packed).collect()
    assert len(whole) == len(placed)
    for r in whole:
        assert len(r["ids"]) == sum(p["length"] for p in r["parts"]) <= spec.room


@pytest.mark.parametrize("room, chunks", [(4096, 10**6), (50, 60), (7, 10**6)])
def test_packing(spark, monkeypatch, room, chunks):
    monkeypatch.setattr(vocabulary, "MEMO_CHUNKS", chunks)
    monkeypatch.setattr(vocabulary, "LOOKUP", min(chunks, 1000))
    monkeypatch.setattr(w, "PIECE_ROWS", 9)
    rows = token_rows() + ([long_row(20_000)] if room == 4096 else [])
    check_packing(spark, rows, packing.Spec(room=room))


@pytest.mark.parametrize("seed", range(40))
def test_plan_places_as_best_fit_does(seed):
    rng = random.Random(seed)
    room = rng.choice([10, 64, 500])
    lengths = [rng.choice([rng.randrange(1, room + 1), rng.randrange(1, 2 + room // 5), room // 2]) for _ in range(rng.randrange(0, 400))]
    counts = Counter(lengths)
    runs, used = packing.plan(counts, room)
    assert used == brute.best_fit(lengths, room)
    space, ranks = defaultdict(list), defaultdict(list)
    for length, rank, n, per, sequence, offset in runs.tolist():
        for i in range(n):
            space[sequence + i // per].append((offset + i % per * length, length))
            ranks[length].append(rank + i)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    for parts in space.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= room
    assert sorted(space) == list(range(used))


def test_plan_does_not_grow_with_the_documents():
    rng = random.Random(2)
    counts = Counter(min(4096, int(rng.paretovariate(0.7) * 30)) for _ in range(200_000))
    small, _ = packing.plan(counts, 4096)
    large, used = packing.plan({k: n * 10**9 for k, n in counts.items()}, 4096)
    assert len(small) <= 24 * len(counts) and len(large) <= 24 * len(counts)
    assert used * 4096 <= 1.001 * 10**9 * sum(k * n for k, n in counts.items())


# ------------------------------------------------------------------ all three


@pytest.mark.parametrize("operator", [lambda d: alignment.align(d).documents, collocations.collocations, packing.pack])
def test_empty_table(spark, operator):
    assert operator(data.documents(spark, [])).collect() == []


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("a", "some text"), (None, "text"), ("b", None)], "doc_id string, text string")
    assert sorted(str(r["doc_id"]) for r in packing.pack(docs).collect()) == ["None", "a", "b"]
    assert sorted(str(r["doc_id"]) for r in alignment.align(docs).documents.collect()) == ["None", "a", "b"]
