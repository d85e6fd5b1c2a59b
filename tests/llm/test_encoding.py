"""BPE encoding, decoding and packing against the tokenizers library."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tierflow.llm import encoding, packing, registry, word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["Hello world's 123 <|endoftext|> x", "Éé\tà á ﬁ İSTANBUL ß 's'T ΑΣ x<|startoftext|>y", "",
       "   ", "a" * 300, "\x1c \x1f a\x1db", "日本語テスト 한국어 ½²x ªº don't I'LL we'Ve é ́ a b　c",
       "!!!???...", "🎉🎉 <|endoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endoftext |>", "a​b﻿c",
       "x̣́ ỵ́", "A,b.c", "é,É.", "\x00\x01"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def bpe():
    return word_bpe.WordBpe(PATH)


def test_odd_texts_encode_and_decode_as_the_library(library, bpe):
    flat, sizes = bpe.encode([*ODD, None])
    ends = np.cumsum(sizes)
    for text, end, size in zip([*ODD, ""], ends, sizes):
        ids = flat[end - size:end].tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert bpe.decode(np.array(ids, int)) == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_any_text_encodes_as_the_library(text):
    own = word_bpe.encoder(PATH)
    assert own.encode([text])[0].tolist() == own.library.encode(text, add_special_tokens=False).ids


def test_walk_shares_prefixes_in_any_set_of_words(library, bpe):
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("abeinrst", k=rng.randint(1, 12))) for _ in range(2000)})
    for word, ids in bpe.walk([w.encode() for w in words]):
        assert ids == library.encode(word.decode(), add_special_tokens=False).ids


def test_forgetting_keeps_results(library, monkeypatch):
    own = word_bpe.WordBpe(PATH)
    monkeypatch.setattr(word_bpe, "KEEP", 40)
    rng = random.Random(5)
    for _ in range(20):
        text = " ".join(["the"] * 9 + ["".join(rng.choices("abcde", k=4)) for _ in range(30)])
        assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_slices_cover_all_rows_once():
    assert list(word_bpe.slices([5, 5, 5], 10)) == [(0, 2), (2, 3)]
    assert list(word_bpe.slices([50, 1], 10)) == [(0, 1), (1, 2)]
    assert list(word_bpe.slices([0, 0], 10)) == [(0, 2)]
    assert list(word_bpe.slices([], 10)) == []


EDGE = [(1, "one two", 7), (None, "three", 1), (2, None, 2), (3, "", None), (1, "one two", 7),
        (4, "word " * 5000, 0)]
EDGE_SCHEMA = "doc_id long, text string, n_tokens int"


def test_edge_rows_of_the_encoder(frame, library):
    rows = encoding.encode_texts(frame(EDGE_SCHEMA, *EDGE), PATH).collect()
    got = collections.Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in rows)
    expected = collections.Counter()
    for key, text, _ in EDGE:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected[key, len(ids), np.array(ids, "<u4").tobytes(),
                 library.decode(ids, skip_special_tokens=False)] += 1
    assert got == expected
    assert encoding.encode_texts(frame(EDGE_SCHEMA), PATH).collect() == []


def places_hold(rows, capacity):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_edge_rows_of_packing(frame):
    rows = packing.packed_documents(frame(EDGE_SCHEMA, *EDGE), PATH, 64).collect()
    places_hold(rows, 64)
    long = sorted(r.length for r in rows if r.doc_id == 4)
    assert sum(long) == 5001 and long.count(64) == 78
    assert sorted((r.length, r.ids_crc32) for r in rows if r.doc_id in (2, 3)) == [
        (1, zlib.crc32(b"\0\0\0\0"))] * 2
    assert len([r for r in rows if r.doc_id == 1]) == 2
    assert packing.packed_documents(frame(EDGE_SCHEMA), PATH, 64).collect() == []


def fewest(lengths, capacity):
    """Bins of an optimal packing, by search."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def put(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= lengths[i] and rooms[j] not in rooms[:j]:
                put(i + 1, [*rooms[:j], rooms[j] - lengths[i], *rooms[j + 1:]])
        put(i + 1, [*rooms, capacity - lengths[i]])

    put(0, [])
    return best


def planned(lengths, capacity, steps):
    plan = packing.Plan(capacity, dict(collections.Counter(lengths)))
    for step in steps:
        step(plan)
    return plan


def test_reduction_never_costs_a_sequence():
    rng = random.Random(11)
    for _ in range(400):
        capacity = rng.choice([6, 9, 12, 20])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        plan = planned(lengths, capacity, [packing.reduce_instance])
        rest = [x for x, n in plan.counts.items() for _ in range(n)]
        assert plan.sequences + fewest(rest, capacity) == fewest(lengths, capacity)


def test_plans_place_every_piece_once():
    rng = random.Random(12)
    for _ in range(200):
        capacity = rng.choice([10, 37, 100])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 200))]
        plan = packing.plan_packing(dict(collections.Counter(lengths)), capacity)
        cells, ranks = collections.defaultdict(list), collections.Counter()
        for length, begin, end, each, first, offset in plan.rows:
            assert begin == ranks[length]
            ranks[length] = end
            for r in range(end - begin):
                cells[first + r // each].append((offset + r % each * length, length))
        assert ranks == collections.Counter(lengths)
        for held in cells.values():
            at = 0
            for offset, length in sorted(held):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(cells) == plan.sequences
        assert plan.sequences >= -(-sum(lengths) // capacity)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", "text").collect()


def test_encoding_query_on_the_test_table(spark, library, documents):
    rows = {r.doc_id: r for r in registry.QUERIES["op7_bpe_encoding"](
        spark, "/root/testdata/sf0.001").collect()}
    assert len(rows) == len(documents)
    for doc in documents:
        ids = library.encode(doc.text, add_special_tokens=False).ids
        row = rows[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(
            library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_packing_query_on_the_test_table(spark, library, documents):
    rows = registry.QUERIES["op4_best_fit_packing"](spark, "/root/testdata/sf0.001").collect()
    expected, total = set(), 0
    for doc in documents:
        ids = np.array([*library.encode(doc.text, add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start:start + 2048]
            expected.add((doc.doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == expected
    assert len(rows) == len(expected)
    assert places_hold(rows, 2048) <= 1.02 * total / 2048 + 1
