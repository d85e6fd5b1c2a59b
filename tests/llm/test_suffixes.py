"""Removal of repeated byte strings against a brute-force version and the registered SQL."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

from tierflow.llm import registry, suffix_dedup

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def brute(docs, length=200):
    """Counts every string of every text, then marks the bytes of those that occur twice."""
    texts, seen = [(i, (t or "").encode()) for i, t in docs], {}
    for _, data in texts:
        for at in range(len(data) - length + 1):
            part = data[at:at + length]
            seen[part] = seen.get(part, 0) + 1
    out = []
    for doc_id, data in texts:
        gone = np.zeros(len(data) + 1, np.int8)
        for at in range(len(data) - length + 1):
            if seen[data[at:at + length]] > 1:
                gone[at:at + length] = 1
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone])) == 1).sum())
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()), key=repr)


def test_query_equals_brute_force_and_sql(spark):
    got = registry.QUERIES["op12_suffix_dedup"](spark, FOLDER)
    assert got.columns == COLUMNS
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    want = brute(docs)
    assert rows_of(got) == want and sum(w[2] for w in want) > 0
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    sql = con.sql(registry.SQL["op12_suffix_dedup"])
    assert sorted(sql.columns) == sorted(COLUMNS)
    assert sorted(sql.select(", ".join(COLUMNS)).fetchall(), key=repr) == want


def made_texts(seed, n=60):
    rng = random.Random(seed)
    pool = ["".join(rng.choices("abcdef \n", k=rng.randint(150, 420))) for _ in range(6)] + ["é" * 130, "ab" * 160]
    out = []
    for i in range(n):
        parts = [rng.choice(pool)[rng.randint(0, 9):] if rng.random() < .5
                 else "".join(rng.choices("abcdefgh ", k=rng.randint(0, 300))) for _ in range(rng.randint(0, 5))]
        text = "".join(parts)
        if rng.random() < .2 and text:
            at = rng.randrange(len(text))
            text = text[:at] + "#" + text[at + 1:]
        out.append((i, text))
    return out


@pytest.mark.parametrize("seed,limit", [(1, 8192), (2, 3), (3, 2)])
def test_made_texts(frame, seed, limit):
    docs = made_texts(seed)
    got = suffix_dedup.remove_repeats(frame("doc_id long, text string", *docs), limit=limit).collect()
    digest = sorted(((r.doc_id, r.n_bytes, sum(s.end - s.begin for s in r.spans), len(r.spans),
                      hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got), key=repr)
    assert digest == brute(docs)


def test_crowded_passage_with_other_surroundings(frame):
    """One passage in every text: its pieces at the borders are all different."""
    rng = random.Random(5)
    passage = "".join(rng.choices("abcdefghij ", k=260))
    noise = lambda: "".join(rng.choices("klmnopqrst ", k=220))
    docs = [(i, noise() + passage + noise()) for i in range(120)]
    table = frame("doc_id long, text string", *docs)
    for limit in (10, 8192):
        got = suffix_dedup.remove_repeats(table, limit=limit).collect()
        want = {w[0]: w[2:4] for w in brute(docs)}
        assert {r.doc_id: (sum(s.end - s.begin for s in r.spans), len(r.spans)) for r in got} == want


def test_long_text_in_chunks(frame, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    docs = made_texts(7, 40) + [(100, "".join(t for _, t in made_texts(7, 12)))]
    assert rows_of(suffix_dedup.repeat_digests(frame("doc_id long, text string", *docs))) == brute(docs)


def test_sorted_suffixes_of_a_collection():
    """The order's shared prefixes find what a search in every other piece of the group finds."""
    rng = random.Random(9)
    pieces = []
    for _ in range(200):
        left, right = rng.randint(0, 6), rng.randint(6, 12)
        pieces.append((rng.randint(0, 5), left, bytes(rng.choices(b"ab", k=left)) + bytes(rng.choices(b"ab", k=right))))
    pieces.sort(key=lambda p: p[0])
    size = np.array([len(p[2]) for p in pieces])
    first = np.cumsum(size) - size
    anchor = np.array([p[1] for p in pieces])
    data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    found = suffix_dedup.repeated_starts(data, first, size, anchor, np.array([p[0] for p in pieces]), 7)
    for i, (group, at, text) in enumerate(pieces):
        for s in range(len(text)):
            part = text[s:s + 7]
            there = any(j != i and g == group and s - at + a >= 0 and t[s - at + a:s - at + a + 7] == part
                        for j, (g, a, t) in enumerate(pieces)) and len(part) == 7
            assert found[first[i] + s] == there


def test_edge_rows(frame):
    long = "".join(random.Random(2).choices("abcdefghijkl ", k=5000))
    rows = [(1, None), (2, ""), (3, "a" * 199), (4, "a" * 200), (5, "b" * 201), (6, "c" * 200), (6, "c" * 200),
            (None, long), (None, long[100:]), (8, long), (8, "x" * 5000), (9, "é" * 100 + "z"), (10, "é" * 100)]
    docs = frame("doc_id long, text string, row string, spans int, begin long", *[(*r, "a", 1, 2) for r in rows])
    assert rows_of(suffix_dedup.repeat_digests(docs)) == brute(rows)
    assert rows_of(suffix_dedup.repeat_digests(frame("doc_id long, text string"))) == []
    assert rows_of(suffix_dedup.repeat_digests(frame("doc_id long, text string", (1, None)))) == brute([(1, None)])
