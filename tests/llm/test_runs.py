"""Periodic runs of words against a brute-force version."""

import hashlib
import random
import re
import zlib

import pytest

from tierflow.llm import periodic_runs, registry

FOLDER = "/root/testdata/sf0.001"


def brute(words, least=6, times=4):
    """Every period, every stretch of equal words at that lag, no splitting, no marks."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)  # the smallest period comes first
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_equals_brute_force(spark):
    got = registry.QUERIES["op11_periodic_runs"](spark, FOLDER)
    assert got.columns == COLUMNS
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    want = sorted(expected(r.doc_id, r.text) for r in docs)
    assert sorted(map(tuple, got.collect())) == want
    assert sum(w[1] for w in want) > 10


@pytest.mark.parametrize("least,times", [(6, 4), (2, 2), (9, 3)])
def test_random_texts(least, times):
    rng = random.Random(least)
    texts = []
    for i in range(400):
        words = rng.choices([b"a", b"b", b"c", b"d"][:rng.randint(1, 4)], k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            part = rng.choices([b"a", b"b", b"x"], k=rng.randint(1, 9))
            words[rng.randint(0, len(words)):0] = part * rng.randint(2, 6) + part[:rng.randint(0, len(part))]
        texts.append(words)
    got = periodic_runs.runs_of_texts(texts, least, times)
    assert got == [brute(words, least, times) for words in texts]


def test_runs_that_overlap_or_lie_in_each_other():
    part = [b"a"] * 7 + [b"b"]
    words = part * 6 + [b"a", b"b"] * 9 + [b"b"] * 8
    got = periodic_runs.runs_of_texts([words])[0]
    assert got == brute(words) and len(got) > 7


def test_long_texts_with_long_periods():
    rng = random.Random(3)
    part = [b"w%d" % rng.randint(0, 300) for _ in range(4000)]
    words = [b"start"] + part * 5 + [b"end"] + [b"x"] * 30_000
    assert periodic_runs.runs_of_texts([words])[0] == [(1, 20_000, 4000), (20_002, 30_000, 1)]


def test_splitting_leaves_only_frequent_words():
    import numpy as np
    words = np.array([0, 1] * 6 + [2] + [3] * 5 + [4, 5, 6])
    place, segment = periodic_runs.split_by_frequency(words, np.zeros(len(words), int))
    assert place.tolist() == list(range(12)) and set(segment.tolist()) == {0}
    two = np.repeat([0, 1], [6, 6])  # the same words, but of two texts
    assert len(periodic_runs.split_by_frequency(words[:12], two)[0]) == 0


def test_edge_rows(frame):
    rows = [(1, None, "x", 5), (2, "", "x", 5), (3, " \t\n ", "x", 5), (4, "a " * 9, "x", 5), (4, "a " * 9, "x", 5),
            (None, "b\x0bb\x0cb\rb\nb\tb", None, None), (5, "é é " * 8, "x", 5), (-3, "a\x1ca " * 6, "x", 5)]
    docs = frame("doc_id long, text string, runs string, h int", *rows)
    got = sorted(map(tuple, periodic_runs.run_digests(docs).collect()), key=repr)
    assert got == sorted((expected(r[0], r[1]) for r in rows), key=repr)
    one = periodic_runs.find_runs(docs).where("doc_id = 4").first()
    assert (one.n_words, one.collapsed, [tuple(r) for r in one.runs]) == (9, "a", [(0, 9, 1)])
    assert periodic_runs.run_digests(frame("doc_id long, text string")).collect() == []
