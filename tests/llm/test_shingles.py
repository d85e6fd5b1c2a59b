"""N-gram Jaccard join against brute force over all pairs."""

import random
import re

import numpy as np

from tierflow.llm import registry, shingle_join

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute(docs):
    """doc_id -> (set size, component) from all pairs."""
    sets = {}
    for doc, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets[doc] = ({tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5
                     else {tuple(words)} if words else set())
    root = {d: d for d in sets}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    return {d: (len(sets[d]), root[d]) for d in sets}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_query_on_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert result(registry.QUERIES["op5_ngram_jaccard_join"](spark, "/root/testdata/sf0.001")) == brute(docs)


def test_near_copies_around_the_threshold_and_common_passages(frame, monkeypatch):
    rng = random.Random(9)
    base = [f"b{i}" for i in range(60)]
    passage = [f"p{i}" for i in range(12)]
    docs = []
    for i in range(90):
        words = base.copy()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(words)))
    docs += [(100 + i, " ".join([*passage, *(f"u{i}-{j}" for j in range(rng.randint(0, 9)))])) for i in range(40)]
    monkeypatch.setattr(shingle_join, "BLOCK_ROWS", 8)
    expected = brute(docs)
    assert len({c for _, c in expected.values()}) not in (1, len(docs))
    assert result(shingle_join.similar_texts(frame("doc_id long, text string", *docs))) == expected


def test_edge_rows(frame):
    schema = "doc_id long, text string, id string, token int, component_id int"
    rows = [(1, None, "a", 1, 1), (2, "", "a", 1, 1), (3, " \t\n", "a", 1, 1), (4, "One two", "a", 1, 1),
            (5, "one  TWO", "a", 1, 1), (6, "two one", "a", 1, 1), (7, "é É w x y", "a", 1, 1),
            (8, "É É w x y", "a", 1, 1), (9, "word " * 30000, "a", 1, 1), (10, "word " * 5, "a", 1, 1),
            (11, "a b c d e", None, None, None), (11, "a b c d e", None, None, None)]
    table = frame(schema, *rows)
    got = result(shingle_join.similar_texts(table))
    assert got == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (1, 6), 7: (1, 7), 8: (1, 8),
                   9: (1, 9), 10: (1, 9), 11: (1, 11)}
    nulls = shingle_join.similar_texts(frame(schema, (None, "a b", "x", 1, 1), (3, "a b", "x", 1, 1)))
    assert {(r.doc_id, r.component_id) for r in nulls.collect()} == {(None, None), (3, 3)}
    assert shingle_join.similar_texts(frame(schema)).collect() == []
    kept = shingle_join.one_of_each(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 8, 9, 11, 11]


def test_null_id_before_an_equal_text_hides_no_near_copy(frame):
    words = [f"w{i}" for i in range(60)]
    text, near = " ".join(words), " ".join([*words[:-1], "other"])
    table = frame("doc_id long, text string", (None, text), (1, text), (2, near), (None, near)).coalesce(1)
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in shingle_join.similar_texts(table).collect())
    assert got == [(0, 0), (0, 0), (1, 1), (2, 1)]
    assert sorted(r.doc_id or 0 for r in shingle_join.one_of_each(table).collect()) == [0, 0, 1]


def test_one_of_each_where_texts_share_a_doc_id(frame):
    words = [f"w{i}" for i in range(60)]
    text, near, more = (" ".join([*words[:59 - i], *f"{i} other".split()]) for i in range(3))
    rows = [(1, text), (5, near), (5, "like nothing else at all here"), (None, text), (7, near), (1, more)]
    kept = shingle_join.one_of_each(frame("doc_id long, text string", *rows)).collect()
    assert {r.text for r in kept if r.doc_id == 5} == {"like nothing else at all here"}
    assert {r.doc_id for r in kept} == {None, 1, 5}
    assert sum(r.doc_id == 1 for r in kept) == 1


def test_union_bound_never_hides_a_member():
    rng = np.random.default_rng(2)
    for _ in range(100):
        sets = [np.unique(rng.integers(0, 30, rng.integers(1, 25))).astype(np.uint64) for _ in range(6)]
        block = shingle_join.Block(sets[1:])
        expected = [i for i, s in enumerate(sets[1:]) if 100 * len(np.intersect1d(sets[0], s))
                    >= 80 * len(np.union1d(sets[0], s))]
        assert block.linked(sets[0], 80).tolist() == expected


def test_prefixes_of_similar_sets_share_what_is_promised():
    rng = np.random.default_rng(5)
    for _ in range(3000):
        n = int(rng.integers(1, 120))
        a = np.unique(rng.integers(0, 10**6, n))
        drop = rng.random(len(a)) < rng.uniform(0, 0.15)
        b = np.unique(np.concatenate([a[~drop], rng.integers(0, 10**6, int(rng.integers(0, 1 + n // 8)))]))
        shared = len(np.intersect1d(a, b))
        if not len(b) or 100 * shared < 80 * len(np.union1d(a, b)):
            continue
        (pa, least_a), (pb, least_b) = (shingle_join.prefix_sizes(len(x), 80) for x in (a, b))
        assert len(np.intersect1d(a[:pa], b[:pb])) >= max(least_a, least_b)


def test_one_of_each_with_clashing_and_dotted_columns(frame):
    text = " ".join(f"w{i}" for i in range(40))
    table = frame("doc_id long, text string, _document long, `a.b` string, _gone int", (1, text, 7, "x", 1),
                  (2, text, 8, "y", 2), (3, "another text", 9, "z", 3))
    kept = shingle_join.one_of_each(table)
    assert kept.columns == table.columns
    assert sorted(map(tuple, kept.collect())) == [(1, text, 7, "x", 1), (3, "another text", 9, "z", 3)]


def test_passage_in_every_text(frame, monkeypatch):
    """Its tokens come last in the order, so they pair no texts; near copies are still found."""
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(i, " ".join([*(f"u{i}-{j}" for j in range(80)), passage])) for i in range(120)]
    docs += [(200 + i, docs[i][1] + " end") for i in range(0, 120, 3)]
    table = frame("doc_id long, text string", *docs)
    levels, made = shingle_join.token_levels(table), []
    write = shingle_join.stored
    monkeypatch.setattr(shingle_join, "stored", lambda df, label: made.append((label, write(df, label))) or made[-1][1])
    assert result(shingle_join.similar_texts(table)) == brute(docs)
    pairs = [df.count() for label, df in made if label == "shingle-pairs"]
    assert levels.max() >= 4 * 7 - 2 and pairs[0] < len(docs)


def test_order_is_one_for_all_sets():
    rng = np.random.default_rng(8)
    levels = rng.integers(0, 60, 1 << shingle_join.CELL_BITS).astype(np.uint8)
    tokens = np.unique(rng.integers(0, 2**63, 500).astype(np.uint64) * np.uint64(2))
    numbers = shingle_join.ordered(tokens, levels)
    assert len(np.unique(numbers)) == len(tokens)
    level = levels[(tokens >> np.uint64(64 - shingle_join.CELL_BITS)).astype(int)]
    assert (np.diff(level[np.argsort(numbers)].astype(int)) >= 0).all()
    assert set(shingle_join.first_tokens(tokens, levels, 50)) == set(np.sort(numbers)[:50])


def test_union_bound_of_a_bitmap():
    rng = np.random.default_rng(3)
    for _ in range(50):
        union, query = (np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (300, 80))
        query = np.unique(np.concatenate([query, union[:rng.integers(0, 200)]]))
        bound = shingle_join.Union.of(union).most_shared(query)
        shared = len(np.intersect1d(union, query))
        assert shared <= bound <= shared + 30
    assert shingle_join.Union.of(union[:0]).most_shared(query) == 0


def test_groups_of_near_copies_in_several_blocks(frame, monkeypatch):
    """Components that are linked only across blocks, at sizes around the threshold."""
    rng = random.Random(12)
    docs = []
    for g in range(6):
        base = [f"g{g}w{i}" for i in range(50 + g)]
        for i in range(30):
            words = base[:50 + rng.randint(-6, g)]
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(40)}"
            docs.append((100 * g + i, " ".join(words)))
    monkeypatch.setattr(shingle_join, "BLOCK_ROWS", 4)
    monkeypatch.setattr(shingle_join, "QUERIES", 3)
    assert result(shingle_join.similar_texts(frame("doc_id long, text string", *docs))) == brute(docs)
