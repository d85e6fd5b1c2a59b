"""Near-duplicate vectors and nearest neighbours against brute force."""

import numpy as np
import pytest

from tierflow.llm import near_vectors, neighbours, registry

SCHEMA = "vec_id long, embedding array<float>, label int, id string"


def unit(rows):
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def groups(cosines, least):
    """Smallest reachable row of each row."""
    root = np.arange(len(cosines))
    for a, b in zip(*np.nonzero(cosines >= least)):
        low, high = sorted((root[a], root[b]))
        root[root == high] = low
    return root


@pytest.fixture(scope="module")
def planted():
    rng = np.random.default_rng(6)
    base = rng.normal(size=(700, 16))
    near = base[3] + 0.05 * rng.normal(size=(250, 16))
    pairs = base[:60] + 0.08 * rng.normal(size=(60, 16))
    copies = np.repeat(base[5:6], 120, axis=0)
    return np.concatenate([base, near, pairs, copies]).astype(np.float32)


def rows_of(vectors):
    return [(i, [float(x) for x in v], 0, "x") for i, v in enumerate(vectors)]


def test_planted_groups_links_and_kept_rows(frame, planted, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK_ROWS", 128)
    monkeypatch.setattr(near_vectors, "SHARD_ROWS", 100)
    got = {r.vec_id: r for r in near_vectors.linked_vectors(frame(SCHEMA, *rows_of(planted))).collect()}
    cosines = unit(planted.astype(float)) @ unit(planted.astype(float)).T
    np.fill_diagonal(cosines, 0)
    links, root = (cosines >= 0.9).sum(1), groups(cosines, 0.9)
    assert len(got) == len(planted)
    found = np.array([got[i].n_links for i in range(len(planted))])
    assert (found <= links).all() and found.sum() >= 0.99 * links.sum()
    assert np.mean([got[i].component_id == root[i] for i in range(len(planted))]) >= 0.99
    assert all(r.kept == (r.component_id == r.vec_id) for r in got.values())


def test_edge_vectors_link_with_nothing(frame):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1, "a"), (2, [0.0, 0.0], 1, "a"), (3, [nan, 1.0], 1, "a"), (4, [None, 1.0], 1, "a"),
            (5, [inf, 1.0], 1, "a"), (6, [1.0, 0.0], 1, "a"), (7, [2.0, 0.0], 1, "a"), (8, [1.0, 0.0], 1, "a"),
            (8, [1.0, 0.0], 1, "a"), (None, [1.0, 0.0], 1, "a"), (9, [], 1, "a"), (10, [1.0], None, None),
            (11, [0.0, 1.0], 1, "a"), (12, [1e-38, 0.0], 1, "a")]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors.linked_vectors(
        frame(SCHEMA, *rows)).collect()}
    assert got == {**{i: (0, i, True) for i in (1, 2, 3, 4, 5, 9, 10, 11)}, 6: (3, 6, True),
                   7: (3, 6, False), 8: (3, 6, False), 12: (3, 6, False)}
    assert near_vectors.linked_vectors(frame(SCHEMA)).collect() == []
    near = [(r.query_id, r.rank, r.vec_id) for r in neighbours.nearest(frame(SCHEMA, *rows), 8).collect()]
    assert sorted(near) == [(8, 1, 6), (8, 2, 7), (8, 3, 12), (8, 4, 11)]
    assert neighbours.nearest(frame(SCHEMA)).collect() == []


def test_a_graph_reaches_every_row_and_searches_find_ranges():
    rng = np.random.default_rng(1)
    rows = unit(np.concatenate([rng.normal(size=(150, 8)), rng.normal(size=(1, 8)) + 0.02 * rng.normal(
        size=(150, 8)), np.ones((3, 8))]))
    lists = near_vectors.build_graph(rows)
    assert near_vectors._reached([set(x.tolist()) for x in lists], 0).all()
    starts = np.cumsum([0, *map(len, lists)])
    seen = near_vectors.range_search(rows, rows, starts, np.concatenate(lists), 0.9)
    exact = rows @ rows.T
    met = seen > -2
    assert np.allclose(seen[met], exact[met])
    assert ((seen >= 0.9) & (exact >= 0.9)).sum() >= 0.99 * (exact >= 0.9).sum()


def nearest_by_force(ids, vectors, every, want=5):
    u, out = unit(vectors.astype(float)), {}
    for i in np.flatnonzero(ids % every == 0):
        s = u @ u[i]
        order = [j for j in np.lexsort((ids, -np.round(s, 12))) if j != i][:want]
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order]
    return out


def recall(rows, truth):
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(truth)
    hits = 0
    for q, best in truth.items():
        own = found[q]
        assert [r.rank for r in own] == list(range(1, len(best) + 1))
        assert all(a.score >= b.score for a, b in zip(own, own[1:]))
        hits += len({r.vec_id for r in own} & {i for i, _ in best})
    return hits / sum(map(len, truth.values()))


def test_neighbours_with_copies_and_a_dense_group(frame, planted):
    ids = np.arange(len(planted))
    got = neighbours.nearest(frame(SCHEMA, *rows_of(planted)), 10).collect()
    truth = nearest_by_force(ids, planted, 10)
    assert recall(got, truth) >= 0.9
    scores = {(q, i): s for q, best in truth.items() for i, s in best}
    assert all(abs(r.score - scores[r.query_id, r.vec_id]) < 1e-9 for r in got if (r.query_id, r.vec_id) in scores)


def test_queries_on_the_test_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows])
    got = registry.QUERIES["op10_nearest_neighbours"](spark, folder).collect()
    assert recall(got, nearest_by_force(ids, vectors, 50)) >= 0.9
    linked = registry.QUERIES["op3_near_vectors"](spark, folder).collect()
    cosines = unit(vectors.astype(float)) @ unit(vectors.astype(float)).T
    np.fill_diagonal(cosines, 0)
    expected = dict(zip(ids.tolist(), (cosines >= 0.9).sum(1).tolist()))
    assert {r.vec_id: r.n_links for r in linked} == expected


def test_vectors_of_every_length_take_part(frame):
    """Four vectors of two components among longer ones: all have a cosine of 1 with each other."""
    rows = [(i, [1.0, float(i), 2.0]) for i in range(1, 8)]
    rows += [(50, [1.0, 2.0]), (51, [2.0, 4.0]), (52, [1.0, 2.0]), (53, [1.0, 2.0]), (54, [7.0])]
    table = frame("vec_id long, embedding array<double>", *rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.linked_vectors(table).collect()}
    assert [got[i] for i in (50, 51, 52, 53)] == [(3, 50)] * 4 and got[54] == (0, 54)
    near = [(r.rank, r.vec_id, round(r.score, 12)) for r in neighbours.nearest(table).collect() if r.query_id == 50]
    assert sorted(near) == [(1, 51, 1.0), (2, 52, 1.0), (3, 53, 1.0)]


def test_audit_looks_at_queries_and_fails_a_poor_build(frame, monkeypatch):
    rows = [(i, [1.0, 0.0]) for i in range(200)] + [(300, [0.0, 1.0]), (301, [0.0, 2.0])]
    reps = near_vectors.vectors.classes(near_vectors.vectors.usable(
        frame("vec_id long, embedding array<double>", *rows)), "test-classes")
    none = frame("id long, n long", (0, 0), (300, 0), (301, 0))
    half = frame("id long, n long", (300, 1), (301, 0))
    assert near_vectors.audited_recall(reps, none, 0.9) == 0.0
    assert near_vectors.audited_recall(reps, half, 0.9) == 0.5  # the large class alone has no links as a class
    monkeypatch.setattr(near_vectors, "audited_recall", lambda *a: 0.5)
    with pytest.raises(RuntimeError, match="recall"):
        near_vectors.linked_vectors(frame("vec_id long, embedding array<double>", *rows[-5:]))
