"""Near-duplicate vectors by a robust-pruned flat graph (operator 3).

1. Equal vectors are one class. Centroids fitted on a sample send each class to
   its nearest few shards, which so overlap; large shards are cut into blocks.
2. Each block builds a graph: a node keeps, nearest first, the neighbours that no
   kept one is much nearer to. Lists of a node from all its shards are united.
3. Each block is searched from its medoid for every class of its shard. The
   search is greedy and keeps a beam; a node within range is always expanded, so
   the beam grows until the range around the query is exhausted.
4. Cosines found are exact, in double precision; a pair counts in the first
   shard that both have. Recall is audited against all rows for a query sample;
   if it falls short, the graph is built again with more overlap.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm import vectors
from tierflow.llm.common import components, stored

COSINE = 0.9
SAMPLE_ROWS = 8192  # centroids are fitted on at most so many classes
SHARD_ROWS = 512  # classes for each centroid, before overlap
CENTROIDS = 2048  # at most; beyond, shards have more blocks
OVERLAP = 3  # shards of a class
BLOCK_ROWS = 1536
DEGREE = 16
CANDIDATES = 48  # nearest ones that the pruning looks at
ALPHA = 1.2
BEAM = 24
EXPAND = 4  # beam nodes expanded in one step
AUDIT_QUERIES = 256
RECALL = 0.95
LEAST_RECALL = 0.9
AUDITS = 3

NODES = "id long, near array<long>"
FOUND = "id long, n long, other long"


def centroids(sample: np.ndarray, many: int, steps: int = 8) -> np.ndarray:
    """Spherical k-means of the sample; starts from its first rows."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    centres = sample[:many].copy()
    for _ in range(steps):
        own = (sample @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        length = np.sqrt(np.einsum("ij,ij->i", sums, sums))
        centres = np.where(length[:, None] > 0, sums / np.maximum(length, 1e-300)[:, None], centres)
    return centres


def pruned(near: np.ndarray, similar: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> list:
    """Robust pruning: of candidates, nearest first, those that no kept one covers.

    ``near`` has the squared distance of each candidate, ``similar`` the squared
    distances between candidates.
    """
    kept: list[int] = []
    open_ = np.ones(len(near), bool)
    for i in range(len(near)):
        if open_[i]:
            kept.append(i)
            if len(kept) == degree:
                break
            open_ &= alpha * alpha * similar[i] > near
    return kept


def build_graph(rows: np.ndarray) -> list[np.ndarray]:
    """Neighbour lists of a block: pruned lists and their reverse, all reachable from the medoid."""
    n = len(rows)
    cosines = rows @ rows.T
    np.fill_diagonal(cosines, -2)
    count = min(CANDIDATES, n - 1)
    lists: list[set[int]] = [set() for _ in range(n)]
    if count:
        part = np.argpartition(-cosines, count - 1, axis=1)[:, :count]
        order = np.argsort(-np.take_along_axis(cosines, part, 1), axis=1, kind="stable")
        part = np.take_along_axis(part, order, 1)
        for i in range(n):
            near = part[i]
            between = 2 - 2 * cosines[np.ix_(near, near)]
            for j in pruned(2 - 2 * cosines[i, near], between):
                lists[i].add(int(near[j]))
                lists[int(near[j])].add(i)
    reached = _reached(lists, medoid(rows))
    while not reached.all():
        # The nearest pair of a reached and an unreached node becomes an edge.
        inside, outside = np.flatnonzero(reached), np.flatnonzero(~reached)
        block = cosines[np.ix_(outside, inside)]
        a, b = np.unravel_index(block.argmax(), block.shape)
        a, b = int(outside[a]), int(inside[b])
        lists[a].add(b)
        lists[b].add(a)
        reached |= _reached(lists, a)
    return [np.array(sorted(x), np.int64) for x in lists]


def _reached(lists: list[set[int]], start: int) -> np.ndarray:
    reached = np.zeros(len(lists), bool)
    reached[start] = True
    stack = [start]
    while stack:
        for j in lists[stack.pop()]:
            if not reached[j]:
                reached[j] = True
                stack.append(j)
    return reached


def medoid(rows: np.ndarray) -> int:
    """The row nearest to the mean."""
    return int((rows @ rows.mean(0)).argmax())


def range_search(queries: np.ndarray, rows: np.ndarray, starts: np.ndarray, edges: np.ndarray,
                 least: float, beam: int = BEAM) -> np.ndarray:
    """Cosines [query, row] of all rows seen; -2 for rows the search did not meet.

    Per step every query expands the best unexpanded nodes of its beam and all
    unexpanded nodes within range, until neither is left.
    """
    seen = np.full((len(queries), len(rows)), -2.0)
    expanded = np.zeros(seen.shape, bool)
    start = medoid(rows)
    seen[:, start] = queries @ rows[start]
    beam = min(beam, len(rows))
    live = np.arange(len(queries))
    while len(live):
        own, done = seen[live], expanded[live]
        top = np.argpartition(-own, beam - 1, axis=1)[:, :beam]
        values = np.where(np.take_along_axis(done, top, 1), -3, np.take_along_axis(own, top, 1))
        pick = np.argsort(-values, axis=1)[:, :EXPAND]
        chosen = np.zeros(own.shape, bool)
        np.put_along_axis(chosen, np.take_along_axis(top, pick, 1),
                          np.take_along_axis(values, pick, 1) > -2, 1)
        chosen |= (own >= least) & ~done
        q, node = np.nonzero(chosen)
        busy = np.unique(q)
        expanded[live[q], node] = True
        many = starts[node + 1] - starts[node]
        inside = np.arange(int(many.sum())) + np.repeat(starts[node] - np.cumsum(many) + many, many)
        at = np.unique(np.repeat(live[q], many) * len(rows) + edges[inside])
        at = at[seen.reshape(-1)[at] == -2.0]
        a, b = at // len(rows), at % len(rows)
        for part in range(0, len(at), 1 << 16):
            x, y = a[part:part + (1 << 16)], b[part:part + (1 << 16)]
            seen[x, y] = np.einsum("ij,ij->i", queries[x], rows[y])
        live = live[busy]
    return seen


def _build(size: int):
    def run(block: pa.Table) -> pa.Table:
        rows, own = vectors.matrix(block.column("embedding"), size)
        ids = block.column("id").to_numpy()[own]
        lists = build_graph(vectors.unit(rows))
        return pa.table({"id": pa.array(ids, pa.int64()),
                         "near": pa.array([ids[x] for x in lists], pa.list_(pa.int64()))})

    return run


def _count(size: int, least: float):
    def run(block: pa.Table, queries: pa.Table) -> pa.Table:
        shard = block.column("shard")[0].as_py() if len(block) else None
        rows, own = vectors.matrix(block.column("embedding"), size)
        asked, asking = vectors.matrix(queries.column("embedding"), size)
        out: list[tuple[int, int, int | None]] = []
        if len(rows) and len(asked):
            ids, names = block.column("id").to_numpy()[own], queries.column("id").to_numpy()[asking]
            copies = block.column("copies").to_numpy()[own]
            lists = block.column("near").take(pa.array(own))
            order = np.argsort(ids)
            flat = lists.combine_chunks().flatten().to_numpy(zero_copy_only=False)
            place = order[np.minimum(np.searchsorted(ids[order], flat), len(ids) - 1)]
            counts = pa.compute.list_value_length(lists).to_numpy()
            inside = ids[place] == flat  # neighbours that are in this block too
            source = np.repeat(np.arange(len(ids)), counts)[inside]
            starts = np.searchsorted(source, np.arange(len(ids) + 1))
            found = range_search(vectors.unit(asked), vectors.unit(rows), starts, place[inside],
                                 least) >= least
            if len(names) == len(ids) and set(names) == set(ids):
                # A block searched for its own classes: what one side met counts for both.
                to = np.argsort(ids)[np.searchsorted(np.sort(ids), names)]
                square = found[:, to]
                found[:, to] = square | square.T
            found &= names[:, None] != ids[None, :]
            # A pair counts in the smallest shard that both are in.
            theirs = _shards(block.column("shards"), own)
            mine = _shards(queries.column("shards"), asking)
            q, v = np.nonzero(found)
            common = np.where((mine[q][:, :, None] == theirs[v][:, None, :]).any(2), mine[q], 1 << 40)
            first = common.min(1) == shard
            totals = np.bincount(q[first], copies[v[first]], len(names)).astype(np.int64)
            # Edges that connect what is connected here: the smallest other of each query.
            lowest = np.full(len(names), 1 << 62)
            np.minimum.at(lowest, q, ids[v])
            out = [(int(i), int(n), int(o) if o < 1 << 62 else None)
                   for i, n, o in zip(names, totals, lowest) if n or o < 1 << 62]
            root = {int(i): int(min(i, o)) for i, o in zip(names, lowest)}
            out += [(int(a), 0, int(b)) for a, b in
                    _spanning(names[q], ids[v], root)]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table({"id": pa.array(columns[0], pa.int64()), "n": pa.array(columns[1], pa.int64()),
                         "other": pa.array(columns[2], pa.int64())})

    return run


def _shards(column: pa.ChunkedArray, own: np.ndarray) -> np.ndarray:
    lists = column.take(pa.array(own)).to_pylist()
    return np.array(lists, np.int64)


def _spanning(a: np.ndarray, b: np.ndarray, known: dict[int, int]) -> list[tuple[int, int]]:
    """Pairs that connect nodes which the known links leave apart, and no more."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in known.items():
        root[top(x)] = top(y)
    pairs = []
    for x, y in zip(a.tolist(), b.tolist()):
        s, t = top(x), top(y)
        if s != t:
            root[s] = t
            pairs.append((x, y))
    return pairs


def links(reps: DataFrame, least: float, overlap: int) -> DataFrame:
    """(id, n, other): parts of the classes' link counts, and links that connect them."""
    total = reps.count()
    sample = vectors.sample(reps, SAMPLE_ROWS)
    size = sample.shape[1]
    many = max(1, min(CENTROIDS, len(sample), total // SHARD_ROWS))
    centres = reps.sparkSession.sparkContext.broadcast(centroids(sample, many))
    overlap = min(overlap, many)

    def assign(batches):
        for batch in batches:
            rows, own = vectors.matrix(batch.column("embedding"), size)
            near = -(vectors.unit(rows) @ centres.value.T) if len(rows) else np.zeros((0, many))
            shards = np.argpartition(near, overlap - 1, axis=1)[:, :overlap]
            yield pa.RecordBatch.from_arrays(
                [*[c.take(pa.array(own)) for c in batch.columns],
                 pa.array(list(shards.astype(np.int64)), pa.list_(pa.int64()))],
                [*batch.schema.names, "shards"])

    placed = stored(reps.select("id", "copies", "embedding").mapInArrow(
        assign, "id long, copies long, embedding array<double>, shards array<long>"), "vector-shards")
    members = placed.select("*", F.explode("shards").alias("shard"))
    counts = members.groupBy("shard").count().select(
        "shard", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("blocks"))
    # a row per shard, at most CENTROIDS
    blocks = members.join(F.broadcast(stored(counts, "vector-shard-sizes")), "shard").withColumn(
        "block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    lists = (blocks.select("id", "embedding", "shard", "block").groupBy("shard", "block")
             .applyInArrow(_build(size), NODES))
    # at most (degree + reverse edges) x overlap neighbours each
    graph = lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    nodes = stored(blocks.drop("blocks").join(graph, "id"), "vector-graph")
    nodes = nodes.join(F.broadcast(counts), "shard")
    target = nodes.select("shard", "block", "id", "copies", "embedding", "near", "shards", F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("asking"))
    asking = nodes.select(
        *[F.col(c).alias(n) for c, n in (("shard", "shard"), ("block", "asking"), ("id", "id"),
                                         ("embedding", "embedding"), ("shards", "shards"))],
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    keys = ("shard", "block", "asking")
    return stored(target.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(
        _count(size, least), FOUND), "vector-links")


def audited_recall(reps: DataFrame, counts: DataFrame, least: float) -> float:
    """Mean share of a query's links that the counts (id, n) have, over a sample of queries
    that have any; these are found by comparing the sample with all rows in blocks."""
    asked = reps.orderBy(F.xxhash64(F.lit(2), "id"), "id").limit(AUDIT_QUERIES).select(
        "id", "embedding").toArrow()
    sizes = [len(x) for x in asked.column("embedding").to_pylist()]
    if not sizes:
        return 1.0
    size = int(np.bincount(sizes).argmax())
    rows, own = vectors.matrix(asked.column("embedding"), size)
    names = asked.column("id").to_numpy()[own]
    queries = reps.sparkSession.sparkContext.broadcast((names, vectors.unit(rows)))

    def compare(batches):
        names, unit = queries.value
        for batch in batches:
            found, own = vectors.matrix(batch.column("embedding"), size)
            if len(own):
                ids = batch.column("id").to_numpy()[own]
                near = (unit @ vectors.unit(found).T >= least) & (names[:, None] != ids)
                n = near @ batch.column("copies").to_numpy()[own]
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(n.astype(np.int64))],
                                                 ["id", "n"])

    truth = (reps.select("id", "copies", "embedding").mapInArrow(compare, "id long, n long")
             .groupBy("id").agg(F.sum("n").alias("real")))
    share = truth.join(counts, "id", "left").where("real > 0").agg(
        F.avg(F.least("real", F.coalesce("n", F.lit(0))) / F.col("real"))).first()[0]
    return 1.0 if share is None else share


def _audited_links(reps: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Links and counts of the classes of one length; a build is used if its audit is passed.

    Each further try has twice the overlap. If the last one's recall is below
    LEAST_RECALL too, that is an error.
    """
    overlap = OVERLAP
    for last in [False] * (AUDITS - 1) + [True]:
        found = links(reps, least, overlap)
        counts = stored(found.groupBy("id").agg(F.sum("n").alias("n")), "vector-counts")
        recall = audited_recall(reps, counts, least)
        if recall >= (LEAST_RECALL if last else RECALL):
            return found, counts
        overlap *= 2
    raise RuntimeError(f"recall of links is {recall:.3f}")


def linked_vectors(rows: DataFrame, least: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every distinct row of (vec_id long, embedding).

    Two vectors link at a cosine of ``least``; n_links counts other vectors, copies
    included. Vectors that are null, empty, zero or not finite link with nothing and
    are kept; vectors link with those of their own length. Rows that repeat are one;
    null ids are left out. An empty table gives an empty one.
    """
    valid = vectors.usable(rows)
    reps = vectors.classes(valid, "vector-classes")
    searched = [_audited_links(some, least) for some in vectors.by_length(reps)]
    found = reduce(DataFrame.unionAll, [links_ for links_, _ in searched])
    counts = reduce(DataFrame.unionAll, [counts_ for _, counts_ in searched])
    edges = found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b"))
    parts = components(edges.distinct()).withColumnRenamed("node", "id")
    known = reps.join(counts, "id", "left").join(parts, "id", "left").select(
        "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    member = valid.select("vec_id", "h1", "h2").join(known, ["h1", "h2"]).drop("h1", "h2")
    member = member.groupBy("vec_id").agg(F.max("n_links").alias("n_links"),
                                          F.min("component_id").alias("component_id"))
    every = rows.select("vec_id").where("vec_id is not null").distinct()
    return every.join(member, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").cast("long").alias("component_id"),
        (F.coalesce("component_id", "vec_id") == F.col("vec_id")).alias("kept"))
