"""Nearest neighbours by a permutation index (operator 10).

A vector is represented by its nearest pivots in order. Blocks of vectors post
those ranks in one inverted file for each pivot. For a query the files of its
own pivots add up how much the footrule distance between the two orders falls
short of its largest value. The candidates with the smallest distance are ranked
again by cosine; while the later half of the opened ones still holds one of the
nearest, twice as many are opened. Every row is indexed; a query meets every
block. Equal vectors are indexed once, with their smallest ids.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm import vectors
from tierflow.llm.common import stored

PIVOTS = 256  # a sample of the classes
LENGTH = 128  # pivots that represent a vector
OPENED, OPENED_ROWS = 0.2, 256  # of a block, at first; at least so many rows
BLOCK_ROWS = 8192
QUERY_ROWS = 2048
NEAREST = 5
EVERY = 50

FOUND = "query_id long, id long, score double"


def ordered_pivots(unit_rows: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the nearest pivots of each row, nearest first."""
    near = -(unit_rows @ pivots.T)
    length = min(length, len(pivots))
    part = np.argpartition(near, length - 1, axis=1)[:, :length]
    order = np.argsort(np.take_along_axis(near, part, 1), axis=1, kind="stable")
    return np.take_along_axis(part, order, 1)


class InvertedFiles:
    """For each pivot the rows of a block that have it among their nearest, with its rank."""

    def __init__(self, permutations: np.ndarray, pivots: int):
        self.rows, self.length = permutations.shape
        flat = permutations.reshape(-1)
        order = np.argsort(flat, kind="stable")
        self.row = order // self.length
        self.rank = order % self.length
        self.starts = np.searchsorted(flat[order], np.arange(pivots + 1))

    def closeness(self, permutation: np.ndarray) -> np.ndarray:
        """Twice the sum, over shared pivots, of length - max(rank, rank): the largest
        footrule distance less the distance of each row."""
        total = np.zeros(self.rows, np.int64)
        for rank, pivot in enumerate(permutation):
            part = slice(self.starts[pivot], self.starts[pivot + 1])
            # A row is in a pivot's file once.
            total[self.row[part]] += 2 * (self.length - np.maximum(self.rank[part], rank))
        return total


def nearest_in_block(query: np.ndarray, rows: np.ndarray, closeness: np.ndarray, ids: np.ndarray,
                     want: int, opened: float = OPENED) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and cosines of the nearest found, larger cosine and smaller id first."""
    order = np.argsort(-closeness, kind="stable")
    count = min(len(rows), max(OPENED_ROWS, int(opened * len(rows))))
    scores = rows[order[:count]] @ query
    while True:
        best = np.lexsort((ids[order[:count]], -scores))[:want]
        if count == len(rows) or (best < count // 2).all() and len(best) == want:
            return order[best], scores[best]
        more = min(len(rows), 2 * count)
        scores = np.append(scores, rows[order[count:more]] @ query)
        count = more


def _search(pivots: np.ndarray, want: int):
    def run(block: pa.Table, queries: pa.Table) -> pa.Table:
        size = pivots.shape[1]
        found: list[tuple[int, int, float]] = []
        rows, own = vectors.matrix(block.column("embedding"), size)
        asked, asking = vectors.matrix(queries.column("embedding"), size)
        if len(rows) and len(asked):
            ids = block.column("id").to_numpy()[own]
            unit, unit_asked = vectors.unit(rows), vectors.unit(asked)
            files = InvertedFiles(ordered_pivots(unit, pivots, LENGTH), len(pivots))
            names = queries.column("query_id").to_numpy()[asking]
            for name, query, permutation in zip(
                    names, unit_asked, ordered_pivots(unit_asked, pivots, LENGTH)):
                # One more than asked for: the query's own class may hold itself alone.
                at, scores = nearest_in_block(query, unit, files.closeness(permutation), ids, want + 1)
                found += zip([int(name)] * len(at), ids[at].tolist(), scores.tolist())
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()),
                         "id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})

    return run


def _found(reps: DataFrame, asked: DataFrame, every: int, want: int) -> DataFrame:
    """The nearest classes of one length in each block; queries of other lengths meet none."""
    pivots = vectors.sample(reps, PIVOTS)
    total = reps.count()
    blocks = max(1, -(-total // BLOCK_ROWS))
    chunks = max(1, -(-total // (every * QUERY_ROWS)))
    indexed = reps.select("id", "embedding", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"),
                          F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    asking = asked.where(F.size("embedding") == pivots.shape[1]).select(
        "query_id", "embedding", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    return (indexed.groupBy("block", "chunk").cogroup(asking.groupBy("block", "chunk"))
            .applyInArrow(_search(pivots, want), FOUND))


def nearest(rows: DataFrame, every: int = EVERY, want: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score) of (vec_id long, embedding): the nearest of every query.

    Queries are the rows whose vec_id is divisible by ``every``; candidates all
    others of its length. Vectors that are null, empty, zero or not finite take no
    part; neither do null ids. Rows that repeat id and vector count once. Ties go to the smaller vec_id; with fewer candidates all are
    returned; an empty table gives an empty one. Other columns are ignored.
    """
    valid = vectors.usable(rows)
    reps = vectors.classes(valid, "vector-classes")
    asked = (valid.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "h1", "h2"])
             .select(F.col("vec_id").alias("query_id"), "embedding"))
    found = reduce(DataFrame.unionAll, [_found(some, asked, every, want) for some in vectors.by_length(reps)])
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    found = stored(found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= want + 1)
                   .drop("_n"), "neighbour-classes")
    # The smallest ids of a class are all that a query can return of it.
    smallest = Window.partitionBy("h1", "h2").orderBy("vec_id")
    members = (valid.select("vec_id", "h1", "h2").dropDuplicates()
               .withColumn("_n", F.row_number().over(smallest)).where(F.col("_n") <= want + 1)
               .join(reps.select("id", "h1", "h2"), ["h1", "h2"]).select("id", "vec_id"))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.join(members, "id").where("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= want)
            .select("query_id", "rank", "vec_id", "score"))
