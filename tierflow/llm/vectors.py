"""Vectors as classes of equal ones, shared by near-dedup and neighbour search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import stored


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding array<double>, h1, h2) of distinct rows that take part.

    Left out are null ids and vectors that are null, empty, zero or hold null or
    non-finite components.
    """
    value = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select("vec_id", value.alias("embedding")).where(
        F.col("vec_id").isNotNull() & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("embedding", lambda x: x != 0))
    return rows.select("vec_id", "embedding", F.xxhash64("embedding").alias("h1"),
                       F.xxhash64(F.lit(1), "embedding").alias("h2"))


def classes(rows: DataFrame, label: str) -> DataFrame:
    """(id, h1, h2, copies, embedding) of ``usable`` rows: the smallest vec_id of equal
    vectors, how many ids have that vector, and the vector."""
    ids = rows.dropDuplicates(["vec_id", "h1", "h2"])
    grouped = ids.groupBy("h1", "h2").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    return stored(grouped.join(rows.select(F.col("vec_id").alias("id"), "h1", "h2", "embedding"),
                               ["id", "h1", "h2"]).dropDuplicates(["id", "h1", "h2"]), label)


def sample(reps: DataFrame, most: int) -> np.ndarray:
    """Unit vectors of at most ``most`` classes of one length, chosen by a hash of the id, in its order."""
    chosen = reps.orderBy(F.xxhash64("id"), "id").limit(most).select("embedding").toArrow()
    rows = [np.array(x) for x in chosen.column(0).to_pylist()]
    if not rows:
        return np.zeros((0, 1))
    return unit(np.stack(rows))


def by_length(reps: DataFrame) -> list[DataFrame]:
    """Classes by the length of their vectors: vectors of other lengths have no cosine, so each is a problem of its own."""
    lengths = sorted(r.length for r in reps.select(F.size("embedding").alias("length")).distinct().collect())
    return [reps.where(F.size("embedding") == n) for n in lengths] if len(lengths) > 1 else [reps]


def matrix(column: pa.Array | pa.ChunkedArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of the given length as rows, and which rows of the column they are."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    own = np.flatnonzero(lengths == size)
    flat = column.take(pa.array(own)).flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(own), size), own


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1, scaled first so that no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
