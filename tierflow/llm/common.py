"""Helpers shared by the operators: written intermediate tables, components, column names."""

from __future__ import annotations

import io
import os
import zipfile
import zlib
from collections.abc import Callable, Iterator
from functools import reduce
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.session import scratch_path

MAX_ROUNDS = 60  # of component search; paths of 2**60 links never occur


_SHIPPED: set[str] = set()
_CACHE: dict[Any, Any] = {}


def worker_cache(key: Any, build: Callable[[], Any]) -> Any:
    """What a Python worker keeps between tasks: one operator's memory, the last one's.

    Workers serve one operator after the other, so another key drops the rest.
    """
    if key not in _CACHE:
        _CACHE.clear()
        _CACHE[key] = build()
    return _CACHE[key]


def ship_package(spark: SparkSession) -> None:
    """Give the package to the executors' Python, unless their search path has it.

    The archive lies in the shared folder; executors fetch it from there.
    """
    package = Path(__file__).resolve().parents[1]
    application = spark.sparkContext.applicationId
    if str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    if application not in _SHIPPED:
        archive = io.BytesIO()
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as file:
            for source in sorted(package.rglob("*.py")):
                file.write(source, source.relative_to(package.parent))
        target = f"{scratch_path(spark, 'package')}/tierflow.zip"
        path = spark._jvm.org.apache.hadoop.fs.Path(target)
        stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
        stream.write(bytearray(archive.getvalue()))
        stream.close()
        spark.sparkContext.addPyFile(target)
        _SHIPPED.add(application)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared folder and read back: cuts its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pick(df: DataFrame, *names: str) -> list[Column]:
    """The named columns, whatever else the table has."""
    return [df[n] for n in names]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column is called so."""
    while name in df.columns:
        name = "_" + name
    return name


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``edges`` (a long, b long) as (node, component).

    Alternates large-star and small-star steps, both minima over neighbours that
    combine map-side, until the edges no longer change; the component is the
    smallest node. Nodes without an edge are not returned. Each round's edges are
    written to the shared folder; only two numbers a round reach the driver.
    """
    spark = edges.sparkSession
    now = (edges.where("a is not null and b is not null and a <> b")
           .select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct())
    now = stored(now, label)
    seen = _state(now)
    for _ in range(MAX_ROUNDS):
        if seen[0] == 0:
            break
        now = stored(_small_star(_large_star(now)), label)
        after = _state(now)
        if after == seen:
            break
        seen = after
    else:
        raise RuntimeError("components did not settle")
    roots = now.select("m").distinct().select(F.col("m").alias("node"), F.col("m").alias("component"))
    return now.select(F.col("v").alias("node"), F.col("m").alias("component")).union(roots)


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.select(F.col("v").alias("u"), F.col("m").alias("n")).union(
        edges.select(F.col("m").alias("u"), F.col("v").alias("n")))
    low = both.groupBy("u").agg(F.min("n").alias("low")).select(
        "u", F.least("u", "low").alias("low"))
    return (both.join(low, "u").where("n > u").select(F.col("n").alias("v"), F.col("low").alias("m"))
            .where("v <> m").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    low = edges.groupBy("v").agg(F.min("m").alias("low"))
    moved = edges.join(low, "v").select(F.col("m").alias("v"), F.col("low").alias("m"))
    own = low.select("v", F.col("low").alias("m"))
    return moved.union(own).where("v <> m").distinct()


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str],
                 rows: int = 16_384) -> Iterator[tuple[pa.Table, list[int]]]:
    """Rows sorted by ``keys`` as (table, where its groups begin and the last one ends).

    No group is divided; a table has at least ``rows`` rows, but for the last one, and
    at most a batch and a group more.
    """
    held: list[pa.RecordBatch] = []

    def grouped(table: pa.Table) -> list[int]:
        columns = [table.column(k).combine_chunks().to_numpy(zero_copy_only=False) for k in keys]
        breaks = reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])
        return [0, *(np.flatnonzero(breaks) + 1).tolist(), len(table)]

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        table = pa.Table.from_batches(held)
        cuts = grouped(table)
        if len(cuts) > 2:  # the last group may go on in the next batch
            yield table.slice(0, cuts[-2]), cuts[:-1]
            held = table.slice(cuts[-2]).to_batches()
    if sum(b.num_rows for b in held):
        table = pa.Table.from_batches(held)
        yield table, grouped(table)


def cell_counts(texts: DataFrame, hashes: Callable[[pa.Array], Iterator[np.ndarray]], bits: int) -> np.ndarray:
    """How many of the 64-bit hashes of a column's texts fall into each of ``2**bits`` cells.

    ``hashes`` gives those of a batch. Each task sends one table of counts, whatever
    its rows; the sums are made part by part, one row after the other. The result
    has one size for every input.
    """
    cells, parts = 1 << bits, 64
    width = cells // parts

    def rows(found: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int32()),
                                           pa.array([zlib.compress(c.tobytes(), 1) for _, c in found], pa.binary())],
                                          ["part", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(cells, np.int32)
        for batch in batches:
            for some in hashes(batch.column(0)):
                np.add.at(seen, (some >> np.uint64(64 - bits)).astype(np.int64), 1)
        blocks = [(i, seen[i * width:(i + 1) * width]) for i in range(parts)]
        yield rows([(i, c) for i, c in blocks if c.any()])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums.setdefault(part, np.zeros(width, np.int64))
                sums[part] += np.frombuffer(zlib.decompress(counts.as_py()), np.int32)
        yield rows(list(sums.items()))

    layout, total = "part int, counts binary", np.zeros(cells, np.int64)
    for row in texts.mapInArrow(count, layout).repartition(parts, "part").mapInArrow(add, layout).collect():
        total[row.part * width:(row.part + 1) * width] = np.frombuffer(zlib.decompress(row.counts), np.int64)
    return total
