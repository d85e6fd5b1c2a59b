"""Bounds of columns per file, and a reader that opens only files that can match."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.session import path_exists, plain_name

# Below the table's folder; readers pass over names that begin with an underscore.
STATS_FOLDER = "_file_stats"


@dataclass(frozen=True)
class Between:
    """A column's values from ``low`` to ``high``, both inclusive; None leaves a side open."""

    column: str
    low: Any = None
    high: Any = None

    def rows(self) -> Column:
        """The condition on rows; rows without a value do not match."""
        value = F.col(self.column)
        return _all([value.isNotNull(), *([value >= F.lit(self.low)] if self.low is not None else []),
                     *([value <= F.lit(self.high)] if self.high is not None else [])])

    def files(self) -> Column:
        """The condition on a file's bounds; they are null if it has no value at all."""
        least, most = F.col(f"{self.column}.least"), F.col(f"{self.column}.most")
        return _all([least.isNotNull(), *([most >= F.lit(self.low)] if self.low is not None else []),
                     *([least <= F.lit(self.high)] if self.high is not None else [])])


def equal(column: str, value: Any) -> Between:
    """Rows with exactly this value."""
    return Between(column, value, value)


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def file_bounds(table: DataFrame, columns: list[str]) -> DataFrame:
    """(file, modified, size, rows, and least, most and nulls of each column) per file of a scanned table.

    The scan reads the named columns only. Bounds combine map-side, so a file that
    several tasks read costs one row each.
    """
    bounds = [F.struct(F.min(c).alias("least"), F.max(c).alias("most"),
                       F.count_if(F.col(c).isNull()).alias("nulls")).alias(c) for c in columns]
    return table.groupBy(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("size")).agg(F.count(F.lit(1)).alias("rows"), *bounds)


def table_files(spark: SparkSession, path: str, fmt: str = "parquet") -> list[str]:
    """Files of a table."""
    return [plain_name(f) for f in spark.read.format(fmt).load(path).inputFiles()]


def refresh_file_stats(spark: SparkSession, path: str, columns: list[str], fmt: str = "parquet") -> int:
    """Add the bounds of files that have none yet; returns how many these were.

    Only new files are read. A file is never changed in place by Spark, so what is
    known of one stays right; bounds of files that are gone are not asked for.
    """
    target = f"{path}/{STATS_FOLDER}"
    files = table_files(spark, path, fmt)
    if path_exists(spark, target):
        known = {plain_name(row.file) for row in spark.read.parquet(target).select("file").toLocalIterator()}
        files = [f for f in files if f not in known]
    if files:
        table = spark.read.format(fmt).option("basePath", path).load(files)
        file_bounds(table, columns).coalesce(1).write.mode("append").parquet(target)
    return len(files)


def matching_files(spark: SparkSession, path: str, wanted: list[Between], fmt: str = "parquet") -> list[str]:
    """Files of a table that may hold rows of all the wanted ranges.

    A file without bounds, for example one that came after the last refresh, counts
    as matching. The list is the driver's own listing of the table, made shorter.
    """
    files, target = table_files(spark, path, fmt), f"{path}/{STATS_FOLDER}"
    if not path_exists(spark, target):
        return files
    stats = spark.read.parquet(target)
    asked = [w.files() for w in wanted if w.column in stats.columns]
    if not asked:
        return files
    out = {plain_name(row.file) for row in stats.where(~_all(asked)).select("file").toLocalIterator()}
    return [f for f in files if f not in out]


def read_matching(spark: SparkSession, path: str, wanted: list[Between], fmt: str = "parquet") -> DataFrame:
    """Rows of a table within all the wanted ranges, read from the files that can have some.

    Without a matching file the result has no rows, but the table's columns. The
    ranges also reach the scan, which skips row groups inside of the files.
    """
    table, files = spark.read.format(fmt).load(path), matching_files(spark, path, wanted, fmt)
    if files:
        table = spark.read.format(fmt).schema(table.schema).option("basePath", path).load(files)
    condition = _all([w.rows() for w in wanted])
    return table.where(condition) if files else table.where(condition).limit(0)
