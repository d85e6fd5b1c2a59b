"""Upkeep of stored tables. Every job writes to a new path: a table must not be
replaced while it is read."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.sources.layers import read_if_there


def compact(spark: SparkSession, src: str, dst: str, rows_per_file: int = 5_000_000,
            fmt: str = "parquet") -> int:
    """Fewer, larger files; returns the number of files aimed at.

    The scan already packs small files into one task and splits large ones;
    merging neighbouring tasks and capping the rows per file does the rest
    without a shuffle.
    """
    table = spark.read.format(fmt).load(src)
    files = max(1, math.ceil(table.count() / rows_per_file))
    (table.coalesce(files).write.format(fmt).option("maxRecordsPerFile", rows_per_file)
          .mode("errorifexists").save(dst))
    return files


def _sort_number(name: str, kind: T.DataType) -> Column:
    """A number in the order of the column; text counts by its first bytes."""
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(name, "utf-8"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    return F.col(name).cast("double")


def _bucket(value: Column, cuts: list[float], first: int = 0) -> Column:
    """Number of cuts at or below a value, by halving; NULL counts as lowest."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    return (F.when(value >= cuts[middle], _bucket(value, cuts[middle + 1:], first + middle + 1))
             .otherwise(_bucket(value, cuts[:middle], first)))


def with_z_value(table: DataFrame, columns: list[str], bits: int = 5) -> DataFrame:
    """Add ``_z``: the interleaved bucket bits of several columns.

    Bucket borders are approximate percentiles of all columns, found in one
    aggregate, so skewed values still give even buckets. Number, bucket and z
    value are separate projections, so each is computed once per row.
    """
    kinds = {f.name: f.dataType for f in table.schema.fields}
    numbered = table.withColumns({f"_n_{c}": _sort_number(c, kinds[c]) for c in columns})
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    borders = numbered.agg(*[F.percentile_approx(f"_n_{c}", steps).alias(c)
                             for c in columns]).first()
    bucketed = numbered.withColumns(
        {f"_b_{c}": _bucket(F.col(f"_n_{c}"), sorted(set(borders[c] or []))) for c in columns})
    z = F.lit(0).cast("bigint")
    for place, name in enumerate(columns):
        for bit in range(bits):
            one = F.shiftright(f"_b_{name}", bit).bitwiseAND(F.lit(1)).cast("bigint")
            z = z.bitwiseOR(F.shiftleft(one, bit * len(columns) + place))
    return bucketed.withColumn("_z", z).select(*table.columns, "_z")


def zorder_layout(spark: SparkSession, src: str, dst: str, columns: list[str], bits: int = 5,
                  files: int | None = None, fmt: str = "parquet") -> None:
    """Rewrite a table so that filters on any of the columns skip most files.

    The columns themselves follow the z value in the range key, so one crowded
    cell is still divided over several files.
    """
    order = ["_z", *columns]
    placed = with_z_value(spark.read.format(fmt).load(src), columns, bits)
    ranged = placed.repartitionByRange(files, *order) if files \
        else placed.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).drop("_z").write.format(fmt).mode("errorifexists").save(dst)


def table_inventory(spark: SparkSession, tables: dict[str, tuple[str, str]],
                    fmt: str = "parquet") -> DataFrame:
    """State of (path, time column) tables: present or not, rows, newest time.

    ``status`` is that of the whole set: healthy if all are there, degraded if
    some are, down if none is.
    """
    parts, present = [], 0
    for name, (path, time_column) in tables.items():
        found = read_if_there(spark, path, fmt)
        if found is None:
            part = spark.createDataFrame(
                [(name, False, 0, None)],
                "table_name string, found boolean, row_count bigint, newest timestamp")
        else:
            present += 1
            part = (found.agg(F.count(F.lit(1)).alias("row_count"), F.max(time_column).alias("newest"))
                    .select(F.lit(name).alias("table_name"), F.lit(True).alias("found"),
                            "row_count", F.col("newest").cast("timestamp")))
        parts.append(part)
    status = "healthy" if present == len(tables) else "degraded" if present else "down"
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.withColumn("status", F.lit(status))
