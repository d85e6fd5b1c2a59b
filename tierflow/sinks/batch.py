"""Batch writes of layer tables."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.session import file_system


def save_table(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Replace the table at ``path``; returns the rows written.

    The count is observed during the write, so the plan runs only once and
    nothing is cached.
    """
    seen = Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("rows"))
       .write.format(fmt).mode("overwrite").save(path))
    return seen.get.get("rows", 0)


def save_partitioned(df: DataFrame, path: str, columns: list[str], fmt: str = "parquet") -> None:
    """Replace a table partitioned by ``columns``.

    Rows are rebalanced on the partition columns first: few files per
    partition, while adaptive execution splits a partition that is too large
    for one task.
    """
    (df.hint("rebalance", *columns)
       .write.format(fmt).mode("overwrite").partitionBy(*columns).save(path))


def truncate_and_load(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Replace all rows by a complete new load; a failed load leaves no half."""
    return save_table(df, path, fmt)


def load_some_indicators(existing: DataFrame, new_rows: DataFrame, codes: list[str],
                         path: str, fmt: str = "parquet") -> int:
    """Reload only some indicators: other indicators' rows stay as they are.

    ``path`` must not be where ``existing`` is read from.
    """
    kept = existing.filter(~F.coalesce(F.col("indicator_code").isin(codes), F.lit(False)))
    return save_table(kept.unionByName(new_rows), path, fmt)


def save_by_code(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Indicator table with a folder per indicator, which can be reloaded one by one."""
    save_partitioned(df, path, ["indicator_code"], fmt)


def reload_indicators(new_rows: DataFrame, codes: list[str], path: str, fmt: str = "parquet") -> dict[str, int]:
    """Replace only the named indicators of a table saved by code; returns the rows per code.

    The folders of other indicators are neither read nor written. An indicator
    without new rows loses its old ones, as in a full load.
    """
    spark = new_rows.sparkSession
    system, folder = file_system(spark, path)

    def folders() -> dict:
        """Each code's folder and the names of its files."""
        names = {f"indicator_code={code}": code for code in codes}
        found = {names.get(unquote(e.getPath().getName())): e.getPath() for e in system.listStatus(folder)}
        return {c: (p, {f.getPath().getName() for f in system.listStatus(p)}) for c, p in found.items() if c}

    before = folders()
    (new_rows.filter(F.col("indicator_code").isin(codes)).hint("rebalance", "indicator_code")
     .write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("indicator_code").save(path))
    after = folders()
    for code, (place, files) in before.items():
        if after[code][1] == files:  # nothing new was written there
            system.delete(place, True)
            del after[code]
    loaded = {code: 0 for code in codes}
    if after:
        rows = spark.read.format(fmt).option("basePath", path).load([p.toString() for p, _ in after.values()])
        loaded |= {r.indicator_code: r["count"] for r in rows.groupBy("indicator_code").count().collect()}
    return loaded


def save_bucketed(df: DataFrame, name: str, path: str, column: str, buckets: int) -> None:
    """Table ``name`` in files that are hashed and sorted by a column: joins and groups on it need no shuffle.

    Rows are dealt out by the same hash first, so each bucket is one file.
    """
    (df.repartition(buckets, column).write.format("parquet").mode("overwrite").option("path", path)
       .bucketBy(buckets, column).sortBy(column).saveAsTable(name))


def save_indicators(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Indicator table partitioned by year and sorted by country and code.

    Ranges over all three columns let a large year span several tasks.
    """
    order = ["year", "country_code", "indicator_code"]
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
       .write.format(fmt).mode("overwrite").partitionBy("year").save(path))


def append_evolving(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append rows that may have columns the table does not have yet."""
    df.write.format(fmt).mode("append").option("mergeSchema", True).save(path)


def read_merged(spark: SparkSession, path: str, schema: T.StructType | None = None,
                fmt: str = "parquet") -> DataFrame:
    """All rows with the columns of every append, NULL where a file has none.

    Merging reads every file footer; a known ``schema`` saves that.
    """
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader.option("mergeSchema", True)).load(path)


def union_evolving(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both, with the columns of both."""
    return old.unionByName(new, allowMissingColumns=True)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header line each, written in parallel."""
    df.write.mode("overwrite").option("header", True).csv(path)
